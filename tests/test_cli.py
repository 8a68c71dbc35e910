"""The command-line jobs on folder sources (the file form of the topics)."""

import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from shoal.__main__ import run
from shoal.operators import visitors
from shoal.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _topic(rows, path):
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for seq, value in rows:
            f.write(json.dumps({"seq": seq, "value": value}) + "\n")


def test_log_split_then_user_jump(spark):
    d = tempfile.mkdtemp(prefix="shoal-cli-", dir="/tmp")
    raw = td.raw_log_text(td.table(spark, SF, "events")).collect()
    _topic([(r.seq, r.value) for r in raw], f"{d}/topic_log")
    run(["log-split", "--source", f"{d}/topic_log", "--sink", f"{d}/out",
         "--checkpoint", f"{d}/ck1", "--once"], spark).awaitTermination(600)
    page = spark.read.text(f"{d}/out/route=page").collect()
    assert len(page) == spark.read.parquet(f"{SF}/events.parquet").where(
        "event_type != 'signup' AND event_id % 97 != 0").count()
    assert all("ba" in json.loads(r.value)["common"] for r in page)
    # the page topic feeds the bounce job
    _topic([(i, r.value) for i, r in enumerate(page)], f"{d}/page_topic")
    run(["user-jump", "--source", f"{d}/page_topic", "--sink", f"{d}/jumps",
         "--checkpoint", f"{d}/ck2", "--once"], spark).awaitTermination(600)
    assert spark.read.text(f"{d}/jumps").count() > 0


@pytest.mark.parametrize("job", ["order-pre-process", "order-detail"])
def test_order_jobs(spark, job):
    d = tempfile.mkdtemp(prefix="shoal-cli-", dir="/tmp")
    os.makedirs(f"{d}/dic")
    with open(f"{d}/dic/a.json", "w") as f:
        f.write(json.dumps({"dic_code": "O", "dic_name": "open line"}) + "\n")

    def rec(table, ts, **data):
        return json.dumps({"database": "db", "table": table, "type": "insert", "ts": str(ts),
                           "data": data})
    rows = [(1, rec("order_detail", 100, id="d1", order_id="o1", sku_num="2", order_price="1.50",
                    source_type="O")),
            (2, rec("order_info", 101, id="o1", order_status="1001")),
            (3, rec("order_detail", 1000, id="d9", order_id="o9", source_type="O")),
            (4, rec("order_info", 1000, id="o9")),
            (5, rec("order_detail_activity", 1000, order_detail_id="d9")),
            (6, rec("order_detail_coupon", 1000, order_detail_id="d9"))]
    _topic(rows, f"{d}/topic_db")
    run([job, "--source", f"{d}/topic_db", "--sink", f"{d}/wide",
         "--checkpoint", f"{d}/ck", "--dictionary", f"{d}/dic", "--bound", "4 seconds", "--delay", "3 seconds", "--once"],
        spark).awaitTermination(600)
    out = {r.id: r for r in spark.read.json(f"{d}/wide").collect()}
    assert out["d1"].split_original_amount == "3.0000" and out["d1"].source_type_name == "open line"
    spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_dim_and_cart_add_jobs(spark):
    from shoal.sinks.writers import read_dim_state
    d = tempfile.mkdtemp(prefix="shoal-cli-", dir="/tmp")
    os.makedirs(f"{d}/cfg")
    with open(f"{d}/cfg/a.json", "w") as f:
        f.write(json.dumps({"before": None, "op": "r", "ts_ms": 1,
                            "after": {"source_table": "cart_info", "sink_table": "dim_cart",
                                      "sink_columns": "id,sku_num", "sink_pk": "id"}}) + "\n")
    os.makedirs(f"{d}/dic")
    with open(f"{d}/dic/a.json", "w") as f:
        f.write(json.dumps({"dic_code": "O", "dic_name": "open line"}) + "\n")

    def rec(seq, type_, num, old=None):
        return (seq, json.dumps({"database": "db", "table": "cart_info", "type": type_, "ts": "1",
                                 "data": {"id": "c1", "source_type": "O", "sku_num": num},
                                 "old": old}))
    _topic([rec(1, "insert", "1"), rec(2, "update", "4", {"sku_num": "1"})], f"{d}/topic_db")
    run(["dim", "--source", f"{d}/topic_db", "--sink", f"{d}/dims", "--checkpoint", f"{d}/ck1",
         "--config", f"{d}/cfg", "--once"], spark).awaitTermination(600)
    state = read_dim_state(spark, f"{d}/dims").collect()
    assert [(r.sink_table, r.pk, r.data) for r in state] == [("dim_cart", "c1", {"id": "c1", "sku_num": "4"})]
    run(["cart-add", "--source", f"{d}/topic_db", "--sink", f"{d}/cart", "--checkpoint", f"{d}/ck2",
         "--dictionary", f"{d}/dic", "--once"], spark).awaitTermination(600)
    got = sorted((r.id, r.sku_num) for r in spark.read.json(f"{d}/cart").collect())
    assert got == [("c1", "1"), ("c1", "3")]


def test_options_reach_the_readers(spark, monkeypatch):
    from shoal import __main__ as m
    seen = {}
    monkeypatch.setattr("shoal.sources.kafka.read_kafka_text",
                        lambda spark, servers, topic, starting, **o: seen.update(servers=servers, topic=topic, starting=starting, **o))
    monkeypatch.setattr("shoal.sources.jdbc.read_jdbc_table",
                        lambda spark, url, table, **o: seen.update(url=url, table=table, **o) or spark.range(1))
    monkeypatch.setenv("SHOP_PASSWORD", "secret")
    args = m._parser().parse_args([
        "cart-add", "--source", "kafka:h:9092", "--sink", "x", "--checkpoint", "c", "--source-topic", "mine",
        "--source-option", "startingOffsets=latest", "--per-trigger", "7", "--dictionary", "jdbc:x:y",
        "--dictionary-option", "user=me", "--dictionary-option", "password=env:SHOP_PASSWORD"])
    m._source(spark, args, "topic_db")
    m._dictionary(spark, args).get()
    assert seen == {"servers": "h:9092", "topic": "mine", "starting": "latest", "maxOffsetsPerTrigger": "7",
                    "url": "jdbc:x:y", "table": "base_dic", "user": "me", "password": "secret"}


def test_the_launcher_sets_the_session():
    """A job's own session keeps what spark-submit was given."""
    import subprocess
    import sys
    code = ("from shoal.session import job_session; s = job_session(); c = s.conf; "
            "print('GOT', s.sparkContext.master, c.get('spark.sql.shuffle.partitions'), "
            "s.sparkContext.getConf().get('spark.driver.memory'), c.get('spark.sql.adaptive.enabled'), "
            "c.get('spark.sql.session.timeZone'), 'RocksDB' in c.get('spark.sql.streaming.stateStore.providerClass'))")
    args = ("--master local[2] --conf spark.sql.shuffle.partitions=64 --conf spark.driver.memory=1g "
            "--conf spark.sql.adaptive.enabled=false --conf spark.ui.enabled=false pyspark-shell")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYSPARK_SUBMIT_ARGS": args},
                         capture_output=True, text=True, timeout=300)
    assert "GOT local[2] 64 1g false UTC True" in out.stdout, out.stderr[-2000:]


def test_page_text_that_cannot_be_placed_goes_to_dirty(spark):
    import time
    d = tempfile.mkdtemp(prefix="shoal-cli-", dir="/tmp")
    good = json.dumps({"common": {"mid": "m"}, "page": {}, "ts": 1})
    _topic([(1, good), (2, "{bad"), (3, json.dumps({"common": {}, "ts": 1}))], f"{d}/page_topic")
    run(["user-jump", "--source", f"{d}/page_topic", "--sink", f"{d}/jumps", "--checkpoint", f"{d}/ck",
         "--dirty", f"{d}/dirty", "--once"], spark).awaitTermination(600)
    for q in spark.streams.active:
        q.awaitTermination(600)
    until = time.time() + 60
    while not os.path.exists(f"{d}/dirty/_spark_metadata/0") and time.time() < until:
        time.sleep(0.5)
    assert spark.read.text(f"{d}/dirty").count() == 2


def test_unique_visitor_job_once_finishes(spark):
    from shoal.streaming.jobs import stop_when_idle
    d = tempfile.mkdtemp(prefix="shoal-cli-", dir="/tmp")
    log = td.page_log(td.table(spark, SF, "events"))
    rows = log.select("seq", F.to_json(F.struct("common", "page", "ts")).alias("value")).collect()
    _topic([(r.seq, r.value) for r in rows], f"{d}/page_topic")
    q = run(["unique-visitor", "--source", f"{d}/page_topic", "--sink", f"{d}/uv",
             "--checkpoint", f"{d}/ck", "--once"], spark)
    stop_when_idle(q, timeout_seconds=300)
    assert not q.isActive
    assert spark.read.text(f"{d}/uv").count() == visitors.unique_visitor(log).count()
