"""Batch form == streaming form, and restart from a checkpoint."""

import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.operators import logs, visitors
from shoal.schemas import PAGE_LOG
from shoal.sources import testdata as td
from shoal.sources.kafka import read_text_stream
from shoal.streaming import jobs, stateful

SF = "/root/testdata/sf0.001"
LOG_SCHEMA = T.StructType([T.StructField("seq", T.LongType())] + PAGE_LOG.fields)


def _write_parts(df, path, order_col, parts=3):
    """Write ``df`` as ``parts`` JSON files in ``order_col`` order."""
    rows = sorted(df.collect(), key=lambda r: r[order_col])
    os.makedirs(path, exist_ok=True)
    step = (len(rows) + parts - 1) // parts
    for i in range(parts):
        name = os.path.join(path, f"part-{i:03d}.json")
        with open(name, "w") as f:
            for r in rows[i * step:(i + 1) * step]:
                f.write(json.dumps(r.asDict(recursive=True)) + "\n")
        _age(name, i)


def _age(path, i):
    """File sources take files in modification-time order: make it explicit."""
    t = 1_700_000_000 + i
    os.utime(path, (t, t))


def _run(spark, stream, name, ckpt, until_idle=False):
    w = (stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt))
    if until_idle:
        # processing-time state expiry keeps scheduling batches: stop once
        # all input is processed
        import time
        q = w.trigger(availableNow=True).start()
        deadline, idle = time.time() + 180, 0
        while time.time() < deadline and q.isActive:
            p = q.lastProgress
            idle = idle + 1 if p and p["numInputRows"] == 0 and not q.status["isDataAvailable"] else 0
            if idle >= 3:
                break
            time.sleep(1)
        q.stop()
    else:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination(600)
    return spark.sql(f"SELECT * FROM {name}").collect()


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="shoal-stream-", dir="/tmp")


def test_fix_is_new_stream_equals_batch(spark, tmp):
    log = td.page_log(td.table(spark, SF, "events"))
    _write_parts(log, f"{tmp}/in", "seq")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    got = {r.seq: r.is_new for r in _run(spark, stateful.fix_is_new_stream(src), "fix1", f"{tmp}/ck")}
    want = {r.seq: r.common.is_new for r in visitors.fix_is_new(log).collect()}
    assert got == want


def test_unique_visitor_stream_equals_batch(spark, tmp):
    log = td.page_log(td.table(spark, SF, "events"))
    _write_parts(log, f"{tmp}/in", "seq")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    got = {r.seq for r in _run(spark, stateful.unique_visitor_stream(src), "uv1", f"{tmp}/ck",
                                       until_idle=True)}
    want = {r.seq for r in visitors.unique_visitor(log).collect()}
    assert got == want


def test_user_jump_stream_equals_batch(spark, tmp):
    log = td.page_log(td.table(spark, SF, "events"), clock="jump")
    _write_parts(log, f"{tmp}/in", "ts")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    got = {r.seq: r.reason for r in _run(spark, stateful.user_jump_stream(src), "jump1", f"{tmp}/ck")}
    want = {r.seq: (r.reason, r.ts) for r in visitors.user_jump(log).collect()}
    max_ts = max(ts for _, ts in want.values())
    assert all(want[s][0] == reason for s, reason in got.items())
    # only pending entries whose timer is beyond the last watermark stay open
    missing = [want[s] for s in want if s not in got]
    assert all(reason == "timeout" and ts + visitors.JUMP_WITHIN_MS > max_ts for reason, ts in missing)


def _run_to_files(stream, out, ckpt):
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(600)


def test_fix_is_new_restart_from_checkpoint(spark, tmp):
    log = td.page_log(td.table(spark, SF, "events"))
    _write_parts(log, f"{tmp}/all", "seq", parts=2)
    os.makedirs(f"{tmp}/in")
    shutil.copy(f"{tmp}/all/part-000.json", f"{tmp}/in/part-000.json")
    src = spark.readStream.schema(LOG_SCHEMA).json(f"{tmp}/in")
    _run_to_files(stateful.fix_is_new_stream(src), f"{tmp}/out", f"{tmp}/ck")
    n_first = spark.read.parquet(f"{tmp}/out").count()
    shutil.copy(f"{tmp}/all/part-001.json", f"{tmp}/in/part-001.json")
    src = spark.readStream.schema(LOG_SCHEMA).json(f"{tmp}/in")
    _run_to_files(stateful.fix_is_new_stream(src), f"{tmp}/out", f"{tmp}/ck")
    rows = spark.read.parquet(f"{tmp}/out").collect()
    got = {r.seq: r.is_new for r in rows}
    assert 0 < n_first < len(rows) == len(got)  # resumed, nothing repeated
    assert got == {r.seq: r.common.is_new for r in visitors.fix_is_new(log).collect()}


def test_log_split_stream_equals_batch(spark, tmp):
    raw = td.raw_log_text(td.table(spark, SF, "events"))
    _write_parts(raw, f"{tmp}/in", "seq")
    routed = jobs.log_split_stream(read_text_stream(spark, f"{tmp}/in", 1))
    got = sorted((r.route, r.value) for r in _run(spark, routed, "routes1", f"{tmp}/ck"))
    clean, dirty = logs.split_dirty(raw)
    batch = logs.route_log(visitors.fix_is_new(clean)).select("route", "value").unionByName(
        dirty.select(F.lit("dirty").alias("route"), "value"))
    want = sorted((r.route, r.value) for r in batch.collect())
    assert got == want


def test_stream_outer_join(spark, tmp):
    os.makedirs(f"{tmp}/l")
    os.makedirs(f"{tmp}/r")
    with open(f"{tmp}/l/a.json", "w") as f:
        f.write('{"k": 1, "ts": "100"}\n{"k": 2, "ts": "100"}\n{"k": 9, "ts": "200"}\n')
    with open(f"{tmp}/r/a.json", "w") as f:
        f.write('{"rk": 1, "rts": "102"}\n{"rk": 2, "rts": "120"}\n{"rk": 9, "rts": "200"}\n')
    left = jobs.event_time(spark.readStream.schema("k long, ts string").json(f"{tmp}/l"), "ts", "lt")
    right = jobs.event_time(spark.readStream.schema("rk long, rts string").json(f"{tmp}/r"), "rts", "rt")
    out = jobs.stream_join(left, right, "k", "rk", "left", "lt", "rt", "5 seconds").select("k", "rk")
    rows = sorted((r.k, r.rk) for r in _run(spark, out, "oj1", f"{tmp}/ck"))
    # k=1 matches; k=2 is 20 s apart (NULL side emitted once the watermark passes);
    # k=9 matches but the final watermark may hold it back
    assert (1, 1) in rows and (2, None) in rows


def _change(seq, table, ts, **data):
    return {"seq": seq, "value": json.dumps(
        {"database": "db", "table": table, "type": "insert", "ts": str(ts), "data": data})}


def _detail(i, order, ts, sku_num="2"):
    return _change(i, "order_detail", ts, id=f"d{i}", order_id=order, sku_id="s", sku_name="n",
                   sku_num=sku_num, create_time="2024-01-01 00:00:00", source_type="O",
                   source_id="x", split_total_amount="1.00", split_activity_amount="0.00",
                   split_coupon_amount="0.00", order_price="1.50")


def _order(i, oid, ts, type_="insert"):
    rec = _change(i, "order_info", ts, id=oid, user_id="u", province_id="p",
                  operate_time="2024-01-01 00:00:00", order_status="O")
    return {"seq": rec["seq"], "value": rec["value"].replace('"insert"', f'"{type_}"')}


def _files(path, batches):
    os.makedirs(path, exist_ok=True)
    for i, rows in enumerate(batches):
        name = f"{path}/part-{i:03d}.json"
        with open(name, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        _age(name, i)


@pytest.fixture()
def order_conf(spark):
    for k, v in jobs.ORDER_STREAM_CONF.items():
        spark.conf.set(k, v)
    yield
    for k in jobs.ORDER_STREAM_CONF:
        spark.conf.unset(k)


def _wide_stream(spark, path, name, ckpt, **times):
    from shoal.operators.cdc import parse_change_log
    from shoal.sources.testdata import base_dic
    joined = jobs.order_joined_stream(parse_change_log(read_text_stream(spark, path, 1)), **times)
    got = []

    def write(df, batch_id):
        got.extend(df.collect())
    body = jobs.foreach_batch_with(lambda: base_dic(spark), jobs.order_wide_batch, write)
    q = joined.writeStream.foreachBatch(body).option("checkpointLocation", ckpt).queryName(name) \
        .trigger(availableNow=True).start()
    q.awaitTermination(600)
    return got, q.recentProgress


def test_order_wide_stream_chain(spark, tmp, order_conf):
    recs = [_detail(1, "o1", 100), _order(2, "o1", 101),
            _change(3, "order_detail_activity", 100, order_detail_id="d1", activity_id="a",
                    activity_rule_id="r"),
            _detail(4, "o2", 100), _order(5, "o2", 102),
            _change(6, "order_detail_coupon", 103, order_detail_id="d4", coupon_id="c"),
            _detail(7, "o3", 100), _order(8, "o3", 200)]                # beyond the bound
    # only details and orders come later: time advances for all
    _files(f"{tmp}/in", [recs, [_detail(90, "oz", 1000), _order(91, "oz", 1000)]])
    rows = {r.id: r for r in _wide_stream(spark, f"{tmp}/in", "wide1", f"{tmp}/ck")[0]}
    assert rows["d1"].activity_id == "a" and rows["d1"].coupon_id is None
    assert rows["d4"].coupon_id == "c" and rows["d4"].activity_id is None
    assert rows["d4"].split_original_amount == "3.0000"
    assert "d7" not in rows


def test_order_stream_advances_while_change_tables_are_silent(spark, tmp, order_conf):
    batches = [[_detail(10 * i, f"o{i}", 100 + 50 * i), _order(10 * i + 1, f"o{i}", 101 + 50 * i)] for i in range(6)]
    _files(f"{tmp}/in", batches)
    got, progress = _wide_stream(spark, f"{tmp}/in", "silent", f"{tmp}/ck")
    # no activity, no coupon: every detail but those the last watermark may hold back comes out
    assert {r.id for r in got} >= {f"d{10 * i}" for i in range(5)}
    assert all(r.activity_id is None and r.coupon_id is None for r in got)
    state = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress if p["stateOperators"]]
    assert state[-1] < 2 * 6 and state[-1] <= max(state)


def test_order_stream_equals_batch_within_the_bound(spark, tmp, order_conf):
    from shoal.operators.cdc import filter_change_envelope, parse_change_log
    from shoal.operators.joins import order_wide_join
    from shoal.sources.testdata import base_dic
    rows = []
    for i in range(12):
        t = 1000 + 20 * i
        rows.append([_detail(10 * i, f"o{i}", t), _order(10 * i + 1, f"o{i}", t + i % 4)])
        if i % 2:
            rows[-1].append(_order(10 * i + 2, f"o{i}", t + 4, "update"))
        if i % 3 == 0:
            rows[-1].append(_change(10 * i + 3, "order_detail_activity", t + 1, order_detail_id=f"d{10 * i}", activity_id="a"))
        if i % 4 == 0:
            rows[-1].append(_change(10 * i + 4, "order_detail_coupon", t, order_detail_id=f"d{10 * i}", coupon_id="c"))
    _files(f"{tmp}/in", [*rows, [_detail(9990, "end", 9000), _order(9991, "end", 9000)]])
    stream, _ = _wide_stream(spark, f"{tmp}/in", "same", f"{tmp}/ck", bound="5 seconds", delay="30 seconds")
    text = spark.createDataFrame([(r["seq"], r["value"]) for b in rows for r in b], "seq long, value string")
    batch = order_wide_join(filter_change_envelope(parse_change_log(text)), base_dic(spark)).collect()

    def plain(found):
        return sorted((r.id, r.type, r.oi_ts, r.activity_id or "", r.coupon_id or "") for r in found if r.id != "d9990")
    assert plain(stream) == plain(batch) and len(batch) == 18


def test_dictionary_is_that_of_the_batch(spark, tmp, order_conf):
    from shoal.operators.cdc import parse_change_log
    _files(f"{tmp}/in", [[_detail(10 * i, f"o{i}", 100 + 50 * i), _order(10 * i + 1, f"o{i}", 100 + 50 * i)] for i in range(6)])
    joined = jobs.order_joined_stream(parse_change_log(read_text_stream(spark, f"{tmp}/in", 1)))
    names, got = iter(range(100)), []

    def lookup():
        return spark.createDataFrame([("O", f"name{next(names)}")], "dic_code string, dic_name string")

    body = jobs.foreach_batch_with(lookup, jobs.order_wide_batch, lambda df, i: got.extend(df.collect()))
    q = joined.writeStream.foreachBatch(body).option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
    q.awaitTermination(600)
    assert len({r.source_type_name for r in got}) > 1


def test_dim_stream_config_changes_between_batches(spark, tmp):
    from shoal.operators.cdc import parse_change_log
    from shoal.sinks.writers import read_dim_state
    from shoal.sources.config import read_config

    def cfg_line(op, after, ts):
        return json.dumps({"before": None, "after": after, "op": op, "ts_ms": ts})

    def change(seq, table, **data):
        return json.dumps({"seq": seq, "value": json.dumps(
            {"database": "db", "table": table, "type": "insert", "ts": "1", "data": data})})

    os.makedirs(f"{tmp}/cfg")
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/cfg/0.json", "w") as f:
        f.write(cfg_line("r", {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a",
                               "sink_pk": "id"}, 1) + "\n")
    with open(f"{tmp}/in/0.json", "w") as f:
        f.write(change(1, "t", id="1", a="x", b="y") + "\n" + change(2, "u", id="7", c="z") + "\n")

    def run():
        body = jobs.dim_sink_batch(lambda: read_config(spark, f"{tmp}/cfg"), f"{tmp}/dims")
        q = (parse_change_log(read_text_stream(spark, f"{tmp}/in")).writeStream.foreachBatch(body)
             .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    # configuration changes: table t keeps b too, table u becomes a dimension
    with open(f"{tmp}/cfg/1.json", "w") as f:
        f.write(cfg_line("u", {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a,b",
                               "sink_pk": "id"}, 2) + "\n")
        f.write(cfg_line("c", {"source_table": "u", "sink_table": "dim_u", "sink_columns": "id,c",
                               "sink_pk": "id"}, 3) + "\n")
    with open(f"{tmp}/in/1.json", "w") as f:
        f.write(change(3, "t", id="1", b="y2") + "\n" + change(4, "u", id="8", c="w") + "\n")
    run()
    state = {(r.sink_table, r.pk): r.data for r in read_dim_state(spark, f"{tmp}/dims").collect()}
    # record 2 came before table u had a configuration and stays unrouted
    assert state == {("dim_t", "1"): {"id": "1", "a": "x", "b": "y2"},
                     ("dim_u", "8"): {"id": "8", "c": "w"}}


def test_dim_job_tables_and_snapshots(spark, tmp):
    from shoal.operators.cdc import parse_change_log
    from shoal.sinks.writers import read_dim_entries, read_dim_state
    from shoal.sources.config import read_config

    os.makedirs(f"{tmp}/cfg")
    with open(f"{tmp}/cfg/0.json", "w") as f:
        f.write(json.dumps({"before": None, "op": "r", "ts_ms": 1, "after": {
            "source_table": "t", "sink_table": "dim_t", "sink_columns": "id,a", "sink_pk": "id"}}) + "\n")
    _files(f"{tmp}/in", [[_change(10 * i + j, "t", 100 + i, id=str(j), a=f"v{i}") for j in range(3)] for i in range(7)])
    db = "shoal_dim_job"
    body = jobs.dim_sink_batch(lambda: read_config(spark, f"{tmp}/cfg"), f"{tmp}/dims", db, f"{tmp}/tables", snapshot_every=3)
    q = (parse_change_log(read_text_stream(spark, f"{tmp}/in", 1)).writeStream.foreachBatch(body)
         .option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert sorted(os.listdir(f"{tmp}/dims/snapshots")) == ["upto=2", "upto=5"]
    # three keys of two columns from the snapshot, and the batch after it: not the history
    assert read_dim_entries(spark, f"{tmp}/dims").count() == 12
    assert {r.pk: r.data["a"] for r in read_dim_state(spark, f"{tmp}/dims").collect()} == {str(j): "v6" for j in range(3)}
    # the table was filled at the last snapshot
    assert sorted(map(tuple, spark.table(f"{db}.dim_t").collect())) == [(str(j), "v5") for j in range(3)]
    # a replayed batch changes nothing
    body(spark.createDataFrame([(60, "db", "t", "insert", "106", {"id": "0", "a": "v6"}, None)],
                               "seq long, database string, `table` string, type string, ts string, "
                               "data map<string,string>, old map<string,string>"), 6)
    assert read_dim_entries(spark, f"{tmp}/dims").count() == 8


def test_log_routes_to_file_sink(spark, tmp):
    from shoal.sinks.writers import write_routed_files
    raw = td.raw_log_text(td.table(spark, SF, "events"))
    _write_parts(raw, f"{tmp}/in", "seq", parts=2)
    q = write_routed_files(jobs.log_split_stream(read_text_stream(spark, f"{tmp}/in", 1)),
                           f"{tmp}/topics", f"{tmp}/ck", trigger={"availableNow": True})
    q.awaitTermination(600)
    counts = {r["route"]: r["count"] for r in
              spark.read.text(f"{tmp}/topics").groupBy("route").count().collect()}
    clean, dirty = logs.split_dirty(raw)
    want = {k: v.count() for k, v in logs.split_log(visitors.fix_is_new(clean)).items()}
    want["dirty"] = dirty.count()
    assert counts == want


def test_interval_join_stream_bounds(spark, tmp):
    os.makedirs(f"{tmp}/e")
    os.makedirs(f"{tmp}/d")
    with open(f"{tmp}/e/a.json", "w") as f:
        f.write('{"empno": 1, "deptno": 10, "ts": 1000}\n')
    with open(f"{tmp}/d/a.json", "w") as f:
        f.write("\n".join(json.dumps({"deptno": 10, "dname": f"d{d}", "dts": 1000 + d})
                          for d in (-6, -5, 0, 5, 6)) + "\n")

    def timed(df, col, name):
        return df.withColumn(name, F.timestamp_millis(col)).withWatermark(name, "1 second")

    emp = timed(spark.readStream.schema("empno int, deptno int, ts long").json(f"{tmp}/e"), "ts", "et")
    dept = timed(spark.readStream.schema("deptno int, dname string, dts long").json(f"{tmp}/d")
                 .withColumnRenamed("deptno", "d_deptno"), "dts", "dt")
    out = jobs.interval_join_stream(emp, dept, "deptno", "et", "dt", -5, 5, right_key="d_deptno")
    got = sorted(r.dname for r in _run(spark, out.select("dname"), "ij1", f"{tmp}/ck"))
    assert got == ["d-5", "d0", "d5"]


@pytest.mark.parametrize("ttl_ms,expected", [(1, [1, 2]), (86_400_000, [1])])
def test_unique_visitor_state_ttl(spark, tmp, ttl_ms, expected):
    os.makedirs(f"{tmp}/in")
    base = 1704067200000
    for i, seq in enumerate((1, 2)):
        rec = {"seq": seq, "common": {"mid": "m1", "is_new": "1"},
               "page": {"page_id": "home", "last_page_id": None}, "ts": base + seq}
        with open(f"{tmp}/in/part-{i}.json", "w") as f:
            f.write(json.dumps(rec) + "\n")
        _age(f"{tmp}/in/part-{i}.json", i)
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    out = stateful.unique_visitor_stream(src, ttl_ms=ttl_ms)
    got = sorted(r.seq for r in _run(spark, out, f"uvttl{ttl_ms}", f"{tmp}/ck", until_idle=True))
    # same device, same date, two micro-batches: a second row only once the state has expired
    assert got == expected
