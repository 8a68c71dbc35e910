"""No row goes without account: late rows, dead letters, replays; state that goes on from a history."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoal.operators import cdc, visitors
from shoal.sources import testdata as td
from shoal.sources.kafka import read_fact_stream, read_text_stream
from shoal.streaming import jobs, stateful
from test_changes import read, write
from test_streaming import LOG_SCHEMA, SF, _run

BASE = 1_704_067_200_000


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="shoal-accounts-", dir="/tmp")


def page(seq, ts, mid="m1", last=None):
    return {"seq": seq, "ts": ts, "common": {"mid": mid, "is_new": "1"}, "page": {"page_id": "home", "last_page_id": last}}


def observed(query, name):
    return [p["observedMetrics"][name] for p in query.recentProgress if name in p.get("observedMetrics", {})]


def test_late_records_come_out_as_late_and_are_counted(spark, tmp):
    rng = random.Random(4)
    batches, seq = [], 0
    for b in range(5):
        rows = []
        for _ in range(30):
            seq += 1
            late = rng.random() < .2 and b
            rows.append(page(seq, BASE + 60_000 * b + rng.randrange(50_000) - (90_000 if late else 0), f"m{rng.randrange(4)}", rng.choice([None, "", "home"])))
        batches.append(rows)
    write(f"{tmp}/in", batches)
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    out = stateful.user_jump_stream(src, keep_late=True)
    q = out.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
    q.awaitTermination(600)
    rows = spark.read.parquet(f"{tmp}/out").collect()
    # a record is late when a batch before its own held a later one
    reached, want = 0, set()
    for batch in batches:
        want |= {r["seq"] for r in batch if r["ts"] < reached}
        reached = max([reached, *(r["ts"] for r in batch)])
    assert {r.seq for r in rows if r.reason == "late"} == want and want
    found = observed(q, "user_jump")
    assert sum(x["late"] for x in found) == len(want) and sum(x["rows"] for x in found) == len(rows)
    # the others take part as in the batch form over the rows in time
    in_time = [r for b in batches for r in b if r["seq"] not in want]
    batch = spark.createDataFrame([(r["seq"], r["ts"], r["common"]["mid"], "1", r["page"]["last_page_id"]) for r in in_time],
                                  "seq long, ts long, mid string, is_new string, last_page_id string")
    known = {r.seq: (r.reason, r.ts) for r in visitors.user_jump(batch).collect()}
    got = {r.seq: r.reason for r in rows if r.reason != "late"}
    assert all(known[s][0] == reason for s, reason in got.items())
    open_still = [known[s] for s in known if s not in got]
    assert all(reason == "timeout" and ts + visitors.JUMP_WITHIN_MS > reached for reason, ts in open_still)


def test_late_records_of_the_job_go_to_their_folder(spark, tmp):
    import shoal.__main__ as cli
    text = [[{"seq": r["seq"], "value": json.dumps({k: v for k, v in r.items() if k != "seq"})} for r in b]
            for b in ([page(1, BASE), page(2, BASE + 50_000)], [page(3, BASE + 10_000), page(4, BASE + 90_000)], [page(5, BASE + 200_000)])]
    text[1].append({"seq": 9, "value": "broken"})
    write(f"{tmp}/in", text)
    q = cli.run(["user-jump", "--source", f"{tmp}/in", "--sink", f"{tmp}/sink", "--checkpoint", f"{tmp}/ck", "--once", "--per-trigger", "1",
                 "--late", f"{tmp}/late", "--dirty", f"{tmp}/dirty"], spark)
    q.awaitTermination(600)
    for other in spark.streams.active:
        other.awaitTermination(600)
    late = [json.loads(r.value)["ts"] for r in spark.read.text(f"{tmp}/late").collect()]
    assert late == [BASE + 10_000]
    assert [r.value for r in spark.read.text(f"{tmp}/dirty").collect()] == ["broken"]
    assert sorted(json.loads(r.value)["ts"] for r in spark.read.text(f"{tmp}/sink").collect())[:2] == [BASE, BASE + 50_000]


@pytest.mark.parametrize("policy", ["min", "max"])
def test_rows_that_stream_joins_drop_are_counted(spark, tmp, policy):
    left, right = "k long, ts string", "rk long, rts string"
    write(f"{tmp}/l", [[{"k": 1, "ts": "100"}], [{"k": 2, "ts": "500"}], [{"k": 3, "ts": "110"}], [{"k": 4, "ts": "510"}]])
    write(f"{tmp}/r", [[{"rk": 1, "rts": "100"}], [{"rk": 2, "rts": "500"}], [{"rk": 3, "rts": "110"}], [{"rk": 4, "rts": "510"}]])
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    try:
        out = jobs.stream_join(jobs.event_time(read(spark, f"{tmp}/l", left), "ts", "lt"), jobs.event_time(read(spark, f"{tmp}/r", right), "rts", "rt"),
                               "k", "rk", "inner", "lt", "rt").select("k")
        q = out.writeStream.format("memory").queryName(f"late_{policy}").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
        q.awaitTermination(600)
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    rows_out = spark.table(f"late_{policy}").count()
    # four keys a side in; a row is out with its partner or both are counted as late
    assert 2 * rows_out + sum(map(jobs.late_rows, q.recentProgress)) == 8 and rows_out == 3


def test_stream_right_and_full_joins_emit_both_sides_null_rows(spark, tmp):
    left, right = "k long, ts string", "rk long, rts string"
    write(f"{tmp}/l", [[{"k": 1, "ts": "100"}, {"k": 2, "ts": "100"}], [{"k": 9, "ts": "400"}], [{"k": 8, "ts": "900"}]])
    write(f"{tmp}/r", [[{"rk": 1, "rts": "102"}, {"rk": 3, "rts": "101"}], [{"rk": 9, "rts": "401"}], [{"rk": 8, "rts": "900"}]])
    want = {"right": {(1, 1), (None, 3), (9, 9)}, "full": {(1, 1), (2, None), (None, 3), (9, 9)}}
    for how, rows in want.items():
        out = jobs.stream_join(jobs.event_time(read(spark, f"{tmp}/l", left), "ts", "lt"), jobs.event_time(read(spark, f"{tmp}/r", right), "rts", "rt"),
                               "k", "rk", how, "lt", "rt", "5 seconds").select("k", "rk")
        got = [(r.k, r.rk) for r in _run(spark, out, f"outer_{how}", f"{tmp}/ck-{how}")]
        assert len(got) == len(set(got)) and set(got) - {(8, 8)} == rows


# ------------------------------------------------------------------ histories

@pytest.mark.parametrize("job", ["fix", "visitor"])
@pytest.mark.parametrize("granularity", ["day", "second"])
def test_stream_goes_on_from_a_history(spark, tmp, job, granularity):
    """Batch over the first days, stream over the rest: as the batch over all of them."""
    log = td.page_log(td.table(spark, SF, "events"))
    cut = log.approxQuantile("ts", [.6], 0)[0]
    # arrival follows time here
    ordered = sorted(log.collect(), key=lambda r: (r.ts, r.seq))
    rows = [{**r.asDict(recursive=True), "seq": i} for i, r in enumerate(ordered)]
    schema = LOG_SCHEMA
    every = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    before, after = every.where(F.col("ts") <= cut), [r for r in rows if r["ts"] > cut]
    write(f"{tmp}/in", [after[i::3] for i in range(1)] + [[]])
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp}/in")
    name = f"h_{job}_{granularity}"
    if job == "fix":
        out = stateful.fix_is_new_stream(src, granularity, history=visitors.first_visits(before, granularity))
        got = {r.seq: r.is_new for r in _run(spark, out, name, f"{tmp}/ck")}
        want = {r.seq: r.common.is_new for r in visitors.fix_is_new(every, granularity).where(F.col("ts") > cut).collect()}
        alone = {r.seq: r.common.is_new for r in visitors.fix_is_new(every.where(F.col("ts") > cut), granularity).collect()}
    else:
        out = stateful.unique_visitor_stream(src, granularity, history=visitors.last_visits(before, granularity))
        got = {r.seq for r in _run(spark, out, name, f"{tmp}/ck", until_idle=True)}
        want = {r.seq for r in visitors.unique_visitor(every, granularity).where(F.col("ts") > cut).collect()}
        alone = {r.seq for r in visitors.unique_visitor(every.where(F.col("ts") > cut), granularity).collect()}
    assert got == want
    if (job, granularity) in {("fix", "day"), ("visitor", "day")}:
        assert alone != want  # without the history the results are others


def test_history_of_devices_without_rows(spark):
    empty = spark.createDataFrame([], "seq long, ts long, mid string, is_new string, last_page_id string")
    assert visitors.first_visits(empty).count() == 0 and visitors.last_visits(empty).count() == 0
    one = spark.createDataFrame([(2, BASE, "m", "0", "x"), (5, BASE, None, "1", None)], empty.schema)
    assert [tuple(r) for r in visitors.first_visits(one).collect()] == [("m", "2023-12-31")]
    assert visitors.last_visits(one).count() == 0


# ----------------------------------------------------------------- dead letters

LETTERS = ['{"database": "d", "table": "t", "type": "insert", "ts": "1", "data": {"id": "1"}}', "{broken", "", "[1]", None, '{"other": 1}',
           '{"table": "t", "type": "insert", "ts": "1"}', '{"table": "t", "ts": "1", "data": {"id": "1"}}',
           '{"table": "t", "type": "bootstrap-start", "ts": "1", "data": {}}', '{"table": "t", "type": "bootstrap-complete"}']
REASONS = [None, "unreadable", "unreadable", "unreadable", "unreadable", "unreadable", "no data", "no type", "marker", "marker"]


def test_every_change_record_has_one_verdict(spark):
    raw = spark.createDataFrame(list(enumerate(LETTERS)), "seq long, value string")
    assert {r.seq: r.reason for r in cdc.judge_change_log(raw).collect()} == dict(enumerate(REASONS))
    records, dead = cdc.split_change_log(raw)
    assert records.columns == cdc.parse_change_log(raw).columns
    assert [r.seq for r in cdc.filter_change_envelope(cdc.parse_change_log(raw)).collect()] == [r.seq for r in records.collect()] == [0]
    assert {(r.seq, r.value, r.reason) for r in dead.collect()} == {
        (i, LETTERS[i], r) for i, r in enumerate(REASONS) if r not in (None, "marker")}
    assert records.count() + dead.count() + REASONS.count("marker") == len(LETTERS)
    assert cdc.judge_change_log(raw.limit(0)).count() == 0


def test_text_in_is_records_and_dead_letters_on_a_stream(spark, tmp):
    rows = [{"seq": i, "value": v} for i, v in enumerate(LETTERS) if v is not None]
    write(f"{tmp}/in", [rows[:4], rows[4:]])
    judged = cdc.counted(cdc.judge_change_log(read_text_stream(spark, f"{tmp}/in", 1)), "letters", cdc.UNREADABLE, cdc.NO_DATA, cdc.NO_TYPE, cdc.MARKER)
    q = judged.writeStream.format("memory").queryName("letters").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
    q.awaitTermination(600)
    found = observed(q, "letters")
    total = {k: sum(x[k] for x in found) for k in ("rows", "unreadable", "no_data", "no_type", "marker")}
    assert total == {"rows": 9, "unreadable": 4, "no_data": 1, "no_type": 1, "marker": 2}
    assert spark.table("letters").where("reason is null").count() == 9 - 4 - 1 - 1 - 2


def test_dead_letters_of_the_dim_job(spark, tmp):
    import shoal.__main__ as cli
    write(f"{tmp}/in", [[{"seq": i, "value": v} for i, v in enumerate(LETTERS) if v is not None]])
    write(f"{tmp}/cfg", [[{"before": None, "op": "r", "ts_ms": 1, "after": {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id", "sink_pk": "id"}}]])
    q = cli.run(["dim", "--source", f"{tmp}/in", "--sink", f"{tmp}/sink", "--checkpoint", f"{tmp}/ck", "--once", "--config", f"{tmp}/cfg",
                 "--buckets", "4", "--dirty", f"{tmp}/dirty"], spark)
    q.awaitTermination(600)
    for other in spark.streams.active:
        other.awaitTermination(600)
    dead = [json.loads(r.value) for r in spark.read.text(f"{tmp}/dirty").collect()]
    assert {(d["seq"], d["reason"]) for d in dead} == {(i, r) for i, r in enumerate(REASONS) if r not in (None, "marker") and LETTERS[i] is not None}
    from shoal.sinks.dim_store import DimStore
    assert [r.pk for r in DimStore(spark, f"{tmp}/sink").state().collect()] == ["1"]
    assert sum(x["rows"] for x in observed(q, "change_log")) == 9


# ---------------------------------------------------------- effectively once

def test_a_replayed_micro_batch_gives_each_fact_once(spark, tmp):
    raw = td.raw_log_text(td.table(spark, SF, "events")).limit(400)
    rows = [r.asDict() for r in raw.collect()]
    write(f"{tmp}/in", [rows[:150], rows[150:300], rows[300:]])
    routed = jobs.log_split_stream(read_text_stream(spark, f"{tmp}/in", 1))
    os.makedirs(f"{tmp}/topic")

    def attempt(df, batch_id):
        """An at-least-once topic: every batch is written, then its writer fails and it is written again."""
        at = F.timestamp_millis(F.lit(BASE + 1000 * batch_id))
        out = df.select(F.lit(0).cast("long").alias("seq"), "value", "record_id", at.alias("at"), "route")
        for _ in range(2 if batch_id != 1 else 3):
            out.coalesce(1).write.mode("append").json(f"{tmp}/topic")
    q = routed.writeStream.foreachBatch(attempt).option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
    q.awaitTermination(600)
    facts = spark.read.json(f"{tmp}/topic")
    once = facts.select("record_id").distinct().count()
    assert facts.count() > 2 * once
    got = _run(spark, read_fact_stream(spark, f"{tmp}/topic", 1), "facts_once", f"{tmp}/ck2")
    assert len(got) == once and len({r.record_id for r in got}) == once
    # ids name facts: the same text may come from two records
    from shoal.operators import logs
    clean, dirty = logs.split_dirty(spark.createDataFrame([(r["seq"], r["value"]) for r in rows], "seq long, value string"))
    batch = logs.route_log(visitors.fix_is_new(clean))
    assert sorted(r.value for r in got) == sorted(r.value for r in batch.select("value").unionByName(dirty.select("value")).collect())


def test_records_without_an_id_are_told_apart_by_their_place(spark, tmp):
    rows = [{"seq": i // 2, "value": "v", "record_id": None, "at": "2024-01-01T00:00:00Z"} for i in range(6)]
    write(f"{tmp}/in", [rows])
    assert len(_run(spark, read_fact_stream(spark, f"{tmp}/in"), "facts_null", f"{tmp}/ck")) == 3
