"""Change streams: folded they are the batch join; tombstones; idle retention; restarts."""

import collections
import json
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from shoal.operators.changes import DELETE, INSERT, fold_changes, join_changes
from shoal.operators.joins import equi_join
from shoal.operators.upsert import materialize_upsert, table_of_records
from shoal.sinks.writers import as_upsert_records
from shoal.streaming.changes import retracting_join

LEFT, RIGHT = "empno int, ename string, deptno int, lat long", "dept int, dname string, rat long"
HOW = ["inner", "left", "right", "full"]


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="shoal-changes-", dir="/tmp")


def sides(seed, n=40, keys=5):
    rng = random.Random(seed)
    rows = [(rng.random() < .6, rng.choice([*range(keys), None])) for _ in range(n)]
    left = [(i % 7, f"e{i % 3}", k, at) for at, (i, (l, k)) in enumerate(enumerate(rows)) if l]
    right = [(k, f"d{i % 2}", at) for at, (i, (l, k)) in enumerate(enumerate(rows)) if not l]
    return left, right


def one_by_one(left, right, how):
    """Changes by plain loops: the join of what has come is made anew after each row."""
    def joined(upto):
        ls, rs = [x for x in left if x[3] <= upto], [x for x in right if x[2] <= upto]
        out = collections.Counter((*a, *b) for a in ls for b in rs if a[2] is not None and a[2] == b[0])
        if how in ("left", "full"):
            out.update((*a, None, None, None) for a in ls if a[2] is None or all(a[2] != b[0] for b in rs))
        if how in ("right", "full"):
            out.update((None, None, None, None, *b) for b in rs if b[0] is None or all(a[2] != b[0] for a in ls))
        return out
    changes, before = [], collections.Counter()
    for at in sorted({x[3] for x in left} | {x[2] for x in right}):
        now = joined(at)
        changes += [(DELETE, at, 0, *r) for r in (before - now).elements()] + [(INSERT, at, 1, *r) for r in (now - before).elements()]
        before = now
    return changes, before


@pytest.mark.parametrize("how", HOW)
def test_batch_changes_equal_a_join_made_anew_after_each_row(spark, how):
    left, right = sides(3)
    got = join_changes(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "deptno", "dept", "lat", "rat", how)
    want, held = one_by_one(left, right, how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert collections.Counter(map(tuple, fold_changes(got).collect())) == held


def write(path, batches):
    """Each list of rows is one file, so one micro-batch."""
    os.makedirs(path, exist_ok=True)
    start = len(os.listdir(path))
    for i, rows in enumerate(batches):
        name = f"{path}/part-{start + i:03d}.json"
        with open(name, "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows))
        os.utime(name, (1_700_000_000 + start + i,) * 2)


def read(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def run(stream, tmp, out="out"):
    q = stream.writeStream.format("parquet").option("path", f"{tmp}/{out}").option("checkpointLocation", f"{tmp}/ck-{out}") \
        .trigger(availableNow=True).start()
    q.awaitTermination(600)
    return stream.sparkSession.read.parquet(f"{tmp}/{out}")


def as_rows(schema, rows, op=None):
    names = [c.split()[0] for c in schema.split(", ")]
    return [dict(zip(names, r, strict=True)) | ({"op": op} if op else {}) for r in rows]


@pytest.mark.parametrize("how", HOW)
def test_stream_changes_fold_to_the_batch_join(spark, tmp, how):
    """Random interleavings, rows that go again, a restart in the middle."""
    left, right = sides(hash(how) % 50, 46)
    rng = random.Random(len(how))
    gone_l, gone_r = rng.sample(left, 6), rng.sample(right, 4)
    events = sorted([("l", INSERT, r, r[3]) for r in left] + [("r", INSERT, r, r[2]) for r in right]
                    + [("l", DELETE, r, r[3] + rng.randint(1, 30) + .5) for r in gone_l]
                    + [("r", DELETE, r, r[2] + rng.randint(1, 30) + .5) for r in gone_r], key=lambda e: e[3])
    cuts = sorted({0, *rng.sample(range(len(events)), 6), len(events)})
    batches = [events[a:b] for a, b in zip(cuts, cuts[1:])]

    def files(part):
        for side, schema in (("l", LEFT), ("r", RIGHT)):
            write(f"{tmp}/{side}", [[x for s, op, r, _ in b if s == side for x in as_rows(schema, [r], op)] for b in part])

    def stream():
        return retracting_join(read(spark, f"{tmp}/l", f"{LEFT}, op string"), read(spark, f"{tmp}/r", f"{RIGHT}, op string"),
                               "deptno", "dept", how)

    half = len(batches) // 2
    files(batches[:half])
    run(stream(), tmp)
    files(batches[half:])
    changes = run(stream(), tmp)
    kept_l, kept_r = [r for r in left if r not in gone_l], [r for r in right if r not in gone_r]
    want = equi_join(spark.createDataFrame(kept_l, LEFT), spark.createDataFrame(kept_r, RIGHT), "deptno", "dept", how)
    got = fold_changes(changes.select("op", "empno", "ename", "deptno", "lat", "dept", "dname", "rat"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    if how != "inner":
        assert changes.where(F.col("op") == DELETE).count() > 0
    # no row is taken back before it came, and a row that went is not out any more
    assert all(n >= 0 for n in collections.Counter(
        {tuple(r)[:-1]: r.n for r in changes.drop("change").groupBy("empno", "ename", "deptno", "lat", "dept", "dname", "rat")
         .agg(F.sum(F.when(F.col("op") == INSERT, 1).otherwise(-1)).alias("n")).collect()}).values())


def test_left_row_comes_out_at_once_and_is_taken_back(spark, tmp):
    write(f"{tmp}/l", [as_rows(LEFT, [(1, "a", 10, 0)]), []])
    write(f"{tmp}/r", [[], as_rows(RIGHT, [(10, "x", 1)])])
    stream = retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "left")
    got = run(stream, tmp).orderBy("change").select("op", "empno", "dname").collect()
    assert [tuple(r) for r in got] == [(INSERT, 1, None), (DELETE, 1, None), (INSERT, 1, "x")]


def test_one_batch_emits_nothing_that_it_takes_back(spark, tmp):
    write(f"{tmp}/l", [as_rows(LEFT, [(1, "a", 10, 0), (2, "b", 11, 1), (2, "b", 11, 1)])])
    write(f"{tmp}/r", [as_rows(RIGHT, [(10, "x", 1)])])
    stream = retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "full")
    got = run(stream, tmp).select("op", "empno", "dname").collect()
    assert sorted(map(tuple, got), key=str) == [(INSERT, 1, "x"), (INSERT, 2, None), (INSERT, 2, None)]


def test_a_hot_key_is_dealt_over_groups(spark, tmp):
    left = [(i, "e", 1 if i % 3 else i, i) for i in range(90)]
    write(f"{tmp}/l", [as_rows(LEFT, left[:50]), as_rows(LEFT, left[50:])])
    write(f"{tmp}/r", [[], as_rows(RIGHT, [(1, "x", 1), (1, "y", 2), (3, "z", 3)])])
    stream = retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "left", salts=8, salt_by="empno")
    want = equi_join(spark.createDataFrame(left, LEFT), spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 3)], RIGHT), "deptno", "dept", "left")
    got = fold_changes(run(stream, tmp)).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(ValueError):
        retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "full", salts=8)


def test_chained_joins_fold_to_the_chained_batch_join(spark, tmp):
    rng = random.Random(8)
    mid = "mkey int, mval string, mat long"
    left, right = sides(5, 30)
    third = [(rng.randrange(7), f"m{i}", i) for i in range(6)]
    write(f"{tmp}/l", [as_rows(LEFT, left[i::4]) for i in range(4)])
    write(f"{tmp}/r", [as_rows(RIGHT, right[i::4]) for i in range(4)])
    write(f"{tmp}/m", [[], as_rows(mid, third[:3]), [], as_rows(mid, third[3:])])
    one = retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "left")
    two = retracting_join(one, read(spark, f"{tmp}/m", mid), "empno", "mkey", "left")
    l, r, m = (spark.createDataFrame(x, s) for x, s in ((left, LEFT), (right, RIGHT), (third, mid)))
    want = equi_join(equi_join(l, r, "deptno", "dept", "left"), m, "empno", "mkey", "left")
    got = fold_changes(run(two, tmp)).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_idle_rows_are_dropped_and_meetings_renew(spark, tmp):
    """A match inside the retention joins; one after it doesn't; the number of state rows falls."""
    for side in "lr":
        os.makedirs(f"{tmp}/{side}")
    stream = retracting_join(read(spark, f"{tmp}/l", LEFT), read(spark, f"{tmp}/r", RIGHT), "deptno", "dept", "left", idle_ms=6000)
    q = stream.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck") \
        .trigger(processingTime="200 milliseconds").start()

    def rows():
        return sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) if q.lastProgress else 0

    def until(test, seconds=60):
        end = time.time() + seconds
        while not test():
            assert time.time() < end and q.isActive, q.exception()
            time.sleep(.1)

    def emitted():
        try:
            return spark.read.schema("change long, op string, empno int, ename string, deptno int, lat long, dept int, dname string, rat long") \
                .parquet(f"{tmp}/out").select("op", "empno", "dname").collect()
        except Exception:  # nothing written yet
            return []

    try:
        write(f"{tmp}/l", [as_rows(LEFT, [(1, "a", 10, 0), (2, "b", 20, 0)])])
        until(lambda: len(emitted()) == 2)
        write(f"{tmp}/r", [as_rows(RIGHT, [(10, "in time", 1)])])
        until(lambda: (INSERT, 1, "in time") in map(tuple, emitted()))
        held = rows()
        until(lambda: rows() < held)  # both keys have been idle
        time.sleep(7)
        write(f"{tmp}/r", [as_rows(RIGHT, [(20, "late", 2)])])
        write(f"{tmp}/l", [as_rows(LEFT, [(3, "c", 10, 3)])])
        until(lambda: any(r.empno == 3 for r in emitted()))
        time.sleep(1)
    finally:
        q.stop()
    got = sorted(map(tuple, emitted()), key=str)
    assert got == sorted([(INSERT, 1, None), (INSERT, 2, None), (DELETE, 1, None), (INSERT, 1, "in time"), (INSERT, 3, None)], key=str)


def test_tombstones_remove_keys(spark):
    rows = [(1, 1, "+I", 7, "a", None), (2, 1, "-D", 7, "a", None), (3, 1, "+I", 7, "a", "x"), (4, 2, "+I", 8, "b", None), (5, 2, "-D", 8, "b", None)]
    df = spark.createDataFrame(rows, "seq long, nth int, op string, id int, ename string, dname string")
    records = as_upsert_records(df.drop("nth"), ["id"], carry=["seq"])
    assert records.where("value is null").select("key").distinct().count() == 2
    assert records.columns == ["seq", "key", "value"] and "op" not in records.first()["value"]
    assert [tuple(r) for r in table_of_records(records, "id int, ename string, dname string").collect()] == [(7, "a", "x")]
    newest = materialize_upsert(df, "id", "seq", F.col("op") == "-D")
    assert [r.id for r in newest.collect()] == [7]
    assert table_of_records(records.limit(0), "id int").count() == 0


def test_upsert_topic_of_a_left_join_is_the_left_join(spark):
    left, right = sides(11, 60)
    left = [(i, *r[1:]) for i, r in enumerate(left)]  # the key of the topic
    right = [r for i, r in enumerate(right) if r[0] not in {x[0] for x in right[:i]}]
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    changes = join_changes(l, r, "deptno", "dept", "lat", "rat", "left")
    records = as_upsert_records(changes, ["empno"], carry=["at", "nth"])
    assert records.groupBy("key").count().where("count > 1").count() > 0 and records.where("value is null").count() > 0
    got = table_of_records(records, f"{LEFT}, {RIGHT}", ["at", "nth"])
    want = equi_join(l, r, "deptno", "dept", "left")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def order_records(seed=3, n=14):
    """Change records of orders, details, activities and coupons, by arrival; some details have neither."""
    from test_streaming import _change, _detail, _order
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows += [_detail(10 * i, f"o{i}", 1000 + i), _order(10 * i + 1, f"o{i}", 1000 + i)]
        if i % 2:
            rows.append(_order(10 * i + 2, f"o{i}", 1010 + i, "update"))
        if i % 3 == 0:
            rows.append(_change(10 * i + 3, "order_detail_activity", 1001, order_detail_id=f"d{10 * i}", activity_id="a"))
        if i % 4 == 0:
            rows.append(_change(10 * i + 4, "order_detail_coupon", 1002, order_detail_id=f"d{10 * i}", coupon_id="c"))
    return sorted(rows, key=lambda r: rng.random())


def test_order_change_stream_folds_to_the_batch_wide_join(spark, tmp):
    from shoal.operators.cdc import filter_change_envelope, parse_change_log
    from shoal.operators.joins import order_wide_join
    from shoal.sources.kafka import read_text_stream
    from shoal.sources.testdata import base_dic
    from shoal.streaming import jobs
    rows = order_records()
    write(f"{tmp}/in", [rows[i:i + 9] for i in range(0, len(rows), 9)])
    joined = jobs.order_changes_stream(parse_change_log(read_text_stream(spark, f"{tmp}/in", 1)), None)
    text = spark.createDataFrame([(r["seq"], r["value"]) for r in rows], "seq long, value string")
    want = order_wide_join(filter_change_envelope(parse_change_log(text)), base_dic(spark))
    columns = ["id", "order_id", "type", "oi_ts", "activity_id", "coupon_id", "split_original_amount"]
    wide = jobs.order_wide_batch(run(joined, tmp), base_dic(spark))
    assert {"change", "op"} < set(wide.columns)
    got = fold_changes(wide.select("op", *columns))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(columns).collect()), key=str)


def test_order_job_writes_upserts_and_tombstones(spark, tmp):
    import shoal.__main__ as cli
    rows = order_records()
    write(f"{tmp}/in", [rows[i:i + 9] for i in range(0, len(rows), 9)])
    write(f"{tmp}/dic", [[{"dic_code": "O", "dic_name": "open"}]])
    q = cli.run(["order-pre-process", "--source", f"{tmp}/in", "--sink", f"{tmp}/sink", "--checkpoint", f"{tmp}/ck", "--once", "--per-trigger", "1",
                 "--dictionary", f"{tmp}/dic", "--retract", "--idle", "0"], spark)
    q.awaitTermination(600)
    records = spark.read.schema("change long, key string, value string, batch long").json(f"{tmp}/sink")
    assert records.where("value is null").count() > 0
    table = table_of_records(records, "id string, activity_id string, coupon_id string, source_type_name string", ["batch", "change"])
    got = {r.id: (r.activity_id, r.coupon_id, r.source_type_name) for r in table.collect()}
    assert got == {f"d{10 * i}": ("a" if i % 3 == 0 else None, "c" if i % 4 == 0 else None, "open") for i in range(14)}


def test_records_dealt_by_the_columns_of_their_key_are_not_shuffled_again(spark):
    left, right = sides(11, 60)
    left = [(i, *r[1:]) for i, r in enumerate(left)]
    right = [r for i, r in enumerate(right) if r[0] not in {x[0] for x in right[:i]}]
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = join_changes(l, r, "empno", "dept", "lat", "rat", "left")
        order = ["at", "nth"]
        records = as_upsert_records(changes.withColumn("number", F.col("empno")), ["empno"], carry=[*order, "number"])
        plain, dealt = (table_of_records(records, f"{LEFT}, {RIGHT}", order, **by) for by in ({}, {"by": "number"}))
        exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") for df in (plain, dealt)]
        assert exchanges[1] == exchanges[0] - 1
        assert records.where("value is null").count() > 0
        want = sorted(map(tuple, equi_join(l, r, "empno", "dept", "left").collect()), key=str)
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, dealt.collect()), key=str) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # removed keys, and rows whose key column is NULL
    rows = [(1, "+I", 7, "a"), (2, "-D", 7, "a"), (3, "+I", None, "b"), (4, "+I", None, "c"), (5, "+I", 8, "d")]
    df = spark.createDataFrame(rows, "seq long, op string, id int, ename string").withColumn("n", F.col("id"))
    got = table_of_records(as_upsert_records(df, ["id"], carry=["seq", "n"]), "id int, ename string", "seq", by=["n"])
    assert sorted(map(tuple, got.collect()), key=str) == [(8, "d"), (None, "c")]


def test_newest_order_records_are_found_where_the_join_left_them(spark, tmp):
    import datetime

    from shoal.plans.reports import REGISTRY
    day = datetime.datetime(2024, 1, 1)
    kinds = {"lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
             "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
             "customer": "c_custkey long, c_nationkey int"}
    rows = {"lineitem": [(o, 5, 6, n, 2.0, 10.0, .01 * (5 + n % 2), 0.0, "N", "O", day) for o in (1, 2) for n in (1, 2)],
            "orders": [(1, 3, "P", day), (2, 4, "F", day)], "customer": [(3, 9)]}
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.parquet(f"{tmp}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = REGISTRY["order_wide_upsert"](spark, tmp)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(key" not in plan and "Union" in plan
        got = sorted((r.order_id, r.id.split("-")[1], r.type, r.order_status, r.province_id, r.activity_id) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [("1", "1", "update", "P", "9", "6"), ("1", "2", "update", "P", "9", None),
                   ("2", "1", "insert", "F", None, "6"), ("2", "2", "insert", "F", None, None)]
