from pyspark.sql import functions as F

from shoal.operators import joins
from shoal.operators.upsert import materialize_upsert


def test_interval_join_bounds(spark):
    emp = spark.createDataFrame([(1, "e", 10, 1000)], "empno int, ename string, deptno int, ts long")
    dept = spark.createDataFrame([(10, f"d{d}", 1000 + d) for d in (-6, -5, 0, 5, 6)] + [(11, "x", 1000)],
                                 "deptno int, dname string, dts long")
    out = joins.interval_join(emp, dept, "deptno", "ts", "dts", -5, 5).collect()
    assert sorted(r["dname"] for r in out) == ["d-5", "d0", "d5"]
    assert out[0].asDict().keys() == {"empno", "ename", "deptno", "ts", "dname", "dts"}


def test_interval_join_brute_force(spark):
    import random
    rnd = random.Random(5)
    left = [(i, rnd.randrange(3), rnd.randrange(1000)) for i in range(200)]
    right = [(i, rnd.randrange(3), rnd.randrange(1000)) for i in range(200)]
    l = spark.createDataFrame(left, "lid int, k int, lt long")
    r = spark.createDataFrame(right, "rid int, k int, rt long")
    for lo, hi in ((-5, 5), (0, 30), (-40, -10), (0, 0)):
        got = sorted((x["lid"], x["rid"]) for x in joins.interval_join(l, r, "k", "lt", "rt", lo, hi).collect())
        want = sorted((a, b) for a, ka, ta in left for b, kb, tb in right
                      if ka == kb and ta + lo <= tb <= ta + hi)
        assert got == want, (lo, hi)


def test_interval_join_left_and_refused_types(spark):
    import pytest
    l = spark.createDataFrame([(1, 1, 100), (2, 1, 900)], "lid int, k int, lt long")
    r = spark.createDataFrame([(7, 1, 103)], "rid int, k int, rt long")
    got = joins.interval_join(l, r, "k", "lt", "rt", -5, 5, "left").collect()
    assert sorted((x["lid"], x["rid"]) for x in got) == [(1, 7), (2, None)]
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            joins.interval_join(l, r, "k", "lt", "rt", -5, 5, how)


def test_lookup_join_leaves_the_way_to_spark(spark):
    facts = spark.createDataFrame([(1, "O"), (2, "F"), (3, "O")], "id int, code string")
    dic = spark.createDataFrame([("O", "open")], "dic_code string, dic_name string")
    got = {}
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got[limit] = sorted(map(tuple, joins.lookup_join(facts, dic, "code", "dic_code").collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got["10m"] == got["-1"] == [(1, "O", "open"), (3, "O", "open")]


def test_equi_joins(spark):
    e = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "empno int, ename string, deptno int")
    d = spark.createDataFrame([(10, "x"), (30, "y")], "d_deptno int, dname string")
    counts = {h: joins.equi_join(e, d, "deptno", "d_deptno", h).count() for h in ("inner", "left", "right", "full")}
    assert counts == {"inner": 1, "left": 2, "right": 2, "full": 3}


def test_materialize_upsert_newest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")],
                               "id string, v long, s string")
    got = sorted(map(tuple, materialize_upsert(df, "id", "v").collect()))
    assert got == [("a", 3, "z"), ("b", 1, "q")]
    assert materialize_upsert(df, "id", "v").columns == ["id", "v", "s"]


def test_facts_are_not_shuffled_for_the_dictionary(spark):
    from shoal.sources.testdata import base_dic
    facts = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "O").when(F.col("id") % 3 == 1, "F").alias("code"))
    joined = joins.lookup_join(facts, base_dic(spark), "code", "dic_code")
    # before anything has run: adaptive execution learns the size only after the shuffle
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in joined.select("code", "dic_name").collect()} == {("O", "open line")} and joined.count() == 34
    assert [(r.dic_code, r.dic_name, r.parent_code, str(r.create_time), r.operate_time) for r in base_dic(spark).collect()] == [
        ("O", "open line", "10", "2020-01-01 00:00:00", None), ("X", "unused code", "10", "2020-01-01 00:00:00", None)]


def test_tables_read_in_many_parts_are_not_dealt_out(spark):
    import tempfile

    from shoal.sources.testdata import in_parts
    path, cores = tempfile.mkdtemp(prefix="shoal-parts-", dir="/tmp"), spark.sparkContext.defaultParallelism
    spark.range(200).repartition(1).write.parquet(f"{path}/one")
    spark.range(200).repartition(2 * cores).write.parquet(f"{path}/many")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a file is a part
    try:
        one, many = (in_parts(spark.read.parquet(f"{path}/{name}"), "id") for name in ("one", "many"))
        assert "Exchange" in one._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in one.collect()) == sorted(r.id for r in many.collect()) == list(range(200))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
