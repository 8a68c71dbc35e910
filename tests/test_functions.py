from pyspark.sql import functions as F

from shoal import functions as sf


def test_time_functions(spark):
    df = spark.createDataFrame([(1704067207179, "2024-01-01", "2024-01-01 08:00:00", "bad")],
                               "ms long, d string, dt string, junk string")
    r = df.select(sf.to_date_str("ms").alias("a"), sf.to_ymdhms("ms").alias("b"),
                  sf.to_ts("d").alias("c"), sf.to_ts("dt", is_full=True).alias("e"),
                  sf.to_ts("junk").alias("f"), sf.format_text_time("junk", "yyyy-MM-dd").alias("g"),
                  sf.format_text_time("dt", "yyyy-MM-dd").alias("h"),
                  sf.visit_date("ms", "second").alias("i")).collect()[0]
    assert (r.a, r.b) == ("2024-01-01", "2024-01-01 00:00:07")
    assert r.c == 1704067200000 - 8 * 3600 * 1000      # midnight at +08:00
    assert r.e == 1704067200000                        # 08:00 at +08:00 is midnight UTC
    assert r.f is None and r.g is None and r.h == "2024-01-01" and r.i == "2024-01-01 00:00:07"


def test_expression_helpers(spark):
    df = spark.createDataFrame([("3", "4.50", {"a": "1", "b": "2", " c": "3"}, "a, c,b")],
                               "n string, p string, m map<string,string>, keys string")
    r = df.select(sf.decimal_product("n", "p").alias("amt"), sf.as_int(F.lit("x")).alias("bad"),
                  sf.keep_keys("m", "keys").alias("kept"),
                  sf.is_entry_page(F.lit("")).alias("e1"), sf.is_entry_page(F.lit("home")).alias("e2"),
                  sf.is_json(F.lit("[1]")).alias("j1"), sf.is_json_object(F.lit("[1]")).alias("j2"),
                  sf.to_json_value(F.lit(None).cast("string").alias("x"), F.lit(1).alias("y")).alias("t")
                  ).collect()[0]
    assert r.amt == "13.5000" and r.bad is None
    assert r.kept == {"a": "1", "b": "2", " c": "3"}    # exact names, no trimming: ' c' is listed
    assert (r.e1, r.e2, r.j1, r.j2) == (True, False, True, False)
    assert r.t == '{"y":1}'                             # NULL fields left out
