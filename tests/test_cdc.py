from shoal.operators import cdc
from shoal.sources.testdata import base_dic

SCHEMA = ("seq long, database string, `table` string, type string, ts string, "
          "data map<string,string>, old map<string,string>")


def _cart(seq, type_, num, old=None, src="O"):
    data = {"id": f"c{seq}", "user_id": "u", "sku_id": "s", "source_type": src,
            "source_id": "x", "sku_num": num}
    return (seq, "db", "cart_info", type_, "100", data, old)


def test_cart_add_rules(spark):
    rows = [
        _cart(1, "insert", "2"),
        _cart(2, "update", "1", {"sku_num": "3"}),          # lower: dropped
        _cart(3, "update", "3", {"sku_num": "3"}),          # equal: dropped
        _cart(4, "update", "5", {"sku_num": "3"}),          # higher: +2
        _cart(5, "update", "5", {"other": "1"}),            # no old.sku_num: dropped
        _cart(6, "bootstrap-insert", "7"),                  # not insert/update: dropped
        _cart(7, "insert", "4", src="F"),                   # no dictionary entry: dropped
        _cart(8, "update", "x", {"sku_num": "1"}),          # not a number: dropped
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["id"]: r for r in cdc.cart_add(df, base_dic(spark)).collect()}
    assert sorted(out) == ["c1", "c4"]
    assert out["c1"]["sku_num"] == "2" and out["c4"]["sku_num"] == "2"
    assert out["c4"]["source_type_name"] == "open line"


def test_envelope_filter(spark):
    rows = [(1, "db", "t", "insert", "1", {"a": "1"}, None),
            (2, "db", "t", "bootstrap-start", "1", {}, None),
            (3, "db", "t", "bootstrap-complete", "1", {}, None),
            (4, "db", "t", None, "1", {"a": "1"}, None),
            (5, "db", "t", "update", "1", None, None),
            (6, "db", "t", "delete", "1", {"a": "2"}, None)]
    kept = cdc.filter_change_envelope(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["seq"] for r in kept.collect()) == [1, 6]


def test_parse_change_log_text(spark):
    raw = spark.createDataFrame(
        [(1, '{"database":"d","table":"t","type":"insert","ts":"5","data":{"id":"1","n":"x"}}'),
         (2, "not json"), (3, '{"table":"t","type":"insert"}')], "seq long, value string")
    kept = cdc.filter_change_envelope(cdc.parse_change_log(raw)).collect()
    assert [(r["seq"], r["data"]["n"]) for r in kept] == [(1, "x")]


def test_project_missing_key(spark):
    df = spark.createDataFrame([(1, "db", "t", "insert", "1", {"a": "1"}, None)], SCHEMA)
    r = cdc.project_change_fields(df, ["a", "b"]).collect()[0]
    assert (r["a"], r["b"]) == ("1", None)


def test_order_wide_golden(spark):
    from pyspark.sql import functions as F

    from shoal.operators.joins import order_placed, order_wide_join
    from shoal.operators.upsert import materialize_upsert

    def detail(seq, did, oid, src):
        return (seq, "db", "order_detail", "insert", "100",
                {"id": did, "order_id": oid, "sku_num": "3", "order_price": "4.50",
                 "create_time": "2024-01-02 10:00:00", "source_type": src}, None)

    rows = [
        detail(1, "d1", "o1", "O"),
        detail(2, "d2", "o1", "F"),                                   # unknown code: dropped
        detail(3, "d3", "o2", "O"),                                   # no activity, no coupon
        (4, "db", "order_info", "insert", "100", {"id": "o1", "order_status": "1001",
                                                 "operate_time": "2024-01-02 10:00:00"}, None),
        (5, "db", "order_info", "update", "200", {"id": "o1", "order_status": "1002",
                                                 "operate_time": "2024-01-03 09:00:00"},
         {"order_status": "1001"}),
        (6, "db", "order_info", "insert", "100", {"id": "o2", "order_status": "1001"}, None),
        (7, "db", "order_detail_activity", "insert", "100", {"order_detail_id": "d1",
                                                             "activity_id": "a1"}, None),
        (8, "db", "order_detail_coupon", "insert", "100", {"order_detail_id": "d1",
                                                           "coupon_id": "c1"}, None),
    ]
    changes = spark.createDataFrame(rows, SCHEMA)
    wide = order_wide_join(changes, base_dic(spark), keep_seq=True)
    got = sorted((r.id, r.order_status, r.activity_id, r.coupon_id, r.split_original_amount,
                  r.date_id, r.operate_date_id, r.old["order_status"] if r.old else None)
                 for r in wide.collect())
    assert got == [("d1", "1001", "a1", "c1", "13.5000", "2024-01-02", "2024-01-02", None),
                   ("d1", "1002", "a1", "c1", "13.5000", "2024-01-02", "2024-01-03", "1001"),
                   ("d3", "1001", None, None, "13.5000", "2024-01-02", None, None)]
    latest = materialize_upsert(wide.withColumn("t", F.col("oi_ts").cast("long")), "id",
                                ["t", "oi_seq"]).collect()
    assert sorted((r.id, r.order_status) for r in latest) == [("d1", "1002"), ("d3", "1001")]
    assert sorted(r.id for r in order_placed(wide).collect()) == ["d1", "d3"]
    assert len(wide.columns) == 28   # 27 wide columns + oi_seq
