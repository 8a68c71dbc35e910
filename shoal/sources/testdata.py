"""Input shapes built from the driver's parquet tables.

The jobs read JSON text from message topics. For tests and the bench the same
shapes are derived, with Spark, from the generated tables, so every query's
work grows with the tables. ``oracle_sql`` in ``__spark_entry__`` restates the
same rules in plain SQL.

Rules (fixed values; the SQL oracle repeats them):

* page log from ``events``: ``seq = event_id``, ``mid = 'mid_' || user_id``,
  ``k = props.k``, ``is_new = '1'`` when ``k % 2 = 0`` else ``'0'``,
  ``page_id = event_type``; ``last_page_id`` is NULL for view and signup,
  ``''`` for click and ``'home'`` otherwise; ``ts`` = epoch ms.
* jump clock: ``ts = 1704067200000 + (epoch_ms - 1704067200000) div 4000``
  so that gaps between a device's events are near ten seconds.
* raw log text from ``events``: ``err`` on error events (its code a number, or
  the text ``E<k>`` where ``k % 5 = 0``), ``start`` (and no ``page``) on signup,
  ``k % 4`` displays on view (an empty object instead of a list when 0),
  ``k % 3`` actions on click (no list when 0); fields at every level that no
  job names (``common.ba``, ``page.item``, ``displays[].pos_id``,
  ``actions[].extra``, ``extra``); dirty texts of six kinds where
  ``event_id % 97 = 0``.
* change log from ``lineitem``, ``orders``, ``customer``, ``supplier``,
  ``part``: see ``change_log``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.functions.time import ntz_epoch_millis
from shoal.operators.sequence import neighbour

JUMP_EPOCH_MS = 1704067200000
JUMP_COMPRESSION = 4000
DIRTY_EVERY = 97
# by turns: broken text, an array, a scalar, no text, no ``common``, no ``ts``
DIRTY_TEXTS = ("{bad", "[1]", '"x"', "", '{"a":1}', '{"common":{"mid":"mid_1","is_new":"1"}}')

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over ``spark.sql.shuffle.partitions`` partitions by ``keys``, as
    a keyed topic deals its records. The generated tables are single files, and
    building records is per-row work."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def in_parts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table that Spark reads in as many parts as it has cores, or more, as they
    are; a smaller table ``spread``. A large table comes in parts already, and what reads its
    records shuffles them by keys of its own: dealing them out would shuffle every row once more."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else spread(df, *keys)


def _epoch_ms(ts: Column) -> Column:
    return ntz_epoch_millis(ts)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def _last_page_id() -> Column:
    et = F.col("event_type")
    return (F.when(et.isin("view", "signup"), F.lit(None).cast("string"))
            .when(et == "click", F.lit(""))
            .otherwise(F.lit("home")))


def _common() -> Column:
    return F.struct(
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.when(_k() % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit("web").alias("ch"),
    )


def page_log(events: DataFrame, clock: str = "real") -> DataFrame:
    """Page log records (already parsed): ``seq, common, page, ts``."""
    ms = _epoch_ms(F.col("ts"))
    if clock == "jump":
        ms = F.lit(JUMP_EPOCH_MS) + F.floor((ms - F.lit(JUMP_EPOCH_MS)) / JUMP_COMPRESSION)
    elif clock != "real":
        raise ValueError("clock must be 'real' or 'jump'")
    return events.select(
        F.col("event_id").alias("seq"),
        _common().alias("common"),
        F.struct(F.col("event_type").alias("page_id"),
                 _last_page_id().alias("last_page_id"),
                 F.lit(None).cast("long").alias("during_time")).alias("page"),
        ms.cast("long").alias("ts"),
    )


def raw_log_text(events: DataFrame) -> DataFrame:
    """Log topic as text: ``seq, value``."""
    k = _k()
    et = F.col("event_type")
    ms = _epoch_ms(F.col("ts"))
    no = F.lit(None).cast("variant")
    common = _common().withField("ba", F.concat(F.lit("b"), (F.col("user_id") % 7).cast("string")))
    page = F.when(et != "signup", F.struct(
        et.alias("page_id"), _last_page_id().alias("last_page_id"),
        (k * 100).alias("during_time"), F.concat(F.lit("item_"), k.cast("string")).alias("item")))
    start = F.when(et == "signup", F.struct(F.lit("icon").alias("entry"),
                                            k.alias("loading_time")))
    code = F.when(k % 5 == 0, F.concat(F.lit("E"), k.cast("string")).cast("variant")).otherwise(k.cast("variant"))
    err = F.when(et == "error", F.struct(code.alias("error_code"),
                                         F.concat(F.lit("error "), k.cast("string")).alias("msg")))
    n_disp = k % 4
    listed = F.transform(
        F.sequence(F.lit(1).cast("long"), F.greatest(n_disp, F.lit(1))),
        lambda i: F.struct(F.concat(F.lit("sku_"), i.cast("string")).alias("item"),
                           F.lit("sku_id").alias("item_type"), i.alias("order"), (i * 10).alias("pos_id")))
    displays = F.when(et == "view", F.when(n_disp > 0, F.to_variant_object(listed))
                      .otherwise(F.parse_json(F.lit("{}")))).otherwise(no)
    n_act = k % 3
    actions = F.when((et == "click") & (n_act > 0), F.transform(
        F.sequence(F.lit(1).cast("long"), n_act),
        lambda i: F.struct(F.concat(F.lit("act_"), i.cast("string")).alias("action_id"),
                           F.concat(F.lit("sku_"), i.cast("string")).alias("item"),
                           (ms + i).alias("ts"), F.struct(i.alias("n")).alias("extra"))))
    record = F.struct(common.alias("common"), page.alias("page"), start.alias("start"),
                      err.alias("err"), displays.alias("displays"), actions.alias("actions"),
                      ms.alias("ts"), F.struct(k.alias("k"), F.array(F.lit("a"), et).alias("tags")).alias("extra"))
    turn = F.pmod(F.floor(F.col("event_id") / DIRTY_EVERY), F.lit(len(DIRTY_TEXTS))).cast("int")
    dirty = F.array(*[F.lit(t) for t in DIRTY_TEXTS])[turn]
    value = F.when(F.col("event_id") % DIRTY_EVERY == 0, dirty).otherwise(F.to_json(record))
    return spread(events, "event_id").select(F.col("event_id").alias("seq"), value.alias("value"))


# ---------------------------------------------------------------- change log

def _s(c) -> Column:
    """Column -> text the same way in Spark and in the SQL oracle."""
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(16,2)").cast("string")


def _day_time(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def _epoch_s(c: str) -> Column:
    return F.floor(ntz_epoch_millis(F.col(c)) / 1000).cast("long")


def detail_id() -> Column:
    """Unique id of a lineitem row: six values joined with '-'."""
    return F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                       _s("l_suppkey"), F.date_format("l_shipdate", "yyyy-MM-dd"),
                       _money("l_extendedprice"))


def _envelope(table_name: str, type_: Column, ts: Column, data: Column, old: Column,
              seq: Column) -> list[Column]:
    return [seq.cast("long").alias("seq"), F.lit("shop").alias("database"),
            F.lit(table_name).alias("table"), type_.alias("type"), ts.cast("string").alias("ts"),
            data.alias("data"), old.cast("map<string,string>").alias("old")]


def _kv(**cols) -> Column:
    parts = []
    for k, v in cols.items():
        parts += [F.lit(k), v]
    return F.create_map(*parts)


def _no_map() -> Column:
    return F.lit(None).cast("map<string,string>")

# sequence ranges of the change-log parts, in the order in which they arrive (rows of
# lineitem that share order and line numbers share a number)
SEQ_PART = 1 << 40


def order_detail_changes(lineitem: DataFrame) -> DataFrame:
    data = _kv(id=detail_id(), order_id=_s("l_orderkey"), sku_id=_s("l_partkey"),
               sku_name=F.concat(F.lit("sku_"), _s("l_partkey")),
               sku_num=F.col("l_quantity").cast("long").cast("string"),
               create_time=_day_time("l_shipdate"), source_type=F.col("l_linestatus"),
               source_id=_s("l_suppkey"), split_total_amount=_money("l_extendedprice"),
               split_activity_amount=_money("l_discount"),
               split_coupon_amount=_money("l_tax"), order_price=_money("l_extendedprice"))
    seq = F.lit(1 * SEQ_PART) + F.col("l_orderkey") * 64 + F.col("l_linenumber")
    return lineitem.select(*_envelope("order_detail", F.lit("insert"), _epoch_s("l_shipdate"),
                                      data, _no_map(), seq))


def order_info_changes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Every order is inserted; orders in status 'P' are inserted as 'O' and
    later updated to 'P' one day on."""
    j = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"),
                                    F.col("c_nationkey")), "o_custkey", "left")
    pending = F.col("o_orderstatus") == "P"

    def rows(kind: str):
        is_upd = kind == "update"
        status = F.lit("P") if is_upd else F.when(pending, F.lit("O")).otherwise(F.col("o_orderstatus"))
        shift = 86400 if is_upd else 0
        op_time = F.date_format(F.col("o_orderdate") + F.expr(f"INTERVAL {shift} SECONDS"),
                                "yyyy-MM-dd HH:mm:ss")
        data = _kv(id=_s("o_orderkey"), user_id=_s("o_custkey"), province_id=_s("c_nationkey"),
                   operate_time=op_time, order_status=status)
        old = _kv(order_status=F.lit("O")) if is_upd else _no_map()
        seq = F.lit((3 if is_upd else 2) * SEQ_PART) + F.col("o_orderkey")
        src = j.where(pending) if is_upd else j
        return src.select(*_envelope("order_info", F.lit(kind), _epoch_s("o_orderdate") + shift,
                                     data, old, seq))

    return rows("insert").unionByName(rows("update"))


def activity_changes(lineitem: DataFrame) -> DataFrame:
    data = _kv(order_detail_id=detail_id(), activity_id=_s("l_suppkey"),
               activity_rule_id=_money("l_discount"))
    seq = F.lit(4 * SEQ_PART) + F.col("l_orderkey") * 64 + F.col("l_linenumber")
    return lineitem.where(F.col("l_discount") > 0.05).select(
        *_envelope("order_detail_activity", F.lit("insert"), _epoch_s("l_shipdate"), data,
                   _no_map(), seq))


def coupon_changes(lineitem: DataFrame) -> DataFrame:
    data = _kv(order_detail_id=detail_id(), coupon_id=_s("l_partkey"))
    seq = F.lit(5 * SEQ_PART) + F.col("l_orderkey") * 64 + F.col("l_linenumber")
    return lineitem.where(F.col("l_returnflag") == "R").select(
        *_envelope("order_detail_coupon", F.lit("insert"), _epoch_s("l_shipdate"), data,
                   _no_map(), seq))


def cart_changes(lineitem: DataFrame, bucket_width: int = 1 << 12) -> DataFrame:
    """Cart rows keyed ``l_orderkey-l_linenumber``; within a cart id, rows in
    order of ``(l_partkey, l_suppkey, l_shipdate, l_extendedprice)``: the first
    is an insert, later ones updates whose ``old.sku_num`` is the quantity of
    the row before."""
    base = lineitem.select(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("cart_id"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        "l_extendedprice", "l_linestatus",
        F.col("l_quantity").cast("long").cast("string").alias("qty"))
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    with_prev = neighbour(base, "cart_id", order, F.floor(F.col("l_partkey") / bucket_width),
                          ["qty"], "prev", "prev")
    is_first = F.col("prev").isNull()
    data = _kv(id=F.col("cart_id"), user_id=_s("l_suppkey"), sku_id=_s("l_partkey"),
               source_type=F.col("l_linestatus"), source_id=_s("l_suppkey"),
               sku_num=F.col("qty"))
    old = F.when(is_first, _no_map()).otherwise(_kv(sku_num=F.col("prev.qty")))
    kind = F.when(is_first, F.lit("insert")).otherwise(F.lit("update"))
    seq = F.lit(6 * SEQ_PART) + F.col("l_orderkey") * 64 + F.col("l_linenumber")
    return with_prev.select(*_envelope("cart_info", kind, _epoch_s("l_shipdate"), data, old, seq))


DIM_SOURCES = {
    # source table -> (key column, columns written to the change record)
    "customer": ("c_custkey", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    "supplier": ("s_suppkey", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
    "part": ("p_partkey", ["p_partkey", "p_name", "p_brand", "p_type", "p_size",
                           "p_retailprice"]),
}


def _dim_value(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    return _money(c) if t == "double" else _s(c)


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the dimension sources plus noise the router must drop:

    * every customer / supplier / part row inserted with all its columns;
    * customers with a negative balance later updated with only
      ``c_custkey`` and ``c_acctbal = '0.00'`` (a partial record);
    * suppliers with a negative balance deleted (still an upsert downstream);
    * orders inserted (no configuration: dropped);
    * one ``bootstrap-start`` and one ``bootstrap-complete`` record for each region;
    * for each nation a record without ``data`` and one without ``type``.

    A key's later record has a lower ``seq`` than its first one, as if it had come
    through a lower-numbered topic partition: only ``ts`` tells which is newer.
    """
    parts = []
    for code, (name, (pk, cols)) in enumerate(DIM_SOURCES.items()):
        df = table(spark, sf_dir, name)
        data = _kv(**{c: _dim_value(df, c) for c in cols})
        seq = F.lit((8 + code) * SEQ_PART) + F.col(pk)
        parts.append(df.select(*_envelope(name, F.lit("insert"), F.lit("1700000000"), data,
                                          _no_map(), seq)))
    cust = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    parts.append(cust.select(*_envelope(
        "customer", F.lit("update"), F.lit("1700000100"),
        _kv(c_custkey=_s("c_custkey"), c_acctbal=F.lit("0.00")),
        _kv(c_acctbal=_money("c_acctbal")), F.lit(SEQ_PART) + F.col("c_custkey"))))
    supp = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)
    parts.append(supp.select(*_envelope(
        "supplier", F.lit("delete"), F.lit("1700000200"),
        _kv(**{c: _dim_value(supp, c) for c in DIM_SOURCES["supplier"][1]}), _no_map(),
        F.lit(2 * SEQ_PART) + F.col("s_suppkey"))))
    orders = table(spark, sf_dir, "orders")
    parts.append(orders.select(*_envelope(
        "orders", F.lit("insert"), F.lit("1700000000"),
        _kv(o_orderkey=_s("o_orderkey"), o_custkey=_s("o_custkey")), _no_map(),
        F.lit(14 * SEQ_PART) + F.col("o_orderkey"))))
    region = table(spark, sf_dir, "region")
    for i, kind in enumerate(("bootstrap-start", "bootstrap-complete")):
        # bootstrap markers carry no row data; one per region row
        parts.append(region.select(*_envelope(
            "customer", F.lit(kind), F.lit("1699999999"),
            F.create_map().cast("map<string,string>"), _no_map(),
            F.lit((15 + i) * SEQ_PART) + F.col("r_regionkey"))))
    nation = table(spark, sf_dir, "nation")
    parts.append(nation.select(*_envelope("customer", F.lit("insert"), F.lit("1700000300"), _no_map(),
                                          _no_map(), F.lit(17 * SEQ_PART) + F.col("n_nationkey"))))
    parts.append(nation.select(*_envelope("customer", F.lit(None).cast("string"), F.lit("1700000300"),
                                          _kv(c_custkey=_s("n_nationkey")), _no_map(),
                                          F.lit(18 * SEQ_PART) + F.col("n_nationkey"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_change_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as topic text, and a broken text for each region."""
    text = dim_changes(spark, sf_dir).select(
        "seq", F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value"))
    broken = table(spark, sf_dir, "region").select(
        (F.lit(19 * SEQ_PART) + F.col("r_regionkey")).alias("seq"), F.lit('{"table": "customer", "data"').alias("value"))
    return text.unionByName(broken)


def order_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change topic as the order and cart jobs see it."""
    li = in_parts(table(spark, sf_dir, "lineitem"), "l_orderkey")
    return (order_detail_changes(li)
            .unionByName(order_info_changes(table(spark, sf_dir, "orders"),
                                            table(spark, sf_dir, "customer")))
            .unionByName(activity_changes(li))
            .unionByName(coupon_changes(li))
            .unionByName(cart_changes(li)))


# The dictionary rows (only code 'O' is present, so lines in
# status 'F' find no entry and the inner lookup drops them).
BASE_DIC_ROWS = [
    ("O", "open line", "10", "2020-01-01 00:00:00", None),
    ("X", "unused code", "10", "2020-01-01 00:00:00", None),
]


def base_dic(spark: SparkSession) -> DataFrame:
    """The dictionary, given in the plan itself: Spark knows its bytes before it runs and sends it
    along. A frame made from Python rows has no known size: the facts would be shuffled by the
    few codes first, and adaptive execution learns too late that they need not be."""
    fields = ("dic_code", "dic_name", "parent_code", "create_time", "operate_time")
    rows = [F.struct(*[F.lit(v).cast("string").alias(f) for f, v in zip(fields, row, strict=True)]) for row in BASE_DIC_ROWS]
    return spark.range(1).select(F.inline(F.array(*rows))) \
        .select("dic_code", "dic_name", "parent_code",
                F.to_timestamp_ntz("create_time").alias("create_time"),
                F.to_timestamp_ntz("operate_time").alias("operate_time"))


# The configuration table (source -> dimension table, columns).
TABLE_CONFIG_ROWS = [
    ("customer", "dim_customer", "c_custkey,c_name,c_acctbal", "c_custkey", None),
    ("supplier", "dim_supplier", "s_suppkey,s_name,s_nationkey", "s_suppkey", None),
    ("part", "dim_part", "p_partkey,p_brand", "p_partkey", " SALT_BUCKETS = 4"),
]


def table_config_changes(spark: SparkSession) -> DataFrame:
    """The configuration table as Debezium snapshot records (``op = 'r'``)."""
    rows = [(None, r, "r", 1700000000000 + i) for i, r in enumerate(TABLE_CONFIG_ROWS)]
    from shoal.schemas import CONFIG_CHANGE
    return spark.createDataFrame(rows, CONFIG_CHANGE)
