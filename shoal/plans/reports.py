"""Registered batch queries: each ``(spark, sf_dir) -> DataFrame``.

Every query reads the generated tables (through ``sources.testdata``), runs
the library operators and returns flat, scalar columns, so that the SQL
oracle in ``plans.oracle`` can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.functions.time import ntz_epoch_millis
from shoal.operators import visitors
from shoal.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ visitors

def _page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page log with scalar control columns."""
    return visitors.flatten_page(td.page_log(td.table(spark, sf_dir, "events")))


@query("user_jump")
def user_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = td.page_log(td.table(spark, sf_dir, "events"), clock="jump")
    return visitors.flatten_page(visitors.user_jump(log), "reason")


@query("user_jump_sparse")
def user_jump_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the tables' own clock, where a device's events lie hours apart."""
    log = td.page_log(td.table(spark, sf_dir, "events"))
    return visitors.flatten_page(visitors.user_jump(log), "reason")


@query("unique_visitor_day")
def unique_visitor_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.unique_visitor(_page_log(spark, sf_dir), "day")


@query("unique_visitor_second")
def unique_visitor_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.unique_visitor(_page_log(spark, sf_dir), "second")


@query("fix_is_new_day")
def fix_is_new_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.fix_is_new(_page_log(spark, sf_dir), "day")


@query("fix_is_new_second")
def fix_is_new_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.fix_is_new(_page_log(spark, sf_dir), "second")


# ---------------------------------------------------------------------- logs

def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return td.raw_log_text(td.table(spark, sf_dir, "events"))


def _split(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from shoal.operators import logs
    clean, _ = logs.split_dirty(_log(spark, sf_dir))
    return logs.split_log(visitors.fix_is_new(clean, "day"))[name]


def _field(part: str, path: str, kind: str = "string"):
    """A field of an output record's part; ``$`` is the part itself."""
    from shoal.operators.logs import field
    return field(F.col("record")[part], path, kind)


def _who() -> list:
    """Who and when, and fields of ``common`` and of the record that no job names."""
    return ["seq", _field("common", "$.mid").alias("mid"), _field("common", "$.is_new").alias("is_new"),
            _field("common", "$.ba").alias("ba")]


def _extra() -> list:
    return [_field("extra", "$.k", "bigint").alias("extra_k"), _field("extra", "$.tags[1]").alias("extra_tag")]


@query("log_dirty")
def log_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators import logs
    return logs.split_dirty(_log(spark, sf_dir))[1].select("seq", "value")


@query("log_error")
def log_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "error").select(
        *_who(), _field("page", "$.page_id").alias("page_id"),
        _field("err", "$.error_code").alias("error_code"), _field("err", "$.msg").alias("msg"),
        _field("ts", "$", "bigint").alias("ts"), *_extra())


@query("log_start")
def log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "start").select(
        *_who(), _field("start", "$.entry").alias("entry"),
        _field("start", "$.loading_time", "bigint").alias("loading_time"),
        _field("ts", "$", "bigint").alias("ts"), *_extra())


@query("log_display")
def log_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "display").select(
        *_who(), _field("page", "$.page_id").alias("page_id"), _field("ts", "$", "bigint").alias("ts"),
        _field("display", "$.item").alias("item"), _field("display", "$.item_type").alias("item_type"),
        _field("display", "$.order", "bigint").alias("display_order"),
        _field("display", "$.pos_id", "bigint").alias("pos_id"))


@query("log_action")
def log_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "action").select(
        *_who(), _field("page", "$.page_id").alias("page_id"),
        _field("action", "$.action_id").alias("action_id"), _field("action", "$.item").alias("item"),
        _field("action", "$.ts", "bigint").alias("action_ts"),
        _field("action", "$.extra.n", "bigint").alias("action_extra"))


@query("log_page")
def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir, "page").select(
        *_who(), _field("page", "$.page_id").alias("page_id"),
        _field("page", "$.last_page_id").alias("last_page_id"),
        _field("page", "$.during_time", "bigint").alias("during_time"),
        _field("page", "$.item").alias("page_item"), _field("ts", "$", "bigint").alias("ts"), *_extra())


# ---------------------------------------------------------------- change log

def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators import cdc
    return cdc.filter_change_envelope(td.order_change_log(spark, sf_dir))


@query("change_envelope")
def change_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension change topic as JSON text -> parsed -> envelope filter."""
    from shoal.operators import cdc
    kept = cdc.filter_change_envelope(cdc.parse_change_log(td.dim_change_text(spark, sf_dir)))
    return kept.select("seq", "table", "type", "ts", F.size("data").cast("long").alias("n_fields"))


@query("cart_add")
def cart_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators import cdc
    return cdc.cart_add(_changes(spark, sf_dir), td.base_dic(spark))


def _wide(spark: SparkSession, sf_dir: str, newest: bool = False) -> DataFrame:
    from shoal.operators import joins
    return joins.order_wide_join(_changes(spark, sf_dir), td.base_dic(spark), newest=newest)


def _wide_report(df: DataFrame) -> DataFrame:
    """Wide rows without the map and the write-time column."""
    from shoal.operators.joins import WIDE_COLUMNS
    cols = [c for c in WIDE_COLUMNS if c not in ("old", "row_op_ts")]
    return df.select(*cols, F.col("old")["order_status"].alias("old_order_status"))


@query("order_wide")
def order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_report(_wide(spark, sf_dir))


@query("order_wide_latest")
def order_wide_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide_report(_wide(spark, sf_dir, newest=True))


@query("order_wide_upsert")
def order_wide_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details joined with every order record and, when it comes, their activity: written to an
    upsert topic (several records and tombstones a key), and the table that the topic stands for."""
    from shoal.operators import joins
    from shoal.operators.changes import join_changes
    from shoal.operators.upsert import table_of_records
    from shoal.sinks.writers import as_upsert_records
    kept = _changes(spark, sf_dir)
    orders = joins.order_info_rows(kept).drop("old")
    details = joins.order_detail_rows(kept).select("id", "order_id", "sku_id", "split_total_amount")
    left = details.join(orders, details["order_id"] == orders["oi_id"]).drop("oi_id")
    activities = joins.activity_rows(kept, keep=["seq"])
    changes = join_changes(left, activities, "id", "act_detail_id", "oi_seq", "seq", "left")
    # changes of one arrival: the order record that came last is the newest
    order = ["at", "nth", "came"]
    rows = changes.withColumn("came", F.col("oi_seq")).drop("act_detail_id", "seq")
    fields = [c for c in rows.columns if c not in ("op", *order)]
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in fields)
    # the changes lie dealt by id, and so the records: their newest are found where they are
    records = as_upsert_records(rows.withColumn("detail", F.col("id")), ["id"], carry=[*order, "detail"])
    return table_of_records(records, schema, order, by="detail")


@query("order_placed")
def order_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators.joins import order_placed as placed
    return _wide_report(placed(_wide(spark, sf_dir)))


# --------------------------------------------------------------------- joins

def _emp_dept(spark: SparkSession, sf_dir: str):
    # doubled customer numbers: those past the last customer meet none, odd customers have no order
    emp = td.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("empno"), F.col("o_orderpriority").alias("ename"),
        (F.col("o_custkey") * 2).alias("deptno"))
    dept = td.table(spark, sf_dir, "customer") \
        .select(F.col("c_custkey").alias("d_deptno"), F.col("c_name").alias("dname"))
    return emp, dept


def _demo_join(how: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from shoal.operators.joins import equi_join
        emp, dept = _emp_dept(spark, sf_dir)
        return equi_join(emp, dept, "deptno", "d_deptno", how) \
            .select("empno", "ename", "deptno", "dname")
    return run


for _how in ("inner", "left", "right", "full"):
    query(f"join_{_how}")(_demo_join(_how))


def _arriving(spark: SparkSession, sf_dir: str):
    """The two demo tables with an arrival order over both: odd numbers are the second table's."""
    emp, dept = _emp_dept(spark, sf_dir)
    return emp.withColumn("emp_at", F.col("empno") * 2), dept.withColumn("dept_at", F.col("d_deptno") * 20 + 1)


@query("join_left_changes")
def join_left_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a left join of the two growing tables emits and takes back."""
    from shoal.operators.changes import join_changes
    return join_changes(*_arriving(spark, sf_dir), "deptno", "d_deptno", "emp_at", "dept_at", "left") \
        .select("op", "at", "nth", "empno", "ename", "deptno", "dname")


@query("join_full_upsert")
def join_full_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full join through an upsert topic: the keys of padded rows are deleted when a partner comes."""
    from shoal.operators.changes import join_changes
    from shoal.operators.upsert import table_of_records
    from shoal.sinks.writers import as_upsert_records
    changes = join_changes(*_arriving(spark, sf_dir), "deptno", "d_deptno", "emp_at", "dept_at", "full")
    records = as_upsert_records(changes.drop("emp_at", "dept_at"), ["empno", "d_deptno"], carry=["at", "nth"])
    return table_of_records(records, "empno bigint, ename string, deptno bigint, d_deptno bigint, dname string", ["at", "nth"])


# Fixed value: band of the interval-join report (the demo uses 5 ms; the
# generated events are minutes apart, so the report uses six hours).
INTERVAL_BOUND_MS = 6 * 3600 * 1000


@query("interval_join")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators.joins import interval_join as band_join
    ev = td.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", ntz_epoch_millis("ts").alias("ms"))
    clicks = ev.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ms").alias("click_ts"))
    views = ev.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", F.col("ms").alias("view_ts"))
    return band_join(clicks, views, "user_id", "click_ts", "view_ts",
                     -INTERVAL_BOUND_MS, INTERVAL_BOUND_MS)


@query("delimited_join")
def delimited_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as comma lines, parsed back into typed rows, then the
    time-band join of the demo (click lines against view lines)."""
    from shoal.operators.joins import interval_join as band_join
    from shoal.schemas import DEPT, EMP
    from shoal.sources.delimited import parse_delimited
    ev = td.table(spark, sf_dir, "events")
    ms = ntz_epoch_millis("ts").cast("string")
    emp_lines = ev.where(F.col("event_type") == "click").select(F.concat_ws(
        ",", F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string"),
        ms).alias("value"))
    dept_lines = ev.where(F.col("event_type") == "view").select(F.concat_ws(
        ",", F.col("user_id").cast("string"), F.concat(F.lit("view_"), F.col("event_id").cast("string")),
        ms).alias("value"))
    emp = parse_delimited(emp_lines, EMP)
    dept = parse_delimited(dept_lines, DEPT).withColumnRenamed("ts", "dept_ts")
    return band_join(emp, dept, "deptno", "ts", "dept_ts", -INTERVAL_BOUND_MS, INTERVAL_BOUND_MS) \
        .select("empno", "ename", "deptno", F.col("ts").alias("emp_ts"), "dname", "dept_ts")


@query("date_functions")
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.functions import to_date_str, to_ts, to_ymdhms
    ev = td.table(spark, sf_dir, "events").select(
        "event_id", ntz_epoch_millis("ts").alias("ms"))
    d, dt = to_date_str("ms"), to_ymdhms("ms")
    return ev.select("event_id", "ms", d.alias("day"), dt.alias("day_time"),
                     to_ts(d).alias("day_start_ms"), to_ts(dt, is_full=True).alias("wall_ms"))


# ---------------------------------------------------------------- dimensions

def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators.dims import latest_config, route_dimensions
    config = latest_config(td.table_config_changes(spark))
    return route_dimensions(td.dim_changes(spark, sf_dir), config)


def _kv_report(df: DataFrame) -> list:
    keys = F.array_sort(F.map_keys("data"))
    return [F.array_join(keys, ",").alias("kept_keys"),
            F.array_join(F.transform(keys, lambda k: F.coalesce(F.col("data")[k], F.lit("<null>"))),
                         "|").alias("kept_values")]


@query("dim_route")
def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _routed(spark, sf_dir)
    return r.select("seq", "table", "type", "sink_table", "pk", *_kv_report(r))


@query("dim_upsert_partial")
def dim_upsert_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoal.operators.dims import dim_upsert
    state = dim_upsert(_routed(spark, sf_dir))
    return state.select("sink_table", "pk", *_kv_report(state))
