"""Joins: dictionary lookup, time-band (interval) join, the four equi-joins
of the demos, and the order wide table.

Shuffle notes (they matter at scale):

* ``lookup_join`` gives no hint: Spark sends a dictionary along when its bytes
  are under ``autoBroadcastJoinThreshold`` (adaptive execution decides again on
  measured bytes) and shuffles otherwise.
* ``interval_join`` adds a time-bucket equi-key, so a key with many rows is
  compared only within neighbouring buckets, never all pairs of the key.
* ``order_wide_join`` filters details through the dictionary first, then
  joins activity and coupon rows on the detail id (one shuffle of the
  details, both small sides co-partitioned on the same key), then the order
  rows on the order id. AQE splits a skewed order id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions import decimal_product, format_text_time, map_get
from shoal.operators.cdc import project_change_fields, select_change_rows
from shoal.operators.changes import CHANGE, OP


def lookup_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                how: str = "inner") -> DataFrame:
    """Join facts with a dictionary on one key, the dictionary as of now.

    ``how="inner"`` drops facts without an entry (as the processing-time
    lookup join does). The dictionary key column is dropped.
    """
    out = facts.join(dim, F.col(fact_key) == dim[dim_key], how)
    return out.drop(dim[dim_key]) if dim_key != fact_key else out


def equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              how: str) -> DataFrame:
    """The four demo joins: ``inner``, ``left``, ``right``, ``full``."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    return left.join(right, left[left_key] == right[right_key], how)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower_ms: int, upper_ms: int, how: str = "inner") -> DataFrame:
    """Keyed time-band join: ``right_ts`` in ``[left_ts + lower, left_ts + upper]``
    (both ends included), timestamps in epoch ms. ``how`` is ``inner`` or ``left``:
    right rows are copied to buckets, so those without a match have no one row to
    stand for them (swap the sides, with the bounds negated, for a right join).

    Rows are cut into time buckets of width ``max(upper - lower, 1)``: each
    left row sits in one bucket, each right row is copied to the (at most
    two) buckets its band reaches, so every matching pair meets exactly once.
    Output columns are the left columns then the right columns other than
    the key; other names must not clash (rename before joining).
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if lower_ms > upper_ms:
        raise ValueError("lower bound above upper bound")
    width = max(upper_ms - lower_ms, 1)
    b = "__band_bucket"
    lb = left.withColumn(b, F.floor(F.col(left_ts) / width))
    first = F.floor((F.col(right_ts) - F.lit(upper_ms)) / width)
    last = F.floor((F.col(right_ts) - F.lit(lower_ms)) / width)
    rb = right.withColumn(b, F.explode(F.sequence(first, last)))
    rk = "__band_key"
    rb = rb.withColumn(rk, F.col(key))
    cond = ((lb[key] == rb[rk]) & (lb[b] == rb[b])
            & rb[right_ts].between(lb[left_ts] + F.lit(lower_ms), lb[left_ts] + F.lit(upper_ms)))
    out = lb.join(rb, cond, how)
    return out.select(*[lb[c] for c in left.columns],
                      *[rb[c] for c in right.columns if c != key])


# ------------------------------------------------------------- order wide join

# The fields of a detail record and the columns of the wide table.
DETAIL_FIELDS = ("id", "order_id", "sku_id", "sku_name", "sku_num", "create_time",
                 "source_type", "source_id", "split_total_amount", "split_activity_amount",
                 "split_coupon_amount")

WIDE_COLUMNS = ("id", "order_id", "sku_id", "sku_name", "date_id", "create_time", "source_id",
                "source_type", "sku_num", "split_original_amount", "split_activity_amount",
                "split_coupon_amount", "split_total_amount", "od_ts", "user_id", "province_id",
                "operate_date_id", "operate_time", "order_status", "type", "old", "oi_ts",
                "activity_id", "activity_rule_id", "coupon_id", "source_type_name", "row_op_ts")


def order_detail_rows(changes: DataFrame) -> DataFrame:
    od = select_change_rows(changes, "order_detail", ["insert"])
    amount = decimal_product(map_get("data", "sku_num"), map_get("data", "order_price"))
    return project_change_fields(od, DETAIL_FIELDS,
                                 keep=[amount.alias("split_original_amount"),
                                       F.col("ts").alias("od_ts")])


def order_info_rows(changes: DataFrame) -> DataFrame:
    oi = select_change_rows(changes, "order_info", ["insert", "update"])
    return project_change_fields(
        oi, {"id": "oi_id", "user_id": "user_id", "province_id": "province_id",
             "operate_time": "operate_time", "order_status": "order_status"},
        keep=["type", "old", F.col("ts").alias("oi_ts"), F.col("seq").alias("oi_seq")])


def activity_rows(changes: DataFrame, with_ts: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    act = select_change_rows(changes, "order_detail_activity", ["insert"])
    return project_change_fields(act, {"order_detail_id": "act_detail_id",
                                       "activity_id": "activity_id",
                                       "activity_rule_id": "activity_rule_id"},
                                 keep=[*([F.col("ts").alias("act_ts")] if with_ts else []), *keep])


def coupon_rows(changes: DataFrame, with_ts: bool = False) -> DataFrame:
    cou = select_change_rows(changes, "order_detail_coupon", ["insert"])
    return project_change_fields(cou, {"order_detail_id": "cou_detail_id",
                                       "coupon_id": "coupon_id"},
                                 keep=[F.col("ts").alias("cou_ts")] if with_ts else [])


def newest_order_rows(orders: DataFrame) -> DataFrame:
    """The newest record of each order, by record time, then arrival."""
    at = F.struct(F.col("oi_ts").cast("long"), F.col("oi_seq"))
    kept = [c for c in orders.columns if c != "oi_id"]
    return orders.groupBy("oi_id").agg(F.max_by(F.struct(*kept), at).alias("r")).select("oi_id", "r.*")


def _wide_rows(joined: DataFrame, keep_seq: bool, row_op_ts: Column | None) -> DataFrame:
    cols = {
        "date_id": format_text_time("create_time", "yyyy-MM-dd"),
        "operate_date_id": format_text_time("operate_time", "yyyy-MM-dd"),
        "row_op_ts": row_op_ts if row_op_ts is not None else F.current_timestamp(),
    }
    out = [cols.get(c, F.col(c)).alias(c) for c in WIDE_COLUMNS]
    carried = [c for c in (CHANGE, OP) if c in joined.columns]  # of a change stream
    return joined.select(*carried, *out, *([F.col("oi_seq")] if keep_seq else []))


def with_dictionary(joined: DataFrame, dic: DataFrame, keep_seq: bool = False,
                    row_op_ts: Column | None = None) -> DataFrame:
    """Wide rows of joined details, the dictionary as of now."""
    names = dic.select(F.col("dic_code"), F.col("dic_name").alias("source_type_name"))
    return _wide_rows(lookup_join(joined, names, "source_type", "dic_code"), keep_seq, row_op_ts)


def order_wide_join(changes: DataFrame, dic: DataFrame, keep_seq: bool = False,
                    newest: bool = False, row_op_ts: Column | None = None) -> DataFrame:
    """Order detail ⋈ order ⟕ activity ⟕ coupon ⋈ dictionary (27 columns).

    Every order record (insert and update) joins, so a detail appears once
    per order record; ``materialize_upsert`` keeps the newest per ``id``. With
    ``newest`` only the newest record of each order joins: the same rows as the
    newest per detail id (a detail is inserted once), but chosen on the narrow
    order side, before the wide join.
    ``keep_seq`` adds ``oi_seq`` (arrival order of the order record).
    """
    names = dic.select(F.col("dic_code"), F.col("dic_name").alias("source_type_name"))
    od = lookup_join(order_detail_rows(changes), names, "source_type", "dic_code")
    act, cou = activity_rows(changes), coupon_rows(changes)
    j = (od.join(act, od["id"] == act["act_detail_id"], "left")
         .join(cou, od["id"] == cou["cou_detail_id"], "left"))
    oi = order_info_rows(changes)
    oi = newest_order_rows(oi) if newest else oi
    return _wide_rows(j.join(oi, j["order_id"] == oi["oi_id"], "inner"), keep_seq, row_op_ts)


def order_placed(wide: DataFrame) -> DataFrame:
    """Order-placed detail fact: wide rows whose order record is the insert."""
    return wide.where(F.col("type") == "insert")
