"""Batch jobs: the three flows of the warehouse, reading inputs and writing
outputs under a target folder.

* ``log_job``: log text -> dirty rows and the five log facts, one pass
  (``route_log`` + a file write partitioned by ``route``), with the
  new-visitor flag repaired first; then the visitor facts from the page log.
* ``dim_job``: change records + configuration -> dimension entries
  (``read_dim_state`` gives the tables).
* ``trade_job``: change records + dictionary -> cart-add fact and order
  wide table (newest row per detail id).

What feeds several outputs (the parsed log, the repaired log, the change records)
is written once and read back (a lineage cut in the target folder), never kept
only in executor memory. Running a job again replaces its outputs.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators import cdc, dims, logs, visitors
from shoal.operators.joins import order_wide_join
from shoal.sinks.writers import write_dim_batch, write_routed_files


def log_job(spark: SparkSession, raw: DataFrame, out: str, granularity: str = "day") -> None:
    # one read and one parse of the text: clean and dirty rows side by side
    parsed_path = posixpath.join(out, "parsed_log")
    logs.parse_log(raw).withColumn("clean", logs.is_clean()) \
        .write.mode("overwrite").partitionBy("clean").parquet(parsed_path)
    parsed = spark.read.parquet(parsed_path)
    # the repaired log feeds three outputs: write it once, read it back
    fixed_path = posixpath.join(out, "clean_log")
    visitors.fix_is_new(parsed.where("clean = 'true'").drop("clean", "value"), granularity) \
        .write.mode("overwrite").parquet(fixed_path)
    fixed = spark.read.parquet(fixed_path)
    routed = logs.route_log(fixed).select("route", "value").unionByName(
        parsed.where("clean = 'false'").select(F.lit("dirty").alias("route"), "value"))
    write_routed_files(routed, posixpath.join(out, "topics"))
    page = logs.split_log(fixed)["page"].select("seq", "mid", "is_new", "last_page_id", "ts",
                                                F.to_json("record").alias("value"))
    visitors.unique_visitor(page, granularity).write.mode("overwrite") \
        .parquet(posixpath.join(out, "unique_visitor"))
    visitors.user_jump(page).write.mode("overwrite").parquet(posixpath.join(out, "user_jump"))


def dim_job(changes: DataFrame, config_changes: DataFrame, out: str) -> None:
    routed = dims.route_dimensions(changes, dims.latest_config(config_changes))
    write_dim_batch(routed, posixpath.join(out, "dims"), 0)


def trade_job(spark: SparkSession, changes: DataFrame, dic: DataFrame, out: str) -> None:
    # five outputs of the joins read the change records: read and parse them once
    kept_path = posixpath.join(out, "changes")
    cdc.filter_change_envelope(changes).write.mode("overwrite").parquet(kept_path)
    kept = spark.read.parquet(kept_path)
    cdc.cart_add(kept, dic).write.mode("overwrite").parquet(posixpath.join(out, "cart_add"))
    order_wide_join(kept, dic, newest=True).write.mode("overwrite") \
        .parquet(posixpath.join(out, "order_pre_process"))
