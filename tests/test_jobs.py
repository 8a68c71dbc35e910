"""The batch jobs end to end on the smallest tables."""

import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from shoal.plans import jobs
from shoal.sinks.writers import read_dim_state
from shoal.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_log_job(spark):
    out = tempfile.mkdtemp(prefix="shoal-job-", dir="/tmp")
    for _ in range(2):  # running it again replaces its outputs
        jobs.log_job(spark, td.raw_log_text(td.table(spark, SF, "events")), out)
    counts = {r["route"]: r["count"] for r in
              spark.read.text(f"{out}/topics").groupBy("route").count().collect()}
    for name in ("dirty", "error", "start", "display", "action", "page"):
        assert counts[name] == E.queries()[f"log_{name}"](spark, SF).count()
    assert spark.read.parquet(f"{out}/user_jump").count() > 0
    # fields that no job names are in the outputs
    page = spark.read.text(f"{out}/topics/route=page").select(F.from_json("value", "common struct<ba:string>, extra struct<k:long>").alias("r"))
    assert page.where("r.common.ba IS NULL OR r.extra.k IS NULL").count() == 0


def test_dim_job_and_state(spark):
    out = tempfile.mkdtemp(prefix="shoal-job-", dir="/tmp")
    jobs.dim_job(td.dim_changes(spark, SF), td.table_config_changes(spark), out)
    state = read_dim_state(spark, f"{out}/dims")
    want = E.queries()["dim_upsert_partial"](spark, SF)
    got = state.select("sink_table", "pk", F.array_join(F.array_sort(F.map_keys("data")), ",").alias("k"))
    assert got.count() == want.count()
    assert read_dim_state(spark, f"{out}/dims", "dim_part").count() == td.table(spark, SF, "part").count()


def test_trade_job(spark):
    out = tempfile.mkdtemp(prefix="shoal-job-", dir="/tmp")
    jobs.trade_job(spark, td.order_change_log(spark, SF), td.base_dic(spark), out)
    assert spark.read.parquet(f"{out}/cart_add").count() == E.queries()["cart_add"](spark, SF).count()
    assert (spark.read.parquet(f"{out}/order_pre_process").count()
            == E.queries()["order_wide_latest"](spark, SF).count())
