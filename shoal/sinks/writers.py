"""Writers for the facts and dimension tables.

Topic writers need the Spark Kafka connector; the file writers are the same
contract on a shared folder (the built-in file sink is exactly-once through
its metadata log). Kafka output from Spark is at-least-once; consumers of an
upsert topic keep the last record per key, so replays are harmless; those of
other topics drop records whose id they have seen (``sources.kafka.once``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text_records(df: DataFrame) -> DataFrame:
    """Rows -> JSON text ``value`` (NULL fields left out)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def as_upsert_records(df: DataFrame, key_cols: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Rows -> ``key`` (JSON of the key columns) and ``value`` (JSON row).

    Of a change stream (a column ``op``) rows that are taken back become tombstones: their
    key with a NULL value. ``carry`` columns (the order of the changes) stay beside them and
    are not part of the value."""
    value = F.to_json(F.struct(*[c for c in df.columns if c not in ("op", *carry)]))
    if "op" in df.columns:
        value = F.when(F.col("op") != "-D", value)
    return df.select(*carry, F.to_json(F.struct(*key_cols)).alias("key"), value.alias("value"))


def with_record_headers(records: DataFrame) -> DataFrame:
    """``record_id`` as a record header, where ``sources.kafka.read_kafka_facts`` finds it. The id
    names the fact, not the attempt to write it: a replayed micro-batch writes the same ids."""
    header = F.struct(F.lit("record_id").alias("key"), F.col("record_id").cast("binary").alias("value"))
    return records.withColumn("headers", F.array(header)).drop("record_id")


def write_kafka_stream(records: DataFrame, servers: str, checkpoint: str,
                       topic: str | None = None, trigger: dict | None = None):
    """Stream ``value`` (and optional ``key`` / per-row ``topic``) to Kafka."""
    w = (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("checkpointLocation", checkpoint))
    if topic:
        w = w.option("topic", topic)
    if trigger:
        w = w.trigger(**trigger)
    return _start(w)


def _start(writer):
    """``start()`` with a clear error when the Kafka connector is missing."""
    from shoal.sources.kafka import ConnectorMissing
    try:
        return writer.start()
    except Exception as e:
        msg = str(e).lower()
        if "kafka" in msg and ("failed to find data source" in msg or "not found" in msg):
            raise ConnectorMissing("the Spark Kafka connector is not on the classpath") from e
        raise


def write_routed_files(routed: DataFrame, path: str, checkpoint: str | None = None,
                       trigger: dict | None = None):
    """``route, value`` rows -> text files under ``path/route=<name>/``.
    A batch frame replaces what is there; streams use the exactly-once file sink."""
    routed = routed.select("route", "value")
    if routed.isStreaming:
        w = (routed.writeStream.format("text").partitionBy("route").option("path", path)
             .option("checkpointLocation", checkpoint))
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    routed.write.mode("overwrite").partitionBy("route").text(path)
    return None


ENTRIES = "sink_table string, pk string, column string, value string, ts long, seq long"


def write_dim_batch(routed: DataFrame, path: str, batch_id: int) -> None:
    """The entries of one batch of routed rows, under ``path/entries/batch=<id>/``,
    by ``sink_table``. Writing a batch again replaces it."""
    from shoal.operators.dims import dim_entries
    dim_entries(routed).write.mode("overwrite").partitionBy("sink_table") \
        .parquet(f"{path}/entries/batch={batch_id}")


def whole_folders(spark, folder: str, name: str) -> list[int]:
    """Numbers of the whole sub-folders ``name=<id>`` (those that Spark finished)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    return sorted(int(p.getName().split("=")[1]) for p in found if p.getName().startswith(f"{name}=")
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def remove_folders(spark, folder: str, name: str, keep: int) -> None:
    """Remove all but the last ``keep`` whole sub-folders ``name=<id>``."""
    jvm = spark._jvm
    for i in whole_folders(spark, folder, name)[:-keep]:
        old = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={i}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def read_dim_entries(spark, path: str) -> DataFrame:
    """The last snapshot's entries and those of the batches after it."""
    done = whole_folders(spark, f"{path}/snapshots", "upto")[-1:]
    after = [i for i in whole_folders(spark, f"{path}/entries", "batch") if not done or i > done[0]]
    folders = [f"{path}/snapshots/upto={i}" for i in done] + [f"{path}/entries/batch={i}" for i in after]
    out = spark.createDataFrame([], ENTRIES)
    for folder in folders:
        out = out.unionByName(spark.read.schema(ENTRIES).parquet(folder))
    return out


def write_dim_snapshot(spark, path: str, batch_id: int) -> None:
    """The newest entry of each key and column up to a batch."""
    from shoal.operators.dims import newest_entries
    newest_entries(read_dim_entries(spark, path)).write.mode("overwrite").partitionBy("sink_table") \
        .parquet(f"{path}/snapshots/upto={batch_id}")


def read_dim_state(spark, path: str, sink_table: str | None = None) -> DataFrame:
    """Current state of the dimension tables from their entries."""
    from shoal.operators.dims import state_from_entries
    e = read_dim_entries(spark, path)
    if sink_table:
        e = e.where(F.col("sink_table") == sink_table)  # partition pruning
    return state_from_entries(e)


def insert_into(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in the target's column order, matched by name (never by
    position): missing columns are an error, extra ones are left out."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for insert: {missing}")
    return df.select(*columns)


def preview(df: DataFrame, n: int = 20, checkpoint: str | None = None):
    """Debug output: ``show`` for a batch frame, console sink for a stream."""
    if df.isStreaming:
        w = df.writeStream.format("console").option("truncate", "false")
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    df.show(n, truncate=False)
    return None
