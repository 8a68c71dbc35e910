"""Message-topic readers.

``read_kafka_*`` need the Spark Kafka connector on the classpath (not bundled
here); ``read_text_stream`` is the same contract over files of JSON lines,
used by tests. Offsets are tracked by the query checkpoint, not by consumer
groups; ``starting_offsets`` picks where a new query starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.operators.cdc import parse_change_log


class ConnectorMissing(RuntimeError):
    """The Spark Kafka connector is not on the classpath."""


def _load(reader):
    try:
        return reader.load()
    except Exception as e:  # the data source lookup fails without the jar
        msg = str(e).lower()
        if "kafka" in msg and ("failed to find data source" in msg or "not found" in msg):
            raise ConnectorMissing(
                "the Spark Kafka connector (spark-sql-kafka-0-10) is not on the classpath; "
                "add it with --packages or spark.jars, or use read_text_stream") from e
        raise


def read_kafka_text(spark: SparkSession, servers: str, topic: str,
                    starting_offsets: str = "earliest", **options) -> DataFrame:
    """Topic -> ``seq, value`` text. Records without a value (tombstones)
    are dropped. ``seq`` (partition * 2^40 + offset) orders records of one
    partition only: what must stay in order shares a key."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = _load(reader)
    return raw.where(F.col("value").isNotNull()).select(
        (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"),
        F.col("value").cast("string").alias("value"))


def read_kafka_json(spark: SparkSession, servers: str, topic: str, schema: T.StructType,
                    starting_offsets: str = "latest", **options) -> DataFrame:
    """Topic of JSON records -> typed columns (unparsable text gives NULLs)."""
    text = read_kafka_text(spark, servers, topic, starting_offsets, **options)
    return text.select("seq", F.from_json("value", schema).alias("r")).select("seq", "r.*")


def read_change_log(spark: SparkSession, servers: str, topic: str = "topic_db",
                    starting_offsets: str = "earliest", **options) -> DataFrame:
    """The database change topic as change records."""
    return parse_change_log(read_kafka_text(spark, servers, topic, starting_offsets, **options))


def once(records: DataFrame, at: str = "at", within: str = "10 minutes") -> DataFrame:
    """Each fact once, of a topic that may hold it several times (its writer replays a
    micro-batch after a failure): rows whose ``record_id`` came before go, as long as both
    came less than ``within`` apart. Rows without an id are told apart by ``seq``."""
    known = F.coalesce(F.concat(F.lit("id:"), "record_id"), F.concat(F.lit("seq:"), F.col("seq").cast("string")))
    return records.withColumn("__id", known).withWatermark(at, within) \
        .dropDuplicatesWithinWatermark(["__id"]).drop("__id")


def read_kafka_facts(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
                     within: str = "10 minutes", **options) -> DataFrame:
    """Topic -> ``seq, value, record_id, at``, each fact once (see ``once``; ``at`` is the time that
    the topic has for the record)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting_offsets).option("includeHeaders", "true"))
    for k, v in options.items():
        reader = reader.option(k, v)
    header = F.element_at(F.filter("headers", lambda h: h["key"] == "record_id"), 1)["value"]
    raw = _load(reader).where(F.col("value").isNotNull())
    return once(raw.select(
        (F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")).alias("seq"),
        F.col("value").cast("string").alias("value"), header.cast("string").alias("record_id"), F.col("timestamp").alias("at")), within=within)


def read_fact_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     within: str = "10 minutes") -> DataFrame:
    """The file form of ``read_kafka_facts``: JSON lines with ``seq, value, record_id, at``."""
    reader = spark.readStream.schema("seq long, value string, record_id string, at timestamp").format("json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return once(reader.load(path).where(F.col("value").isNotNull()), within=within)


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     **options) -> DataFrame:
    """The file form of a topic: JSON lines ``{"seq": n, "value": "<text>"}``
    dropped into ``path`` give the same ``seq, value`` stream."""
    reader = spark.readStream.schema("seq long, value string").format("json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path).where(F.col("value").isNotNull())
