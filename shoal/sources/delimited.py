"""Comma-separated text lines -> typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_delimited(lines: DataFrame, schema: T.StructType, value: str = "value",
                    sep: str = ",") -> DataFrame:
    """Split each line on ``sep`` into the typed fields of ``schema``.

    Fields that do not parse as their type are NULL (permissive mode).
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col(value), ddl, {"sep": sep, "mode": "PERMISSIVE"})
    return lines.select(parsed.alias("__r")).select("__r.*")


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   sep: str = ",") -> DataFrame:
    """Batch read of delimited text files."""
    return spark.read.schema(schema).option("sep", sep).csv(path)


def read_delimited_stream(spark: SparkSession, path: str, schema: T.StructType,
                          sep: str = ",") -> DataFrame:
    """Streaming read of delimited text files dropped into ``path``."""
    return spark.readStream.schema(schema).option("sep", sep).csv(path)
