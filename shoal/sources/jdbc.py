"""Dictionary tables over JDBC, re-read when older than a time to live."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table as a DataFrame; credentials come from ``options``
    (``user``, ``password``, ``driver``), never from code."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


class CachedDimension:
    """A small lookup table held in executor memory and re-read from its
    source when older than ``ttl_seconds`` (the lookup cache of a
    processing-time join). ``load`` is any ``() -> DataFrame``."""

    def __init__(self, load, ttl_seconds: float = 3600.0, clock=time.monotonic):
        self._load, self._ttl, self._clock = load, ttl_seconds, clock
        self._df: DataFrame | None = None
        self._at = 0.0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._at >= self._ttl:
            if self._df is not None:
                self._df.unpersist()
            self._df = self._load().persist(StorageLevel.MEMORY_AND_DISK)
            self._at = now
        return self._df
