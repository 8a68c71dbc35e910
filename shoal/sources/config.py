"""The dimension configuration table, read from its change records."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.operators.dims import latest_config, newest_changes
from shoal.schemas import CONFIG_CHANGE


def parse_config_changes(text: DataFrame, value: str = "value") -> DataFrame:
    """Debezium JSON text of the configuration table -> change records."""
    return text.select(F.from_json(F.col(value), CONFIG_CHANGE).alias("r")).select("r.*") \
        .where(F.col("op").isNotNull())


def read_config(spark, path: str) -> DataFrame:
    """Current configuration from files of Debezium JSON lines (snapshot
    records first, then changes)."""
    return latest_config(parse_config_changes(spark.read.text(path)))


class ConfigState:
    """Current configuration from a growing folder of change records.

    ``refresh`` reads only the files that came since the last one (a file stream with a
    checkpoint under ``state``) and folds them over the newest record of each source table,
    kept under ``state/newest/upto=<n>/``: what is read doesn't grow with the history. A refresh
    that fails is done again by the next one and gives the same state.
    """

    def __init__(self, spark, path: str, state: str):
        self.spark, self.path, self.state = spark, path, state
        self.newest = posixpath.join(state, "newest")

    def _known(self, before: int | None = None) -> DataFrame:
        from shoal.sinks.writers import whole_folders
        done = [i for i in whole_folders(self.spark, self.newest, "upto") if before is None or i < before]
        if not done:
            return self.spark.createDataFrame([], CONFIG_CHANGE)
        return self.spark.read.schema(CONFIG_CHANGE).json(f"{self.newest}/upto={done[-1]}")

    def _fold(self, batch: DataFrame, batch_id: int) -> None:
        from shoal.sinks.writers import remove_folders
        folded = newest_changes(self._known(before=batch_id).unionByName(parse_config_changes(batch)))
        folded.coalesce(1).write.mode("overwrite").json(f"{self.newest}/upto={batch_id}")  # a row for each source table
        remove_folders(self.spark, self.newest, "upto", keep=2)

    def refresh(self):
        """Fold in what is new; the query that did it (its progress says what was read)."""
        query = self.spark.readStream.text(self.path).writeStream.foreachBatch(self._fold) \
            .option("checkpointLocation", posixpath.join(self.state, "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def current(self) -> DataFrame:
        """The configuration as of now, one row per source table."""
        self.refresh()
        return latest_config(self._known())
