"""Dimension routing: change records -> rows of the dimension tables named by
the configuration table.

* ``latest_config`` turns the configuration change records (Debezium JSON:
  ``before``, ``after``, ``op``, ``ts_ms``) into the current configuration,
  one row per source table; a delete removes the entry.
* ``route_dimensions`` keeps change records whose table has a configuration
  (a join on the table name), trims ``data`` to the configured columns and tags the row with ``sink_table``. The record type is
  not looked at: inserts, updates and deletes are all upserts.
* ``dim_upsert`` applies routed rows to a dimension table: per key and per
  column the newest value wins (by record time ``ts``, then ``seq``, which orders
  records of one topic partition only), and only the columns present in a record
  change (a partial record leaves the other columns as they were).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.functions import keep_keys
from shoal.operators.cdc import filter_change_envelope
from shoal.operators.upsert import materialize_upsert

DEFAULT_PK = "id"


def newest_changes(config_changes: DataFrame) -> DataFrame:
    """The change record that counts for each ``source_table``, deletes too: by ``ts_ms``, of equal
    ones a delete, then the later text of the record. Folding again over more records gives
    what folding all at once gives."""
    rows = config_changes.withColumn("__table", F.coalesce(F.col("after.source_table"), F.col("before.source_table"))) \
        .where(F.col("__table").isNotNull())
    said = F.to_json(F.struct("after.sink_table", "after.sink_columns", F.coalesce("after.sink_pk", F.lit(DEFAULT_PK)).alias("sink_pk"),
                              F.coalesce("after.sink_extend", F.lit("")).alias("sink_extend")))
    order = F.struct(F.col("ts_ms"), (F.col("op") == "d").alias("is_delete"), said.alias("said"))
    newest = rows.groupBy("__table").agg(F.max_by(F.struct(*config_changes.columns), order).alias("r"))
    return newest.select("r.*")


def latest_config(config_changes: DataFrame) -> DataFrame:
    """Current configuration from its change records, newest per
    ``source_table`` by ``ts_ms`` (of equal ones, a delete, then the later text
    of the record); tables whose newest record is a delete (``op = 'd'``) are
    left out."""
    rows = config_changes.select(
        F.coalesce(F.col("after.source_table"), F.col("before.source_table")).alias("source_table"),
        F.col("after.sink_table").alias("sink_table"),
        F.col("after.sink_columns").alias("sink_columns"),
        F.coalesce(F.col("after.sink_pk"), F.lit(DEFAULT_PK)).alias("sink_pk"),
        F.coalesce(F.col("after.sink_extend"), F.lit("")).alias("sink_extend"),
        "op", "ts_ms")
    rows = rows.where(F.col("source_table").isNotNull()) \
        .withColumn("is_delete", F.col("op") == "d") \
        .withColumn("said", F.to_json(F.struct("sink_table", "sink_columns", "sink_pk", "sink_extend")))
    newest = materialize_upsert(rows, "source_table", ["ts_ms", "is_delete", "said"])
    return newest.where(F.col("op") != "d").drop("op", "ts_ms", "is_delete", "said")


def join_config(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change records whose table has a configuration, with its columns."""
    cfg = config.select("source_table", "sink_table", "sink_columns", "sink_pk")
    return changes.join(cfg, changes["table"] == cfg["source_table"], "inner") \
        .drop(cfg["source_table"])


def route_dimensions(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Dimension rows: ``seq, ts, table, type, sink_table, sink_pk, pk, data``
    with ``data`` trimmed to the configured columns."""
    kept = join_config(filter_change_envelope(changes), config)
    data = keep_keys("data", "sink_columns")
    carried = [c for c in ("seq",) if c in changes.columns]
    return kept.select(*carried, F.col("ts").cast("long").alias("ts"), "table", "type", "sink_table",
                       "sink_pk", data.alias("data")) \
        .withColumn("pk", F.col("data")[F.col("sink_pk")])


ENTRY = ("sink_table", "pk", "column", "value", "ts", "seq")


def dim_entries(rows: DataFrame) -> DataFrame:
    """A ``(sink_table, pk, column, value, ts, seq)`` entry for each column of each
    row; rows without a key value are not written. State rows have no ``ts`` of
    their own where it was not kept: they are older than any other."""
    def known(c):
        return F.col(c) if c in rows.columns else F.lit(None).cast("long").alias(c)
    return rows.where(F.col("pk").isNotNull()).select(
        "sink_table", "pk", known("ts"), known("seq"), F.explode("data").alias("column", "value")) \
        .select(*ENTRY)


def newest_entries(entries: DataFrame) -> DataFrame:
    """The newest entry of each key and column, by ``(ts, seq)``."""
    order = F.struct(F.col("ts").isNotNull(), F.col("ts"), F.col("seq").isNotNull(), F.col("seq"))
    return entries.groupBy("sink_table", "pk", "column").agg(
        F.max_by(F.struct("value", "ts", "seq"), order).alias("e")) \
        .select("sink_table", "pk", "column", "e.*")


def state_from_entries(entries: DataFrame) -> DataFrame:
    """Entries -> one row per key with the newest value of each column."""
    return newest_entries(entries).groupBy("sink_table", "pk").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "value"))))
        .alias("data"))


def dim_upsert(routed: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Apply routed rows (``sink_table, pk, ts, seq, data``) to ``current``
    (``sink_table, pk, data``, or None) and return the new state, one row per
    ``(sink_table, pk)`` with ``data`` holding every column ever written.

    The newest value per ``(sink_table, pk, column)`` is a partial aggregate
    (``max_by`` over ``(ts, seq)``), so a hot key is combined map-side. The final
    regrouping per key collects at most one entry per configured column.
    """
    e = dim_entries(routed)
    if current is not None:
        e = dim_entries(current.select("sink_table", "pk", "data")).unionByName(e)
    return state_from_entries(e)


def dim_table_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """All-string schema of a dimension table; the key column first."""
    cols = sink_columns.split(",")
    pk = sink_pk or DEFAULT_PK
    ordered = [c for c in cols if c == pk] + [c for c in cols if c != pk]
    return T.StructType([T.StructField(c, T.StringType(), nullable=(c != pk)) for c in ordered])


def dim_rows(state: DataFrame, sink_table: str, sink_columns: str,
             sink_pk: str | None = None) -> DataFrame:
    """Wide string rows of one dimension table from ``dim_upsert`` state."""
    schema = dim_table_schema(sink_columns, sink_pk)
    return state.where(F.col("sink_table") == sink_table).select(
        *[F.col("data")[f.name].alias(f.name) for f in schema.fields])


def _configured(config: DataFrame):
    """The configured tables, one row of metadata at a time."""
    return config.select("sink_table", "sink_columns", "sink_pk").dropDuplicates(["sink_table"]).toLocalIterator()


def ensure_dim_tables(spark, config: DataFrame, database: str = "dim",
                      location: str | None = None) -> list[str]:
    """Create every configured dimension table that does not exist yet
    (all-string columns, key first). Returns the qualified table names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for row in _configured(config):
        schema = dim_table_schema(row["sink_columns"], row["sink_pk"])
        cols = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
        name = f"`{database}`.`{row['sink_table']}`"
        loc = f" LOCATION '{location}/{row['sink_table']}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")
        names.append(f"{database}.{row['sink_table']}")
    return names


def fill_dim_tables(spark, state: DataFrame, config: DataFrame, database: str = "dim") -> None:
    """Write every configured table anew from the state. A table whose columns no
    longer are those of its configuration is created again first."""
    for row in _configured(config):
        name = f"`{database}`.`{row['sink_table']}`"
        rows = dim_rows(state, row["sink_table"], row["sink_columns"], row["sink_pk"])
        if spark.table(name).columns != rows.columns:
            missing = [c for c in rows.columns if c not in spark.table(name).columns]
            if missing:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` STRING' for c in missing)})")
            kept = spark.table(name).columns
            rows = rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in kept])
        rows.write.insertInto(name, overwrite=True)
