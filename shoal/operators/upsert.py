"""The table an upsert topic stands for: newest row per key, deleted keys left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize_upsert(df: DataFrame, key: str | Sequence[str],
                       order: str | Sequence[str], deleted: Column | None = None) -> DataFrame:
    """Newest row per key by ``order`` (last wins; ``order`` must be unique
    within a key). Keys whose newest row is ``deleted`` are left out.

    ``max_by`` is a partial aggregate: each map task keeps one row per key
    before the shuffle, so a key with a third of all rows costs no more than
    any other key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]),
                      F.struct(*[F.col(o) for o in order])).alias("__row")
    out = df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"__row.{c}").alias(c)
                                                        for c in rest]) \
        .select(*df.columns)
    return out if deleted is None else out.where(~F.coalesce(deleted, F.lit(False)))


def table_of_records(records: DataFrame, schema, order: str | Sequence[str] = "seq",
                     by: str | Sequence[str] = ()) -> DataFrame:
    """Rows of an upsert topic's records (``key``, ``value`` text and their order): the newest
    value of each key; a NULL value (a tombstone) removes the key.

    ``by`` names columns, carried beside the records, that the key text was made of (equal keys
    have equal ones). Records that come out of a join by these columns are not shuffled again."""
    order = [order] if isinstance(order, str) else list(order)
    by = [by] if isinstance(by, str) else list(by)
    # the order decides and is not kept: a row of the aggregate has it once
    newest = records.groupBy(*by, "key").agg(F.max_by("value", F.struct(*order)).alias("value")).where("value IS NOT NULL")
    return newest.select(F.from_json("value", schema).alias("r")).select("r.*")
