"""Previous / next row per key without putting a whole key into one task.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task.
With one device holding a third of all rows that task would sort a third of
the data. Instead rows are cut into ordered buckets (``bucket`` must never
decrease along the order, e.g. ``floor(ts / width)``).

* ``neighbour``: a window per ``(key, bucket)``, the edge row of each bucket
  from an aggregate, a window over that small table, and a join back. Rows and
  edges read the same columns of the same exchange, so the rows are read and
  shuffled once (the plan shows one exchange and a reuse of it); the edge table
  is shuffled by key.
* ``next_within``: when only a following row less than ``reach`` later matters,
  rows near the start of a bucket are also given to the bucket before, and one
  window per ``(key, bucket)`` answers: one read, one shuffle, no join.
* ``first_per_key``: a grouped minimum (combined before the shuffle) joined
  back on the key; adaptive execution splits a hot key of the rows' side.

Results equal the plain per-key window exactly (tested down to bucket width one).
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B = "__bucket"
_K = "__key"
_IN = "__in_bucket"
_EDGE = "__edge"


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def bucketed(df: DataFrame, key: str | Sequence[str], bucket: Column) -> DataFrame:
    """Rows with the key as one struct and an ordered bucket column, hash-partitioned
    by both. A key with many rows lands in as many partitions as it has buckets.

    Neither column is ever NULL (a NULL bucket comes first), so Spark adds no
    NULL filter to one side of a later join, which would keep it from sharing the
    exchange."""
    return df.withColumn(_K, F.struct(*_cols(key))).withColumn(_B, F.coalesce(bucket, F.lit(-1 << 62))) \
        .repartition(_K, _B)


def _reads(df: DataFrame, name: str, made: str) -> tuple[Column, Column]:
    """An aggregate that needs the column, and a condition on it that always holds."""
    f = df.schema[name]
    if f.nullable or not isinstance(f.dataType, T.AtomicType):
        return F.count(F.col(name)).alias(made), F.col(made) >= 0
    return F.max(F.col(name)).alias(made), F.col(made).isNotNull()


def neighbour(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
              bucket: Column, values: Sequence[str], direction: str, out: str) -> DataFrame:
    """Add struct column ``out`` holding ``values`` of the previous
    (``direction="prev"``) or next (``"next"``) row of the same key.

    NULL when there is no such row. Rows are ordered by ``order`` (ties must
    be broken by the caller, e.g. with a sequence number).
    """
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    keys, order = _cols(key), _cols(order)
    vals = F.struct(*[F.col(v) for v in values])
    ordkey = F.struct(*[F.col(o) for o in order])
    spare = [k for k in keys if k not in {*order, *values}]
    part = bucketed(df, keys, bucket).drop(*spare)
    w_in = Window.partitionBy(_K, _B).orderBy(*order)
    shift = F.lag if direction == "prev" else F.lead
    rows = part.withColumn(_IN, shift(vals, 1).over(w_in))

    # one edge row per (key, bucket): the last row for "prev", the first for "next".
    # A count of every other column (or the greatest value, where a count wouldn't need
    # the column, as it is never NULL) makes this branch read what the rows' branch
    # reads, so that both share one exchange.
    pick = F.max_by if direction == "prev" else F.min_by
    others = [c for c in df.columns if c not in {*order, *values, *spare}]
    reads = [_reads(df, c, f"__n{i}") for i, c in enumerate(others)]
    edges = part.groupBy(_K, _B).agg(pick(vals, ordkey).alias(_EDGE), *[a for a, _ in reads])
    w_b = Window.partitionBy(_K).orderBy(_B)
    edge = F.when(reduce(operator.and_, [c for _, c in reads]), F.col(_EDGE)) if reads else F.col(_EDGE)
    edges = edges.select(_K, _B, shift(edge, 1).over(w_b).alias(_EDGE))

    joined = rows.join(edges, on=[_K, _B], how="left")
    cells = [F.col(_K)[c].alias(c) if c in spare else F.col(c) for c in df.columns]
    return joined.select(*cells, F.coalesce(F.col(_IN), F.col(_EDGE)).alias(out))


def next_within(df: DataFrame, key: str | Sequence[str], at: str, order: str | Sequence[str],
                reach: int, width: int, values: Sequence[str], out: str) -> DataFrame:
    """Add struct column ``out`` with ``values`` of the next row of the key by
    ``order`` (which starts with the whole number ``at``), if it comes less than
    ``reach`` after the row; otherwise NULL or a later row.

    A bucket of ``width`` (at least ``reach``) is a task's unit of work.
    """
    width = max(width, reach)
    keys, order = _cols(key), _cols(order)
    b = F.floor(F.col(at) / width)
    early = F.col(at) - b * width < reach
    spread = df.withColumn(_B, F.explode(F.when(early, F.array(b, b - 1)).otherwise(F.array(b)))) \
        .withColumn(_IN, F.col(_B) == b)
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    return spread.withColumn(out, F.lead(F.struct(*[F.col(v) for v in values]), 1).over(w)) \
        .where(_IN).drop(_B, _IN)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                  value: Column, out: str) -> DataFrame:
    """Add column ``out`` = ``value`` of the first row of each key.

    The first values come from a grouped ``min_by`` over the key, order and value
    columns alone, combined before its shuffle; the rows are shuffled once for
    the join, which adaptive execution splits where a key is hot (or not at all,
    when Spark finds the first values small enough to send along).
    """
    keys = _cols(key)
    firsts = df.groupBy(*keys).agg(F.min_by(value, F.struct(*_cols(order))).alias(out))
    return df.join(firsts, on=keys, how="left")
