"""Change streams of joins: rows that are taken back when a later row alters them.

A join whose sides still grow emits ``+I`` for a result row and ``-D`` when that row no
longer holds: a left row without a partner comes out at once with NULLs, is taken
back when its partner arrives, and comes out joined. ``join_changes`` gives these
changes for two tables whose rows have an arrival order; ``streaming.changes`` gives them
from keyed state on streams. ``fold_changes`` adds changes up to the rows that hold.

Changes are ordered by ``at`` (arrival of the row that causes them), then ``nth``: what is
taken back comes before what takes its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, DELETE = "+I", "-D"
#: Columns of changes: what happens, and their order (by arrival, or a number per join key).
OP, AT, NTH, CHANGE = "op", "at", "nth", "change"
HOW = ("inner", "left", "right", "full")


def _change(op: str, at: Column) -> list[Column]:
    return [F.lit(op).alias(OP), at.cast("long").alias(AT), F.lit(0 if op == DELETE else 1).alias(NTH)]


def _padded(rows: DataFrame, key: str, at: str, other: DataFrame, other_key: str, other_at: str, columns: list[Column]) -> DataFrame:
    """The NULL-padded rows of one side: out on arrival, back when the first partner comes."""
    # one row a key, combined before the shuffle; a key without rows has none
    first = other.where(F.col(other_key).isNotNull()).groupBy(F.col(other_key).alias("__key")).agg(F.min(other_at).alias("__first"))
    alone = rows.join(first, rows[key] == F.col("__key"), "left").where(F.col("__first").isNull() | (rows[at] < F.col("__first")))
    # one pass for both changes of a row
    change = F.array(F.struct(*_change(INSERT, F.col(at))), F.struct(*_change(DELETE, F.col("__first"))))
    return alone.select(F.inline(change), *columns).where((F.col(OP) == INSERT) | F.col(AT).isNotNull())


def join_changes(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_at: str, right_at: str,
                 how: str = "left") -> DataFrame:
    """Changes ``op, at, nth`` of an equi-join whose rows come in the order of ``left_at`` and
    ``right_at`` (one order over both sides; of equal ones the right row is there first).

    Columns of the two sides must have different names. NULL keys meet no row. The rows of
    each side are read twice: for the pairs and, padded, against the first arrival per key.
    """
    if how not in HOW:
        raise ValueError(f"unsupported join type {how!r}")
    names = [*left.columns, *right.columns]
    kinds = {f.name: f.dataType for f in [*left.schema.fields, *right.schema.fields]}

    def columns(own: list[str]) -> list[Column]:
        return [F.col(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in names]

    out = left.join(right, left[left_key] == right[right_key]) \
        .select(*_change(INSERT, F.greatest(F.col(left_at), F.col(right_at))), *names)
    if how in ("left", "full"):
        out = out.unionByName(_padded(left, left_key, left_at, right, right_key, right_at, columns(left.columns))
                              .select(OP, AT, NTH, *names))
    if how in ("right", "full"):
        # a left row of the same arrival comes after the right one
        earlier = left.withColumn("__at", F.col(left_at) + 1)
        right_only = _padded(right.withColumn("__own", F.col(right_at) + 1), right_key, "__own", earlier, left_key, "__at", columns(right.columns))
        out = out.unionByName(right_only.withColumn(AT, F.col(AT) - 1).select(OP, AT, NTH, *names))
    return out


def fold_changes(changes: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows that hold after all changes: every row as often as it came more than it went.

    The sum per row combines before the shuffle, so that a row that comes and goes a million
    times is one row a task. Columns of map type can't be compared: leave them out.
    """
    columns = list(columns or [c for c in changes.columns if c not in (OP, AT, NTH, CHANGE)])
    n = F.sum(F.when(F.col(OP) == INSERT, 1).when(F.col(OP) == DELETE, -1).otherwise(0))
    held = changes.groupBy(*columns).agg(n.alias("__n")).where("__n > 0")
    return held.select(*columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__copy")).drop("__copy")
