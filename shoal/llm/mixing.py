"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Each source's documents, in a fixed random order, are cut into blocks of ``block``
characters. With weight w (a share of the slots), block i of a source may not come
before slot ``floor(i / w)`` and has to come before slot ``ceil((i + 1) / w)``. At
every slot the released block with the earliest deadline goes next, so at any slot
each source has had its share to within one block.

Weights are whole numbers, so the schedule repeats after as many slots as their
sum: one period is scheduled, and block i follows from it. Where a source ends, a
new schedule starts over the others (every document is placed once, none is left
out). The schedule's size is set by the weights alone; documents find their block by
sums over (source, hash bucket), then inside a bucket, so no source is in one task.

Sources that have no weight of their own share one stream, ``other``. Defined
results: null source goes with the others; null text has no characters; rows equal
in doc_id and source are one unit, placed together (``copies`` counts them); null
doc_id is an id of its own; an empty table gives an empty result; extra columns are
kept by ``mixed`` and not looked at.

``mixed`` notes the schedule in the metadata of the doc_id column, which Parquet files
keep, as the order of rows is no part of a table; ``scheduled`` places the documents by it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 20_000
BUCKETS = 1024
OTHER = "other"
NOTE = "mixing"
#: Whole periods of the schedule in a range.
PERIODS = 4


def period(weights: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period of ``sum(weights)`` slots."""
    total = sum(weights.values())
    slots: dict[str, list[int]] = {s: [] for s in weights}
    for t in range(total):
        ready = [(-(-(len(slots[s]) + 1) * total // w), s) for s, w in weights.items()
                 if len(slots[s]) < w and len(slots[s]) * total // w <= t]
        slots[min(ready)[1]].append(t)
    return slots


def schedule(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple[str, int, int, int, int, int, list[int]]]:
    """``(stream, first_block, blocks, weight, total, first_slot, slots)`` rows that place every block."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, start = [], 0
    while left:
        now = {s: weights[s] for s in left}
        total, slots = sum(now.values()), period(now)
        last = min((left[s] - 1) // now[s] * total + slots[s][(left[s] - 1) % now[s]] for s in left)
        length = last + 1
        for s in list(left):
            n = length // total * now[s] + sum(t < length % total for t in slots[s])
            if n:
                rows.append((s, done[s], n, now[s], total, start, slots[s]))
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        start += length
    return rows


def mix(docs: DataFrame, weights: dict[str, int], other: int = 1, block: int = BLOCK) -> DataFrame:
    """``doc_id, source, copies, n_chars, stream, block, release, deadline, slot, place`` of every unit."""
    if any(not isinstance(w, int) or w < 1 for w in [*weights.values(), other]):
        raise ValueError("weights are whole numbers of at least 1")
    streams = {**{s: w for s, w in weights.items() if s != OTHER}, OTHER: weights.get(OTHER, other)}
    known = F.col("source").isin([s for s in streams if s != OTHER])
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n")) \
        .groupBy("doc_id", "source").agg(F.sum("n").alias("n_chars"), F.count("*").alias("copies")) \
        .withColumn("stream", F.when(F.coalesce(known, F.lit(False)), F.col("source")).otherwise(OTHER)) \
        .withColumn("u", F.xxhash64("doc_id", "source")) \
        .withColumn("bucket", F.pmod("u", F.lit(BUCKETS)))
    sums = units.groupBy("stream", "bucket").agg(F.sum("n_chars").alias("n"))
    before = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("stream", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("stream", "bucket").orderBy("u", "doc_id", "source").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("within", F.coalesce(F.sum("n_chars").over(inside), F.lit(0))) \
        .join(base, ["stream", "bucket"]).withColumn("before", F.col("base") + F.col("within")) \
        .withColumn("block", F.floor(F.col("before") / block))
    # one row for each weight
    totals = sums.groupBy("stream").agg(F.sum("n").alias("n")).collect()
    rows = schedule({r["stream"]: r["n"] // block + 1 for r in totals}, streams)
    names = "stream string, first long, blocks long, weight long, total long, start long, slots array<long>"
    # its size is bounded by the weights
    table = F.broadcast(docs.sparkSession.createDataFrame(rows, names))
    out = placed.join(table, "stream").where((F.col("block") >= F.col("first")) & (F.col("block") < F.col("first") + F.col("blocks")))
    i = F.col("block") - F.col("first")
    turn = F.floor(i / F.col("weight"))
    out = out.withColumn("slot", F.col("start") + turn * F.col("total") + F.col("slots")[(i % F.col("weight")).cast("int")]) \
        .withColumn("release", F.col("start") + F.floor(i * F.col("total") / F.col("weight"))) \
        .withColumn("deadline", F.col("start") + F.ceil((i + 1) * F.col("total") / F.col("weight")))
    in_slot = Window.partitionBy("slot").orderBy("before", "bucket", "u", "doc_id", "source")
    return out.withColumn("place", F.row_number().over(in_slot)) \
        .select("doc_id", "source", "copies", "n_chars", "stream", "block", "release", "deadline", "slot", "place")


def mixed(docs: DataFrame, weights: dict[str, int], other: int = 1, block: int = BLOCK) -> DataFrame:
    """The documents with their own columns, dealt by ranges of the schedule and sorted by it."""
    places = mix(docs, weights, other, block).select(
        F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("slot").alias("__mix_slot"), F.col("place").alias("__mix_place"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__mix_id")) & F.col("source").cast("string").eqNullSafe(F.col("__mix_source"))
    note = {**docs.schema["doc_id"].metadata, NOTE: json.dumps({"weights": weights, "other": other, "block": block})}
    return docs.join(places, on).repartitionByRange("__mix_slot", "__mix_place").sortWithinPartitions("__mix_slot", "__mix_place") \
        .select(*[F.col("doc_id").alias("doc_id", metadata=note) if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns])


def scheduled(docs: DataFrame, periods: int = PERIODS) -> DataFrame | None:
    """``doc_id, source, range, slot, place`` of the units of documents that ``mixed`` gave, else None.

    A range is ``periods`` whole periods of the schedule, so each holds the target weights.
    """
    note = docs.schema["doc_id"].metadata.get(NOTE)
    if note is None:
        return None
    how = json.loads(note)
    span = periods * (sum(w for s, w in how["weights"].items() if s != OTHER) + how["weights"].get(OTHER, how["other"]))
    return mix(docs, **how).select("doc_id", "source", F.floor(F.col("slot") / span).alias("range"), "slot", "place")
