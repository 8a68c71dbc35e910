"""Packing of tokenised documents into fixed windows by minimum bin slack.

A document longer than the window is cut into full windows and a remainder. The
remainders' lengths are counted; as long as any are left, a window takes the longest
one and then, by subset-sum dynamic programming on a bitset of reachable sums with
bounded multiplicities, the multiset that leaves least slack (a window filled to a
power of two needs no padding); counts are traced back through the bitsets. A pattern
is used as often as its counts allow, so the plan has a few thousand patterns at
most, whatever the number of documents; it is made from the histogram, which has as
many rows as the window has tokens.

Pieces find their window by their rank among the pieces of their length: counts by
length and hash bucket, summed over buckets, then a rank inside a bucket, so no
length is ranked in one task.

Documents with places in a mixing schedule are planned range by range of it, each range
in a task of its own: pieces of a length are taken in the order of the schedule, windows
are numbered by their earliest piece, and a range's after those of the ranges before.

Defined results: null or empty text is the end id alone; repeated rows are packed
each on its own; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, blobs, saved, text_chunks
from shoal.llm.tokens import END, default_tokenizer, encode_documents

WINDOW = 1024
BUCKETS = 1024


def slack(total: int, window: int) -> int:
    """Padding of a sequence of ``total`` tokens."""
    return 0 if total & (total - 1) == 0 else window - total


def fill(counts: dict[int, int], longest: int, window: int) -> dict[int, int]:
    """The multiset with ``longest`` in it that leaves least slack (of equals, the fullest)."""
    room = window - longest
    full = (1 << (room + 1)) - 1
    reach, stages = 1, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == longest), room // length)
        if most <= 0:
            continue
        stages.append((length, reach))
        step = 1
        while most > 0:
            take = min(step, most)
            reach |= (reach << (take * length)) & full
            most -= take
            step *= 2
        if reach >> room & 1:
            break
    sums = [room] if reach >> room & 1 else [i for i in range(room + 1) if reach >> i & 1]
    left = min(sums, key=lambda s: (slack(longest + s, window), -s))
    chosen = {longest: 1}
    for length, before in reversed(stages):
        n = 0
        while not before >> left & 1:
            left -= length
            n += 1
        if n:
            chosen[length] = chosen.get(length, 0) + n
    return chosen


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first_rank, per_window, windows, first_window, offset)`` rows that place every piece."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    used = dict.fromkeys(counts, 0)
    rows, first_window = [], 0
    while counts:
        longest = max(counts)
        pattern = fill(counts, longest, window)
        times = min(counts[k] // n for k, n in pattern.items())
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, used[length], n, times, first_window, offset))
            offset += n * length
            used[length] += n * times
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        first_window += times
    return rows


PIECES = "doc_id long, source string, start long, length long, doc_tokens long, ids binary"


def _pieces(path: str, end: int, window: int):
    schema = arrow_schema(doc_id=pa.int64(), source=pa.string(), start=pa.int64(), length=pa.int64(), doc_tokens=pa.int64(), ids=pa.binary())

    def run(batches):
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            sources = batch.column("source").to_pylist()
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                ids, start = encode_documents([raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)], path, end)
                ids = ids.astype("<u4")
                n = np.diff(start)
                per = -(-n // window)
                of = np.repeat(np.arange(len(n)), per)
                within = (np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)) * window
                length = np.minimum(n[of] - within, window)
                at = (start[of] + within).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_ids[lo + i] for i in of.tolist()], pa.int64()),
                     pa.array([sources[lo + i] for i in of.tolist()], pa.string()), pa.array(within), pa.array(length),
                     pa.array(n[of]), blobs([ids[a:a + m].tobytes() for a, m in zip(at, length.tolist(), strict=True)])],
                    schema=schema)

    return run


def _planned(window: int):
    schema = arrow_schema(piece=pa.int64(), range=pa.int64(), window=pa.int64(), offset=pa.int64(), windows=pa.int64())

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("slot", "place", "start", "doc_tokens", "crc", "piece")])
        length = table.column("length").to_numpy()
        order = np.argsort(length, kind="stable")
        kinds, first = np.unique(length[order], return_index=True)
        counts = np.diff(np.append(first, len(order)))
        rows = plan(dict(zip(kinds.tolist(), counts.tolist(), strict=True)), window)
        at = dict(zip(kinds.tolist(), first.tolist(), strict=True))
        number, offset = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for kind, rank, per, times, first_window, first_offset in rows:
            nth = np.arange(per * times)
            pieces = order[at[kind] + rank + nth]
            number[pieces] = first_window + nth // per
            offset[pieces] = first_offset + nth % per * kind
        # pieces are in the schedule's order: a window stands where its earliest piece stands
        earliest = np.unique(number, return_index=True)[1]
        place = np.empty(len(earliest), np.int64)
        place[np.argsort(earliest)] = np.arange(len(earliest))
        return pa.table({"piece": table.column("piece"), "range": table.column("range"), "window": place[number], "offset": offset,
                         "windows": np.full(len(order), len(earliest))}, schema=schema)

    return run


def _in_order(pieces: DataFrame, places: DataFrame, window: int, carry: Callable[[str], Column]) -> DataFrame:
    """Pieces with their sequences, range by range of the schedule."""
    places = places.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "range", "slot", "place")
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    narrow = pieces.select("piece", "doc_id", "source", "start", "length", "doc_tokens", F.crc32("ids").alias("crc")) \
        .join(places, on).select("piece", "range", "slot", "place", "start", "length", "doc_tokens", "crc")
    planned = saved(narrow.groupBy("range").applyInArrow(
        _planned(window), "piece long, range long, window long, offset long, windows long"), "pack-planned")
    # sums before a group of ranges, then inside it
    ranges = planned.groupBy("range").agg(F.max("windows").alias("windows")) \
        .withColumn("group", F.floor(F.col("range") / BUCKETS))
    group = ranges.groupBy("group").agg(F.sum("windows").alias("n"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    group = group.select("group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    base = ranges.withColumn("in_group", F.coalesce(F.sum("windows").over(inside), F.lit(0))).join(group, "group") \
        .select("range", (F.col("base") + F.col("in_group")).alias("base"))
    found = planned.join(base, "range").select("piece", (F.col("base") + F.col("window")).alias("sequence_id"), "offset")
    return pieces.select("piece", "doc_id", "start", "length", "doc_tokens", carry("ids")).join(found, "piece").drop("piece")


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, end: int = END,
         carry: Callable[[str], Column] = F.col, places: DataFrame | None = None) -> DataFrame:
    """A row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and its ids.

    ``carry`` makes of the ids column (little-endian uint32) what is carried along.
    ``places`` are those of ``mixing.scheduled``, where sequences follow a schedule.
    """
    spark = docs.sparkSession
    source = F.lit(None) if places is None else F.col("source")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       source.cast("string").alias("source"))
    pieces = docs.mapInArrow(_pieces(path or default_tokenizer(), end, window), PIECES)
    if places is not None:
        pieces = saved(pieces.withColumn("piece", F.monotonically_increasing_id()), "pack-pieces")
        return _in_order(pieces, places, window, carry)
    pieces = saved(pieces.drop("source"), "pack-pieces")
    lengths = pieces.groupBy("length").count().collect()  # a row for each length up to the window
    table = plan({r[0]: r[1] for r in lengths}, window)
    names = "length long, first_rank long, per_window long, windows long, first_window long, first_offset long"
    places = spark.createDataFrame(table, names) if table else spark.createDataFrame([], names)

    rows = pieces.select("doc_id", "start", "length", "doc_tokens", carry("ids")) \
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens"), F.lit(BUCKETS)))
    base = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens"), F.lit(BUCKETS))) \
        .groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "doc_tokens")
    ranked = rows.withColumn("_n", F.row_number().over(inside)).join(base, ["length", "bucket"]) \
        .withColumn("rank", F.col("base") + F.col("_n") - 1)
    # the plan's size is bounded by the window's length
    placed = ranked.join(F.broadcast(places), "length") \
        .where((F.col("rank") >= F.col("first_rank"))
               & (F.col("rank") < F.col("first_rank") + F.col("per_window") * F.col("windows")))
    nth = F.col("rank") - F.col("first_rank")
    return placed.withColumn("sequence_id", F.col("first_window") + F.floor(nth / F.col("per_window"))) \
        .withColumn("offset", F.col("first_offset") + F.pmod(nth, F.col("per_window")) * F.col("length")) \
        .drop("bucket", "_n", "base", "rank", "first_rank", "per_window", "windows", "first_window", "first_offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences ``sequence_id, n_tokens, ids`` (an array) of packed pieces with ids."""
    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<u4")
        return pa.table({"sequence_id": table.column("sequence_id")[:1], "n_tokens": pa.array([len(ids)], pa.int64()),
                         "ids": pa.array([ids], pa.list_(pa.int64()))})

    return pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id") \
        .applyInArrow(joined, "sequence_id long, n_tokens long, ids array<long>")
