"""Token ids in grammar-compressed files (Re-Pair), with random-access decoding.

Documents are encoded in ascending doc_id order and gathered in shards of about
``SHARD_IDS`` ids. In each shard id pairs are replaced by nonterminals, round after
round: all pairs are counted, of overlapping occurrences the one of the more frequent
pair is replaced (in a run of one pair every second, from the first), and rounds go on
until no pair saves more bits than its rule takes. Rules and expansion lengths are
stored before the symbols, so any id range of a document is decoded from its own
symbols. No rule crosses the end of a document.

A shard is one binary value (little-endian): ``RPG2``, uint32 counts of documents,
rules and symbols, uint32 first rule's symbol, uint8 bits of a symbol and of an
expansion length; per document an int64 doc_id, a uint8 null mark, uint32 place of
its first symbol and uint64 place of its first id (each with the total at the end);
then bit-packed in uint64 words: two symbols a rule, an expansion length a rule, the
symbols. Shards are rows of a Parquet folder, numbered by partition and place.

Defined results: null is the empty text, which has the end id only; rows of one
doc_id follow each other by text, rows without one come first; an empty table gives
no shards and an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, text_chunks
from shoal.llm.tokens import END, default_tokenizer, encode_documents

SHARD_IDS = 1 << 19
#: A rule takes two symbols and a length; a pair found less often saves nothing.
LEAST = 4
MAGIC = b"RPG2"


def packed(values: np.ndarray, bits: int) -> bytes:
    """Values of ``bits`` bits (up to 63) each, in uint64 words."""
    values = values.astype(np.uint64)
    if not len(values):
        return b""
    at = np.arange(len(values)) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    out = np.zeros((len(values) * bits + 63) // 64, np.uint64)
    out[word[begin]] = np.add.reduceat(values << shift, begin)
    over = np.flatnonzero((at & 63) + bits > 64)
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - shift[over])
    return out.astype("<u8").tobytes()


def unpacked(words: np.ndarray, count: int, bits: int) -> np.ndarray:
    at = np.arange(count) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    words = np.append(words, np.uint64(0))
    out = words[word] >> shift
    over = np.flatnonzero((at & 63) + bits > 64)
    out[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return (out & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _bits(most: int) -> int:
    return max(int(most).bit_length(), 1)


def _counted(left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs found ``least`` times or more, the number of each occurrence's pair (-1 for rarer ones), and counts;
    pairs of 32-bit symbols side by side."""
    width = _bits(len(left))
    side = _bits(max(int(left.max()), int(right.max())))
    if 2 * side + width > 64:
        names, which, count = np.unique(left.astype(np.uint64) << np.uint64(32) | right, return_inverse=True, return_counts=True)
        often = count >= least
        return names[often], np.where(often, np.cumsum(often) - 1, -1)[which], count[often]
    # the place rides along in the low bits: one plain sort instead of an indirect one
    key = left.astype(np.uint64)
    key <<= np.uint64(side)
    key |= right
    key <<= np.uint64(width)
    key |= np.arange(len(key), dtype=np.uint64)
    key.sort()
    place = (key & np.uint64((1 << width) - 1)).astype(np.int64)
    key >>= np.uint64(width)
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(begin, append=len(key))
    often = count >= least
    which = np.empty(len(key), np.int32)
    which[place] = np.repeat(np.where(often, np.cumsum(often) - 1, -1).astype(np.int32), count)
    names = key[begin[often]]
    return (names >> np.uint64(side)) << np.uint64(32) | (names & np.uint64((1 << side) - 1)), which, count[often]


def _chosen(at: np.ndarray, which: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of occurrences at places ``at`` those replaced: none overlap, the more frequent pair goes first."""
    rank = np.empty(len(count), np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    level = rank[which]
    touch = at[1:] == at[:-1] + 1
    same = touch & (level[1:] == level[:-1])
    begin = np.concatenate(([True], ~same))
    run = np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
    free = (np.arange(len(at)) - run) % 2 == 0
    free[1:] &= ~(touch & (level[:-1] > level[1:]))
    free[:-1] &= ~(touch & (level[1:] > level[:-1]))
    return free


def compress(ids: np.ndarray, last: np.ndarray, first_rule: int | None = None, least: int = LEAST):
    """``(symbols, last, rules, lengths)``; ``last`` marks the ends of documents."""
    first_rule = int(ids.max(initial=0)) + 1 if first_rule is None else first_rule
    seq, rules, lengths = ids.astype(np.uint32), [], [np.ones(0, np.uint32)]
    n_rules = 0
    size = np.ones(0, np.uint32)
    # places whose pair may pay: a pair too rare once stays so unless one of its symbols is new
    live = ~last
    ends = np.flatnonzero(last)
    while True:
        at = np.flatnonzero(live[:-1])
        if not len(at):
            break
        names, which, count = _counted(seq[at], seq[at + 1], least)
        hit = np.flatnonzero(which >= 0)
        at, which = at[hit], which[hit]
        if not len(at):
            break
        live = np.zeros(len(seq), bool)
        live[at] = True
        free = _chosen(at, which, count)
        at, which = at[free], which[free]
        found = np.bincount(which, minlength=len(names))
        worth = found >= least
        if not worth.any():
            break
        keep = worth[which]
        at, which = at[keep], (np.cumsum(worth) - 1)[which[keep]]
        names = names[worth]
        left, right = (names >> np.uint64(32)).astype(np.uint32), (names & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rules.append(np.column_stack([left, right]))
        lengths.append(_length(left, size, first_rule) + _length(right, size, first_rule))
        size = np.concatenate(lengths)
        seq[at] = first_rule + n_rules + which
        live[at] = live[np.maximum(at - 1, 0)] = True
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, live = seq[stay], live[stay]
        ends = ends - np.searchsorted(at + 1, ends, side="right")
        live[ends] = False
        n_rules += len(names)
    last = np.zeros(len(seq), bool)
    last[ends] = True
    return seq, last, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), size


def _length(symbols: np.ndarray, size: np.ndarray, first_rule: int) -> np.ndarray:
    """Expansion lengths of symbols."""
    out = np.ones(len(symbols), np.uint32)
    rule = symbols >= first_rule
    out[rule] = size[symbols[rule] - first_rule]
    return out


def pack_shard(doc_ids: list, ids: np.ndarray, start: np.ndarray) -> bytes:
    """The bytes of a shard of documents, whose ids start at ``start``."""
    last = np.zeros(len(ids), bool)
    last[start[1:] - 1] = True
    first_rule = int(ids.max(initial=0)) + 1
    seq, last, rules, size = compress(ids, last, first_rule)
    symbol_start = np.concatenate(([0], np.flatnonzero(last) + 1)).astype("<u4")
    bits, long = _bits(first_rule + len(rules)), _bits(size.max(initial=0))
    return b"".join([
        MAGIC, struct.pack("<IIIIBB", len(doc_ids), len(rules), len(seq), first_rule, bits, long),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
        symbol_start.tobytes(), start.astype("<u8").tobytes(),
        packed(rules.ravel(), bits), packed(size, long), packed(seq, bits)])


class Shard:
    """Reads documents, or ranges of their ids, out of a shard's bytes."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a grammar shard")
        n, r, s, self.first_rule, bits, long = struct.unpack_from("<IIIIBB", raw, 4)
        at = 4 + struct.calcsize("<IIIIBB")

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        def take_bits(count: int, width: int) -> np.ndarray:
            return unpacked(take("<u8", (count * width + 63) // 64), count, width)

        ids, null = take("<i8", n), take("u1", n)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null, strict=True)]
        self.symbol_start, self.start = take("<u4", n + 1), take("<u8", n + 1).astype(np.int64)
        self.rules = take_bits(2 * r, bits).reshape(r, 2)
        self.size = take_bits(r, long)
        self.symbols = take_bits(s, bits)
        self._store = None

    def _expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every symbol in a row, and where each symbol's start."""
        if self._store is None:
            flat = self.rules.ravel()
            while len(at := np.flatnonzero(flat >= self.first_rule)):
                width = np.ones(len(flat), np.int64)
                width[at] = 2
                out, pair = np.repeat(flat, width), self.rules[flat[at] - self.first_rule]
                at += np.arange(len(at))  # every rule before takes a place more
                out[at], out[at + 1] = pair[:, 0], pair[:, 1]
                flat = out
            flat = np.concatenate((np.arange(self.first_rule, dtype=np.uint32), flat))
            begin = np.concatenate((np.arange(self.first_rule), self.first_rule + np.cumsum(self.size, dtype=np.int64) - self.size))
            self._store = flat, begin
        return self._store

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._expanded()
        size = _length(symbols, self.size, self.first_rule).astype(np.int64)
        before = np.cumsum(size) - size
        return flat[np.repeat(begin[symbols] - before, size) + np.arange(size.sum())]

    def ids(self, doc: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of the shard's document number ``doc``; only symbols that reach there are expanded."""
        symbols = self.symbols[self.symbol_start[doc]:self.symbol_start[doc + 1]]
        ends = np.cumsum(_length(symbols, self.size, self.first_rule).astype(np.int64))
        hi = int(ends[-1]) if hi is None else min(hi, int(ends[-1]))
        lo = min(lo, hi)
        a, b = np.searchsorted(ends, [lo, hi], side="right")
        before = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b + 1])[lo - before:hi - before]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        flat = self.expand(self.symbols)
        for i, doc_id in enumerate(self.doc_ids):
            yield doc_id, flat[self.start[i]:self.start[i + 1]]


SHARD_KIND = "pid long, block long, before long, n_docs long, n_ids long, shard binary"
SHARD_SCHEMA = arrow_schema(pid=pa.int64(), block=pa.int64(), before=pa.int64(), n_docs=pa.int64(),
                            n_ids=pa.int64(), shard=pa.binary())


def _shards(path: str, end: int):
    def run(batches):
        pid, block, before = None, 0, 0
        names, parts, sizes = [], [], []

        def flush():
            nonlocal block, before, names, parts, sizes
            ids = np.concatenate(parts)
            start = np.concatenate(([0], np.cumsum(sizes)))
            row = [pid, block, before, len(names), len(ids), pack_shard(names, ids, start)]
            block, before = block + 1, before + len(ids)
            names, parts, sizes = [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, SHARD_SCHEMA, strict=True)],
                                              schema=SHARD_SCHEMA)

        for batch in batches:
            if batch.num_rows:
                pid = batch.column("pid")[0].as_py()
            doc_ids = batch.column("doc_id").to_pylist()
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                ids, start = encode_documents([raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)], path, end)
                names += doc_ids[lo:hi]
                parts.append(ids)
                sizes += np.diff(start).tolist()
                if sum(map(len, parts)) >= SHARD_IDS:
                    yield flush()
        if names:
            yield flush()

    return run


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Encode all texts in ascending doc_id order into grammar shards under ``folder``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text") \
        .withColumn("pid", F.spark_partition_id().cast("long"))
    rows.mapInArrow(_shards(path or default_tokenizer(), end), SHARD_KIND).write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARD_KIND).parquet(folder)


def _decoded():
    schema = arrow_schema(pid=pa.int64(), doc_id=pa.int64(), within=pa.int64(), n_tokens=pa.int64(), ids=pa.binary())

    def run(batches):
        for batch in batches:
            t = batch.to_pydict()
            for pid, before, raw in zip(t["pid"], t["before"], t["shard"], strict=True):
                shard = Shard(raw)
                docs = [(d, x.astype("<u4", copy=False)) for d, x in shard.documents()]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid] * n, pa.int64()), pa.array([d for d, _ in docs], pa.int64()),
                     pa.array(before + shard.start[:-1]), pa.array([len(x) for _, x in docs], pa.int64()),
                     pa.array([x.tobytes() for _, x in docs], pa.binary())], schema=schema)

    return run


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and the ids (little-endian uint32), or their crc32, from the files."""
    shards = read_shards(spark, folder)
    rows = shards.mapInArrow(_decoded(), "pid long, doc_id long, within long, n_tokens long, ids binary")
    if digest:
        rows = rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    # one row for each partition that was written
    sizes = shards.groupBy("pid").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("pid", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return rows.join(offsets, "pid").withColumn("start", F.col("base") + F.col("within")).drop("pid", "base", "within")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
