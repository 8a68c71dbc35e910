"""Byte-level BPE by ranks, encoding and decoding, with a two-tier lookup.

A text is cut into pre-tokens. The first tier is a minimal perfect hash over the
vocabulary: keys fall into small buckets, and each bucket, largest first, gets the
first displacement that sends its keys to free slots (a bucket of one key is sent
straight to a slot left over), so there are as many slots as keys. A pre-token's
slot names the only id it can have; its bytes are compared, and where they are equal
that id is the whole answer. The second tier merges the bytes of the other
pre-tokens: a linked list of parts and a heap of the pairs that have a rank, least
rank first and of equal ranks the leftmost, as the rank files ask. A merged
pre-token stays in the worker's store; bytes, not only hashes, are compared there
too.

Letters, numbers and blanks are the splitter library's own: of code points whose
class may depend on the Unicode version, ``tiktoken`` is asked once, by probes that
show what it leaves in one piece.

Defined results: null and empty texts have no ids; the strings of special tokens are
plain text; bytes that are no UTF-8 are read as U+FFFD; repeated rows are repeated; an
empty table gives an empty result; extra columns are not looked at. Decoding null or
no ids gives no bytes; null ids in a list are passed over; an id that the file
doesn't have is an error. A text is handled whole in one task.
"""

from __future__ import annotations

import base64
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, ragged, text_chunks
from shoal.llm.hashing import Ranges, U, mix
from shoal.llm.tokens import BLANK, LETTER, NUMBER, OTHER, UNSURE, classes, split

#: Mean keys in a bucket of the perfect hash, and displacements tried at once.
BUCKET = 4
TRIES = 256
#: The store of merged pre-tokens is emptied beyond this many.
MOST_MERGED = 1_000_000
#: Code points that stand for a class when the text is split.
STANDS = {LETTER: 0xE9, NUMBER: 0x30, OTHER: 0x21, BLANK: 0x3000}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary by id; ids are the ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    out: list[bytes] = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def laid_out(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in a row, and where each part starts (and the end)."""
    off = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=off[1:])
    return np.frombuffer(b"".join(parts), np.uint8), off


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Every place of the ranges ``[start, start + size)``, range after range."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def same_bytes(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes of ``a`` and of ``b`` are equal, for each pair of ranges."""
    unlike = a[runs(a_start, size)] != b[runs(b_start, size)]
    before = np.concatenate(([0], np.cumsum(unlike)))
    end = np.cumsum(size)
    return before[end] == before[end - size]


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes: slot of each, no slot empty."""

    def __init__(self, keys: np.ndarray):
        self.n, self.buckets = len(keys), max(1, -(-len(keys) // BUCKET))
        self.shift = np.zeros(self.buckets, np.int64)
        self.keys = np.zeros(self.n, np.int64)  # slot -> place in ``keys``
        bucket = (keys % U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(size) - size
        free = np.ones(self.n, bool)
        single = []
        for b in np.argsort(-size, kind="stable").tolist():
            own = order[first[b]:first[b] + size[b]]
            if len(own) < 2:
                if len(own):
                    single.append((b, int(own[0])))
                continue
            at = 0
            while True:
                slots = self._slots(keys[own][None, :], np.arange(at, at + TRIES)[:, None])
                ranked = np.sort(slots, axis=1)
                good = free[slots].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if good.any():
                    k = int(np.argmax(good))
                    self.shift[b] = at + k
                    free[slots[k]] = False
                    self.keys[slots[k]] = own
                    break
                at += TRIES
        for (b, key), slot in zip(single, np.flatnonzero(free).tolist(), strict=True):
            self.shift[b] = -1 - slot
            self.keys[slot] = key

    def _slots(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + shift.astype(np.uint64) * U(0x9E3779B97F4A7C15)) % U(self.n)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of the only key each of ``keys`` can be."""
        shift = self.shift[(keys % U(self.buckets)).astype(np.int64)]
        return self.keys[np.where(shift < 0, -1 - shift, self._slots(keys, shift))]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: a heap of pairs over linked bytes."""
    n = len(piece)
    right = list(range(1, n + 1))  # where the part that starts here ends; -1: no part starts here
    left = list(range(-1, n))
    heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        middle = right[i]
        if middle < 0 or middle >= n or right[middle] != end:
            continue  # one of the two parts has grown meanwhile
        right[i], right[middle] = end, -1
        left[end] = i
        before = left[i]
        if before >= 0 and (rank := ranks.get(piece[before:end])) is not None:
            heappush(heap, (rank, before, end))
        if end < n and (rank := ranks.get(piece[i:right[end]])) is not None:
            heappush(heap, (rank, i, right[end]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:right[i]]])
        i = right[i]
    return ids


@cache
def _probe():
    """An encoding that joins a character with the first byte of what follows, if the splitter leaves both together."""
    import public_tokenizers
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}
    for a in b"a1!":
        for second in range(256):
            ranks[bytes([a, second])] = len(ranks)
    return tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def stands_for(point: int) -> int:
    """A code point of known class that the splitter treats as it treats ``point``."""
    for kind, char in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        if _probe().encode_ordinary(char + chr(point))[0] >= 256:
            return STANDS[kind]
    return STANDS[BLANK]


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined UTF-8 bytes, where pre-tokens start and end in them, and each text's first pre-token (and the end)."""
    joined = "".join(texts)
    data = np.frombuffer(joined.encode(), np.uint8)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=first[1:])
    unsure = np.flatnonzero(classes()[points] == UNSURE)
    if len(unsure):
        points = points.copy()
        kinds, which = np.unique(points[unsure], return_inverse=True)
        points[unsure] = np.array([stands_for(int(c)) for c in kinds], np.uint32)[which]
    start = split(points, first)
    byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = byte[np.append(start, len(points))]
    return data, at[:-1], at[1:], np.searchsorted(start, first)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.flat, off = laid_out(tokens)
        self.at, self.size = off[:-1], np.diff(off)
        known = np.flatnonzero(self.size)
        self.ids = known
        self.hash = PerfectHash(Ranges(self.flat).hash(self.at[known], (self.at + self.size)[known]))
        self.ranks: dict[bytes, int] | None = None
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of merged pre-tokens
        self.text_at = np.zeros(0, np.int64)  # their bytes in ``texts``
        self.text_size = np.zeros(0, np.int64)
        self.id_at = np.zeros(0, np.int64)  # their ids in ``pool``
        self.id_size = np.zeros(0, np.int64)
        self.texts = np.zeros(0, np.uint8)
        self.pool = np.zeros(0, np.int32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("ranks", "keys", "text_at", "text_size", "id_at", "id_size", "texts", "pool")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ranks = None
        self._empty()

    def merge(self, piece: bytes) -> list[int]:
        if self.ranks is None:
            self.ranks = {t: i for i, t in enumerate(self.tokens) if t}
        return merged(piece, self.ranks)

    def _learn(self, data: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Merge the distinct pre-tokens ``key`` (sorted) and store them."""
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        found = [self.merge(p) for p in pieces]
        size = np.array([len(i) for i in found], np.int64)
        text, off = laid_out(pieces)
        place = np.searchsorted(self.keys, key)
        for name, new in (("keys", key), ("text_at", len(self.texts) + off[:-1]), ("text_size", np.diff(off)),
                          ("id_at", len(self.pool) + np.cumsum(size) - size), ("id_size", size)):
            setattr(self, name, np.insert(getattr(self, name), place, new))
        self.texts = np.concatenate([self.texts, text])
        self.pool = np.concatenate([self.pool, np.array([x for i in found for x in i], np.int32)])

    def _merged(self, data: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a row, and where each pre-token's are and how many."""
        names, one, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(names) > MOST_MERGED:
            self._empty()
        place = np.minimum(np.searchsorted(self.keys, names), max(len(self.keys) - 1, 0))
        new = self.keys[place] != names if len(self.keys) else np.ones(len(names), bool)
        if new.any():
            self._learn(data, names[new], start[one[new]], end[one[new]])
        place = np.searchsorted(self.keys, names)[which]
        pool, at, size = self.pool, self.id_at[place], self.id_size[place]
        same = self.text_size[place] == end - start
        same[same] = same_bytes(data, start[same], self.texts, self.text_at[place[same]], (end - start)[same])
        for i in np.flatnonzero(~same).tolist():  # another text with the same hash
            ids = self.merge(data[start[i]:end[i]].tobytes())
            at[i], size[i] = len(pool), len(ids)
            pool = np.concatenate([pool, np.array(ids, np.int32)])
        return pool, at, size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start (and the end)."""
        data, start, end, first = pretokens(texts)
        key = Ranges(data).hash(start, end)
        ids = self.ids[self.hash.find(key)]
        hit = self.size[ids] == end - start
        hit[hit] = same_bytes(data, start[hit], self.flat, self.at[ids[hit]], self.size[ids[hit]])
        n = np.ones(len(start), np.int64)
        miss = np.flatnonzero(~hit)
        pool, at, size = self._merged(data, key[miss], start[miss], end[miss])
        n[miss] = size
        total = np.concatenate(([0], np.cumsum(n)))
        out = np.empty(total[-1], np.int32)
        out[total[:-1][hit]] = ids[hit]
        out[runs(total[miss], size)] = pool[runs(at, size)]
        return out, total[first]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and where each list's bytes start (and the end)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        size = self.size[ids]
        total = np.concatenate(([0], np.cumsum(size)))
        return self.flat[runs(self.at[ids], size)], total[first]


def _shipped(docs: DataFrame, path: str | None):
    """The codec, built once on the driver and sent to each executor once; its size is the vocabulary's."""
    return docs.sparkSession.sparkContext.broadcast(ByteBpe(read_ranks(path or default_ranks())))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (an array) of every whole text."""
    codec = _shipped(docs, path)
    schema = arrow_schema(doc_id=pa.int64(), ids=pa.list_(pa.int32()))

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                ids, first = codec.value.encode([raw[a:b].decode(errors="replace") for a, b in zip(off[:-1], off[1:], strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], ragged(ids, np.diff(first), pa.int32())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids array<int>")


#: Ids decoded at once inside a task; a longer single list is handled alone.
CHUNK_IDS = 1 << 18


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, data`` (bytes) of lists of ids."""
    codec = _shipped(encoded, path)
    schema = arrow_schema(doc_id=pa.int64(), ids=pa.list_(pa.int32()), data=pa.binary())

    def run(batches):
        for batch in batches:
            column = batch.column("ids")
            size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            total = np.concatenate(([0], np.cumsum(size)))
            lo = 0
            while lo < len(column):
                hi = max(lo + 1, int(np.searchsorted(total, total[lo] + CHUNK_IDS, side="right")) - 1)
                values, first = column[lo:hi].flatten(), total[lo:hi + 1] - total[lo]
                if values.null_count:
                    kept = values.is_valid().to_numpy(zero_copy_only=False)
                    first = np.concatenate(([0], np.cumsum(kept)))[first]
                    values = values.drop_null()
                data, off = codec.value.decode(values.to_numpy(zero_copy_only=False), first)
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], column[lo:hi],
                     pa.array([raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary())], schema=schema)
                lo = hi

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")) \
        .mapInArrow(run, "doc_id long, ids array<int>, data binary")
