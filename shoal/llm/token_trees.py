"""Token counts that follow edits without encoding a document anew.

A document's pre-tokens (code points and ids of each) are the leaves of a segment
tree with their sums. An edit replaces a range of code points. Pre-tokens are cut
left to right, and where one ends depends on the text up to the second code point
after it, so cutting starts again at the first pre-token that ends later than two
code points before the edit, and stops where a new cut falls on an old one behind
it; only that region is encoded, and the sums above its leaves are updated.

Texts that the fast splitter leaves to the library are a tree of one leaf and are
encoded whole after each edit.

Defined results: null is the empty text, with no pre-tokens; ranges are cut to the
text as it stands before the edit; edits apply in the order given; null edits are
none; repeated rows are repeated; an empty table gives an empty result; extra columns
are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, ragged, text_chunks
from shoal.llm.tokens import Encoder, default_tokenizer, encoder

BLOCK = 64


class CountTree:
    """Sums over blocks of pre-tokens, in a binary tree."""

    def __init__(self, chars: np.ndarray, ids: np.ndarray):
        self._build([(chars[i:i + BLOCK], ids[i:i + BLOCK]) for i in range(0, max(len(chars), 1), BLOCK)])

    def _build(self, blocks: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.blocks = blocks
        self.width = 1 << (len(blocks) - 1).bit_length()
        self.chars, self.ids = [0] * (2 * self.width), [0] * (2 * self.width)
        for b, (c, t) in enumerate(blocks):
            self.chars[self.width + b], self.ids[self.width + b] = int(c.sum()), int(t.sum())
        for i in range(self.width - 1, 0, -1):
            self._pull(i)

    def _pull(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.ids[i] = self.ids[2 * i] + self.ids[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_ids(self) -> int:
        return self.ids[1]

    def __len__(self) -> int:
        return sum(len(c) for c, _ in self.blocks)

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.concatenate([b[k] for b in self.blocks]) for k in (0, 1))

    def locate(self, place: int) -> tuple[int, int, int]:
        """Block, pre-token in it and its first code point, of the pre-token over ``place``.

        Behind the last code point: one past the last pre-token.
        """
        if place >= self.n_chars:
            return len(self.blocks) - 1, len(self.blocks[-1][0]), self.n_chars
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if place - before >= self.chars[i]:
                before += self.chars[i]
                i += 1
        b = i - self.width
        ends = np.cumsum(self.blocks[b][0])
        k = int(np.searchsorted(ends, place - before, side="right"))
        return b, k, before + (int(ends[k - 1]) if k else 0)

    def cuts(self, place: int, most: int) -> list[tuple[int, int, int]]:
        """The first ``most`` cuts at or behind ``place``: code point, block, pre-token that starts there."""
        b, k, at = self.locate(place)
        out = []
        while len(out) < most:
            while b < len(self.blocks) and k >= len(self.blocks[b][0]):
                b, k = b + 1, 0
            if b == len(self.blocks):
                out.append((self.n_chars, len(self.blocks) - 1, len(self.blocks[-1][0])))
                break
            if at >= place:
                out.append((at, b, k))
            at += int(self.blocks[b][0][k])
            k += 1
        return out

    def put(self, b0: int, k0: int, b1: int, k1: int, chars: np.ndarray, ids: np.ndarray) -> None:
        """Replace the pre-tokens from (b0, k0) up to (b1, k1)."""
        merged = tuple(np.concatenate([self.blocks[b0][j][:k0], x, self.blocks[b1][j][k1:]]) for j, x in ((0, chars), (1, ids)))
        none = np.zeros(0, np.int64)
        self.blocks[b0] = merged
        for b in range(b0 + 1, b1 + 1):
            self.blocks[b] = none, none
        if len(merged[0]) > 4 * BLOCK:
            parts = [(merged[0][i:i + BLOCK], merged[1][i:i + BLOCK]) for i in range(0, len(merged[0]), BLOCK)]
            self._build(self.blocks[:b0] + parts + [x for x in self.blocks[b0 + 1:] if len(x[0])])
            return
        for b in range(b0, b1 + 1):
            i = self.width + b
            self.chars[i], self.ids[i] = int(self.blocks[b][0].sum()), int(self.blocks[b][1].sum())
            while i > 1:
                i //= 2
                self._pull(i)


class CountedText:
    """A text with its tree."""

    def __init__(self, text: str, enc: Encoder, leaves: tuple[np.ndarray, np.ndarray] | None = None):
        self.text, self.enc, self.encoded = text, enc, 0
        chars, ids = leaves or enc.counts([text])[0]
        self.tree = CountTree(np.asarray(chars, np.int64), np.asarray(ids, np.int64))
        self.whole = bool(enc.odd([text])[0])

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace code points ``start`` to ``stop`` by ``new``."""
        old = self.text
        start = min(max(start, 0), len(old))
        stop = min(max(stop, start), len(old))
        self.text = old[:start] + new + old[stop:]
        # an added token's string may begin before the new text or end behind it
        around = self.text[max(start - self.enc.reach, 0):start + len(new) + self.enc.reach]
        if self.whole or self.enc.odd([around])[0]:
            again = CountedText(self.text, self.enc)
            self.tree, self.whole, self.encoded = again.tree, again.whole, self.encoded + len(again.tree)
            return
        shift = len(self.text) - len(old)
        b0, k0, begin = self.tree.locate(max(start - 2, 0))
        reach = 8
        while True:
            cuts = self.tree.cuts(stop, reach)
            end = cuts[-1][0]
            region = self.text[begin:end + shift]
            chars, ids = self.enc.short_counts(region)
            to_end = end == len(old)
            at = begin + np.concatenate(([0], np.cumsum(chars)))
            sure = set((at if to_end else at[at <= end + shift - 2]).tolist())
            meet = next((c for c in cuts if c[0] + shift in sure and (to_end or c[0] < end)), None)
            self.encoded += len(chars)
            if meet is not None:
                break
            reach *= 4
        n = int(np.searchsorted(at, meet[0] + shift))
        self.tree.put(b0, k0, meet[1], meet[2], chars[:n], ids[:n])


LEAVES = "doc_id long, text string, leaf_chars array<int>, leaf_ids array<int>, n_tokens long"


def build_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The leaves of every document's tree: ``doc_id, text, leaf_chars, leaf_ids, n_tokens``."""
    path = path or default_tokenizer()
    schema = arrow_schema(doc_id=pa.int64(), text=pa.string(), leaf_chars=pa.list_(pa.int32()),
                          leaf_ids=pa.list_(pa.int32()), n_tokens=pa.int64())

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)]
                found = encoder(path).counts(texts)
                size = np.array([len(c) for c, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array(texts, pa.string()),
                     *[ragged(np.concatenate([x[k] for x in found]).astype(np.int32), size, pa.int32()) for k in (0, 1)],
                     pa.array([int(t.sum()) for _, t in found], pa.int64())], schema=schema)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, LEAVES)


EDITS = "array<struct<start:long,stop:long,text:string>>"


def count_edits(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Counts before and after the edits of column ``edits`` (an array of start, stop, text).

    Rows of ``build_trees`` bring their leaves along; others are encoded first.
    ``doc_id, n_tokens, n_segments, edited_tokens, edited_segments, encoded_segments, edited_text``.
    """
    path = path or default_tokenizer()
    schema = arrow_schema(doc_id=pa.int64(), n_tokens=pa.int64(), n_segments=pa.int64(), edited_tokens=pa.int64(),
                          edited_segments=pa.int64(), encoded_segments=pa.int64(), edited_text=pa.string())

    def run(batches):
        for batch in batches:
            doc_ids, edits = batch.column("doc_id"), batch.column("edits").to_pylist()
            for lo, hi, data, off in text_chunks(batch.column("text")):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)]
                enc = encoder(path)
                rows = []
                known = leaves_of(batch, lo, hi) if kept else enc.counts(texts)
                for text, leaves, changes in zip(texts, known, edits[lo:hi], strict=True):
                    doc = CountedText(text, enc, leaves)
                    was = doc.tree.n_ids, len(doc.tree)
                    for c in changes or ():
                        if c is not None:
                            doc.edit(c["start"] or 0, c["stop"] or 0, c["text"] or "")
                    rows.append((*was, doc.tree.n_ids, len(doc.tree), doc.encoded, doc.text))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids[lo:hi], *[pa.array([r[k] for r in rows], schema.field(k + 1).type) for k in range(6)]], schema=schema)

    kept = {"leaf_chars", "leaf_ids"} <= set(docs.columns)

    def leaves_of(batch, lo, hi):
        return [tuple(batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("leaf_chars", "leaf_ids"))
                for i in range(lo, hi)]

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("edits").cast(EDITS).alias("edits"), *(["leaf_chars", "leaf_ids"] if kept else []))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, n_segments long, edited_tokens long, edited_segments long, "
                                "encoded_segments long, edited_text string")
