"""Document fingerprints from closed syncmers.

A window of ``K`` bytes is a closed syncmer if the least hash among its ``S``-byte
substrings stands at its first or last place. Whether it is one depends on the
window alone, so a passage keeps its anchors wherever it stands. A fingerprint is
the sequence of the anchors' 16-bit hashes in text order (base64); a text without
an anchor, a short one above all, is written as the four parts of its own 64-bit hash.

Likeness is positional: equal anchors (the n-th of one text with the n-th of the
other) are matched, the longest chain in the same order in both counts, and the
value is twice its length over the anchors of both (1 for equal texts, 0 for none).

Defined results: null is the empty text, whose fingerprint is its own and equals
that of other empty texts; equal texts have equal fingerprints; documents of equal
id follow each other by text; a single document is its own next one; an empty
table gives an empty result; extra columns are not looked at. Rows without doc_id
come first, in text order.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, utf8
from shoal.llm.hashing import U, Ranges

#: At least one anchor lies in any 2 * K - S - 1 bytes, so a kept passage of that length is found again.
K, S = 24, 8


def anchors(texts: list[bytes], k: int = K, s: int = S) -> list[np.ndarray]:
    """The 16-bit anchors of each text, in order."""
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ranges = Ranges(data)
    n = len(data) - k + 1
    hits = np.zeros(0, np.int64)
    if n > 0:
        places = np.arange(len(data) - s + 1)
        small = (ranges.hash(places, places + s) >> U(32)).astype(np.uint32)
        least, span, w = small, 1, k - s + 1
        while 2 * span <= w:
            least = np.minimum(least[:len(least) - span], least[span:])
            span *= 2
        least = np.minimum(least[:n], least[w - span:w - span + n])
        hits = np.flatnonzero((small[:n] == least) | (small[w - 1:w - 1 + n] == least))
        whose = np.searchsorted(offsets, hits, side="right") - 1
        hits = hits[hits + k <= offsets[whose + 1]]
    value = (ranges.hash(hits, hits + k) >> U(48)).astype("<u2")
    cut = np.searchsorted(hits, offsets)
    whole = ranges.hash(offsets[:-1], offsets[1:]).astype("<u8").view("<u2").reshape(-1, 4)
    return [value[a:b] if b > a else whole[i] for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]


def written(anchor: np.ndarray) -> str:
    return base64.b64encode(anchor.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the longest common chain of matched anchors over the anchors of both."""
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    if not np.isin(a, b).any():
        return 0.0
    places: dict[tuple[int, int], int] = {}
    seen: dict[int, int] = {}
    for j, x in enumerate(b.tolist()):
        places[x, seen.get(x, 0)] = j
        seen[x] = seen.get(x, 0) + 1
    seen = {}
    ends: list[int] = []
    for x in a.tolist():
        t = seen.get(x, 0)
        seen[x] = t + 1
        j = places.get((x, t))
        if j is None:
            continue
        at = bisect_left(ends, j)
        if at == len(ends):
            ends.append(j)
        else:
            ends[at] = j
    return 2 * len(ends) / (len(a) + len(b))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    m = len(text) // 2
    return text[:len(text) - m] + following[:m]


FIELDS = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
          "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}


def _compare(ids: list, texts: list[str], following: list[str]) -> dict[str, list]:
    """Result columns of documents and the documents that follow them."""
    made = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    out: dict[str, list] = {c: [] for c in FIELDS}
    lo = 0
    while lo < len(ids):
        hi, size = lo, 0
        while hi < len(ids) and (hi == lo or size < 1 << 20):
            size += len(texts[hi]) + len(following[hi]) + len(made[hi])
            hi += 1
        n = hi - lo
        # a document's follower is, but for the last, the next document of the list
        chain = [t.encode() for t in texts[lo:hi]] + [following[hi - 1].encode()] + [t.encode() for t in made[lo:hi]]
        found = anchors(chain)
        own, edits = found[:n + 1], found[n + 1:]
        for i in range(n):
            out["fingerprint"].append(written(own[i]))
            out["edited_fingerprint"].append(written(edits[i]))
            out["edited_sha256"].append(hashlib.sha256(chain[n + 1 + i]).hexdigest())
            out["near_edited"].append(likeness(own[i], edits[i]))
            out["near_next"].append(likeness(own[i], own[i + 1]))
        lo = hi
    out["doc_id"], out["n_chars"] = list(ids), [len(t) for t in texts]
    return out


def _chained():
    schema = arrow_schema(**FIELDS)

    def run(batches):
        held: tuple[list, list[str]] = [], []  # the last row so far, whose follower is still to come
        for batch in batches:
            data, off = utf8(batch.column("text"))
            raw = data.tobytes()
            ids = held[0] + batch.column("doc_id").to_pylist()
            texts = held[1] + [raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)]
            if len(ids) > 1:
                found = _compare(ids[:-1], texts[:-1], texts[1:])
                yield pa.RecordBatch.from_arrays([pa.array(found[c], t) for c, t in FIELDS.items()], schema=schema)
            held = ids[-1:], texts[-1:]

    return run


KINDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


def fingerprints(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Texts are dealt once, by ranges of doc_id between quantiles; each range also gets the
    first document of the next one, so that a task meets every follower as it reads.
    The driver sees a quantile and a smallest doc_id for each range.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    quantiles = rows.agg(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n)], 100 * n)).first()[0]
    bounds = F.lit(sorted(set(quantiles or [0])))
    # rows without doc_id are the first range
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.size(F.filter(bounds, lambda b: F.col("doc_id") > b)))
    rows = rows.withColumn("range", place.cast("int"))
    firsts = {r["range"]: r.first for r in rows.groupBy("range").agg(F.min("doc_id").alias("first")).collect()}
    if not firsts:
        return rows.mapInArrow(_chained(), KINDS)
    order = sorted(firsts)
    before = F.create_map(*[F.lit(x) for pair in zip(order, order[-1:] + order[:-1], strict=True) for x in pair])
    is_first = F.col("doc_id").isNull() | F.col("doc_id").isin([i for i in firsts.values() if i is not None])
    following = rows.where(is_first).groupBy("range").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")) \
        .select("doc_id", "text", before[F.col("range")].alias("range"), F.lit(True).alias("beyond"))
    dealt = rows.withColumn("beyond", F.lit(False)).unionByName(following) \
        .repartitionById(order[-1] + 1, F.col("range")).sortWithinPartitions("beyond", "doc_id", "text")
    return dealt.select("doc_id", "text").mapInArrow(_chained(), KINDS)
