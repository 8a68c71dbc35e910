"""Near-duplicate documents by circulant MinHash with exact verification.

Two permutations make every coordinate of a signature: the first spreads the
shingles over ``0 .. D-1``, the second, ``PI``, is read circularly shifted by k for
coordinate k, so coordinate k of a set is ``min PI[(s + k) mod D]``. The values a
shingle gives to all coordinates lie side by side in ``PI``, which makes a
signature one running minimum over slices.

1. Equal shingle sets are one node (a hot group of copies costs one node).
2. Nodes that share a band of signature rows are candidates; each bucket links
   its members to its smallest node only, and the components of these links are
   the candidate clusters. With 64 bands of 7 rows a pair at similarity 0.8 is
   missed once in about three million.
3. Inside a cluster, full sets are compared in blocks of bounded size (one
   matrix product gives all intersections of a block). First every block with
   itself and with the cluster's smallest node; then, where a cluster still falls
   apart, the nodes outside its largest part against all of it, block by block.
4. Components of the verified links; a document stays if it is the smallest.

Defined results: null or empty text has no shingles and no link; a text of fewer
words than a shingle has one shingle, the whole sequence; repeated rows are
repeated in the result; rows that share a doc_id are one node per text and share
a component; a row without doc_id has no component and is kept; an empty table
gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, blobs, ragged, saved, text_chunks
from shoal.llm.graph import components
from shoal.llm.hashing import LOWER, SHINGLE, U, Ranges, mix, shingles, words

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 64, 7
#: Size D of the permuted range, a power of two.
RANGE = 1 << 18
BLOCK = 192

_TABLE: dict[int, np.ndarray] = {}


def _permutation(width: int) -> np.ndarray:
    """Row i is ``PI[i .. i + width)``, circular."""
    if width not in _TABLE:
        pi = np.random.Generator(np.random.PCG64(71)).permutation(RANGE).astype(np.int32)
        _TABLE[width] = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:width]]), width)
    return _TABLE[width]


def signature(sorted_set: np.ndarray, width: int) -> np.ndarray:
    """The circulant signature of one set of 64-bit shingles."""
    rows = _permutation(width)
    # the first permutation: a bijective mixer, of which the top bits choose a place in 0 .. D-1
    at = (mix(sorted_set * U(0xA0761D6478BD642F)) >> U(64 - 18)).astype(np.int64)
    sig = rows[at[:1024]].min(axis=0)
    for i in range(1024, len(at), 1024):
        np.minimum(sig, rows[at[i:i + 1024]].min(axis=0), out=sig)
    return sig


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    low = LOWER[data]
    start, end, first = words(low, offsets)
    sh, at = shingles(Ranges(low).hash(start, end), first, k)
    for i in range(len(offsets) - 1):
        s = np.sort(sh[at[i]:at[i + 1]])
        yield s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def _signed(k: int, bands: int, rows: int):
    schema = arrow_schema(doc_id=pa.int64(), n_shingles=pa.int64(), set_a=pa.int64(), set_b=pa.int64(),
                          bands=pa.list_(pa.int64()))

    def run(batches):
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                n, keys, flat, sizes = [], [], [], []
                for s in shingle_sets(data, off, k):
                    n.append(len(s))
                    m = mix(s + U(0x1234567)) if len(s) else s
                    keys.append((int(m.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(m)) if len(m) else 0))
                    if len(s):
                        sig = signature(s, bands * rows).reshape(bands, rows).astype(np.uint64)
                        flat.append(mix((sig * SHINGLE[:rows]).sum(axis=1, dtype=np.uint64) + salt))
                    sizes.append(bands if len(s) else 0)
                key = np.array(keys, np.uint64).reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi].cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(key[:, 0]), pa.array(key[:, 1]),
                     ragged(np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64),
                            np.array(sizes), pa.int64())], schema=schema)

    return run, schema


def _sets(k: int):
    schema = arrow_schema(node=pa.int64(), cluster=pa.int64(), blocks=pa.int64(), shingles=pa.binary())

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                out = [s.tobytes() for s in shingle_sets(data, off, k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[lo:hi] for c in ("node", "cluster", "blocks")] + [blobs(out)], schema=schema)

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, in bounded memory."""
    sizes = np.array([len(s) for s in left + right])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.concatenate(left + right) if len(sizes) else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    owner, group = owner[shared], group[shared]
    group = np.unique(group, return_inverse=True)[1]
    total = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(group[-1]) + 1 if len(group) else 0, columns):
        a, b = np.searchsorted(group, [lo, lo + columns])
        m = np.zeros((len(sizes), columns), np.float32)
        m[owner[a:b], group[a:b] - lo] = 1
        total += m[:len(left)] @ m[len(left):].T
    return total.astype(np.int64)


def _forest(a: np.ndarray, b: np.ndarray, label: list) -> list[tuple]:
    """Of the links between places a[i] and b[i], those that join different labels yet apart."""
    parent = {x: x for x in label}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(label[i]), top(label[j])
        if x != y:
            parent[x] = y
            out.append((i, j))
    return out


def _linked(similarity: float):
    percent = round(similarity * 100)
    schema = arrow_schema(a=pa.int64(), b=pa.int64())

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_pylist()
        part = table.column("part").to_pylist()
        left = np.array(table.column("left").to_pylist(), bool)
        right = np.array(table.column("right").to_pylist(), bool)
        if len(set(part)) < 2:
            return pa.table({"a": [], "b": []}, schema=schema)
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        li, ri = np.flatnonzero(left), np.flatnonzero(right)
        both = intersections([sets[i] for i in li], [sets[i] for i in ri])
        size = np.array([len(s) for s in sets])
        union = size[li][:, None] + size[ri][None, :] - both
        x, y = np.nonzero(100 * both >= percent * union)
        x, y = li[x], ri[y]
        keep = x != y
        pairs = _forest(x[keep], y[keep], part)
        return pa.table({"a": [node[i] for i, _ in pairs], "b": [node[j] for _, j in pairs]}, schema=schema)

    return run


LINKS = "a long, b long"


def near_duplicates(docs: DataFrame, words_in_shingle: int = WORDS, similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, _ = _signed(words_in_shingle, bands, rows)
    signed = saved(docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"),
                   "near-signed")
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"))
    hits = full.join(nodes.select("node"), F.col("doc_id") == F.col("node"), "left_semi") \
        .select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    centre = hits.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")) \
        .where("centre < last").select("bucket", "centre")
    near = hits.join(centre, "bucket").where("node != centre") \
        .select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    # rows that share a doc_id but not a text meet in their node
    member = components(near, "near-clusters")
    size = member.groupBy(F.col("component").alias("cluster")).agg(F.count("*").alias("size"))
    member = saved(member.withColumnRenamed("component", "cluster").join(size, "cluster")
                   .withColumn("blocks", F.ceil(F.col("size") / block)), "near-members")
    sets = saved(docs.join(member, F.col("doc_id") == F.col("node"))
                 .select("node", "cluster", "blocks", "text").dropDuplicates(["node", "text"])
                 .mapInArrow(_sets(words_in_shingle), "node long, cluster long, blocks long, shingles binary"),
                 "near-sets")
    verify = _linked(similarity)
    hub = F.col("node") == F.col("cluster")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    first = sets.withColumn("block", F.explode(F.when(hub, F.sequence(F.lit(0), F.col("blocks") - 1))
                                               .otherwise(F.array(own)))) \
        .withColumn("part", F.monotonically_increasing_id()) \
        .select("cluster", "block", "node", "part", F.lit(True).alias("left"), F.lit(True).alias("right"), "shingles")
    links = saved(first.groupBy("cluster", "block").applyInArrow(verify, LINKS), "near-links")

    # clusters of several blocks that still fall apart: those outside the largest part against all
    wide = sets.where("blocks > 1")
    parts = saved(components(links, "near-parts"), "near-labels")
    label = wide.select("node", "cluster").distinct().join(parts, "node", "left") \
        .withColumn("part", F.coalesce("component", "node")).drop("component")
    count = label.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    most = count.groupBy("cluster").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("all_n"))
    most = most.select("cluster", F.col("top.part").alias("main"),
                       F.ceil((F.col("all_n") - F.col("top.n")) / block).alias("left_blocks")).where("left_blocks > 0")
    todo = wide.join(label.select("node", "part"), "node").join(most, "cluster")
    lefts = todo.where("part != main").withColumn("lb", F.pmod(F.xxhash64("node", F.lit(1)), F.col("left_blocks"))) \
        .withColumn("rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumn("left", F.lit(True)).withColumn("right", F.lit(False))
    rights = todo.withColumn("rb", own) \
        .withColumn("lb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("left_blocks") - 1))) \
        .withColumn("left", F.lit(False)).withColumn("right", F.lit(True))
    cols = ["cluster", "lb", "rb", "node", "part", "left", "right", "shingles"]
    more = lefts.select(cols).unionByName(rights.select(cols)) \
        .groupBy("cluster", "lb", "rb").applyInArrow(verify, LINKS)
    found = components(links.unionByName(more), "near-found")

    whole = signed.join(nodes, ["set_a", "set_b", "n_shingles"], "left") \
        .withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node")))
    # a doc_id may stand for several nodes when its rows differ in text; they share the least component
    out = whole.select("doc_id", "n_shingles", "node").join(found, "node", "left") \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(),
                F.coalesce("component", "node", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def dedup(docs: DataFrame, **how) -> DataFrame:
    """The documents that stay, with all their columns: the smallest doc_id of each group.

    Rows of one doc_id and text are one document, of which the row with the least hash of its other columns
    stays. Unlike texts under one doc_id are documents of their own, which come after the ids of one row, in the
    order of doc_id and text: a group with an id of one row keeps that, any other group its first. Rows
    without doc_id stay; those of null or empty text have no group and stay once for each doc_id and text.
    """
    rows_of = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("__dedup_id")).agg(F.count("*").alias("n"))
    again, low, high = rows_of.agg(F.count_if(F.col("n") > 1), F.min("__dedup_id"), F.max("__dedup_id")).first()
    alone = docs.where("doc_id IS NOT NULL")
    if not again:
        return docs.where("doc_id IS NULL").unionByName(_unmarked(alone, _marks(alone, how), F.col("doc_id").cast("long")))
    repeated = saved(rows_of.where("n > 1").select("__dedup_id"), "dedup-repeated")
    same = F.col("doc_id").cast("long") == F.col("__dedup_id")
    once = _numbered(alone.join(repeated, same, "left_semi"), low, high)
    alone = alone.join(repeated, same, "left_anti")
    marks = saved(_marks(alone.select("doc_id", "text").unionByName(once.select(F.col(VERTEX).alias("doc_id"), "text")), how), "dedup-marks")
    return docs.where("doc_id IS NULL").unionByName(_unmarked(alone, marks, F.col("doc_id").cast("long"))) \
        .unionByName(_unmarked(once, marks, F.col(VERTEX)).drop(VERTEX))


VERTEX = "__dedup_vertex"


def _marks(docs: DataFrame, how: dict) -> DataFrame:
    return near_duplicates(docs, **how).where("kept").select(F.col("doc_id").alias("__kept_id"))


def _unmarked(docs: DataFrame, marks: DataFrame, key) -> DataFrame:
    return docs.join(marks, key == F.col("__kept_id"), "left_semi")


def _numbered(docs: DataFrame, low: int, high: int) -> DataFrame:
    """One row of each doc_id and text, with a number that no doc_id has, in the order of doc_id and text."""
    others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(0))
    one = docs.groupBy("doc_id", "text").agg(F.min_by(rest, F.xxhash64(*others) if others else F.lit(0)).alias("__dedup_rest"))
    free = high + 1 if high < 1 << 62 else min(low, 0) - (1 << 62)
    order = [F.col("doc_id").cast("long").asc(), F.col("text").asc_nulls_first()]
    one = one.repartitionByRange(order[0], F.substring("text", 1, 256).asc_nulls_first()).sortWithinPartitions(*order)
    kept = [F.col(f"__dedup_rest.{c}") if c in others else F.col(c) for c in (f"`{c}`" for c in docs.columns)]
    return saved(one.select(*kept, (F.monotonically_increasing_id() + F.lit(free)).alias(VERTEX)), "dedup-once")
