"""Quality rules: base rules on words and lines, then robust multivariate outliers.

A text's statistics are transformed to a short vector (logarithms and square roots,
which make them about normal). For every language and source the
minimum-covariance-determinant (MCD) estimate of centre and spread is found over
all its rows: starting from two robust initial spreads (medians and median
deviations; the central half of the rows by their largest standardised
deviation), concentration steps keep the ``SHARE`` of rows of least distance and
re-estimate; the start whose spread has the least determinant wins. A text whose
Mahalanobis distance is beyond the cut is rejected.

Every step is a grouped sum over one narrow table of whole numbers (vectors are
rounded to thousandths, so sums don't depend on their order); the distance below
which the wanted share of a group's rows lies comes from a histogram of logarithmic
bins. No group is gathered in one task.

Groups of fewer than ``LEAST_ROWS`` rows (or with a singular spread) use the estimate
of their language, then of all rows; if that fails too, nothing is rejected.

Defined results: null text has no words and fails the base rules; null language or
source are groups of their own; repeated rows are repeated; an empty table gives an
empty result; extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema, saved, text_chunks
from shoal.llm.hashing import SPACE, U, Ranges, mix, shingles, words

SHARE = 0.75
STEPS = 4
LEAST_ROWS = 200
#: A squared distance beyond this is an outlier. Far beyond the chi-square law's usual cuts:
#: good texts have heavy tails (on labelled rows about one in a thousand lies beyond 300),
#: while junk of the kinds labelled lies beyond 450.
CUT = 300.0
UNIT = 1000
#: Bins of a squared distance: so many to a factor e.
BINS = 64
#: Added to each variance (thousandths squared): a spread of 0.05.
FLOOR = 2500.0
#: The median of the chi-square law with six degrees of freedom.
MEDIAN = 5.348

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The symbols of the base statistics.
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LEAD = np.ones(256, bool)
LEAD[0x80:0xC0] = False


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base statistics of each text, and those that only the vector uses."""
    n = len(offsets) - 1
    start, end, first = words(data, offsets)
    count = np.diff(first)
    chars = np.concatenate(([0], np.cumsum(LEAD[data])))
    owner = np.repeat(np.arange(n), count)
    ranges = Ranges(data)
    h = ranges.hash(start, end)

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def per_owner(weights: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=weights, minlength=n).astype(np.int64)

    three, at = shingles(h, first, 3)
    dup = np.zeros(len(h), bool)
    distinct = np.zeros(n, np.int64)
    for i in range(n):
        distinct[i] = len(np.unique(h[first[i]:first[i + 1]]))
        if count[i] < 4:
            continue
        _, which, often = np.unique(three[at[i]:at[i + 1]], return_inverse=True, return_counts=True)
        hit = first[i] + np.flatnonzero(often[which] > 1)
        for j in range(3):
            dup[hit + j] = True

    new_line = np.flatnonzero(data == 10)
    line_of = np.searchsorted(offsets, new_line, side="right") - 1
    every = np.arange(n)
    ls, line_text = _ordered(np.concatenate((offsets[:-1], new_line + 1)), np.concatenate((every, line_of)))
    le, _ = _ordered(np.concatenate((new_line, offsets[1:])), np.concatenate((line_of, every)))
    inside = np.concatenate(([0], np.cumsum(~SPACE[data])))
    worded = inside[le] > inside[ls]
    ls, le, line_text = ls[worded], le[worded], line_text[worded]
    line = mix(ranges.hash(ls, le) + line_text.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    dup_lines = np.ones(len(line), bool)
    dup_lines[np.unique(line, return_index=True)[1]] = False
    return {"n_words": count, "word_chars": per_owner(chars[end] - chars[start]), "n_symbols": per_text(SYMBOL[data]),
            "n_dup_lines": np.bincount(line_text[dup_lines], minlength=n), "n_repeat_words": per_owner(dup),
            "n_upper": per_text(UPPER[data]), "n_lines": np.bincount(line_text, minlength=n), "n_distinct": distinct}


def _ordered(place: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((place, text))
    return place[order], text[order]


def vector(s: dict[str, np.ndarray]) -> np.ndarray:
    """The transformed statistics, in thousandths."""
    n = np.maximum(s["n_words"], 1)
    v = np.column_stack([
        np.log(n),
        2 * np.log(np.maximum(s["word_chars"], 1) / n),
        np.sqrt(s["n_symbols"] / n),
        np.sqrt(s["n_repeat_words"] / n),
        np.sqrt(s["n_upper"] / np.maximum(s["word_chars"], 1)),
        2 * np.sqrt(s["n_distinct"] / np.sqrt(n)) / np.log(n + 2),
    ])
    return np.round(UNIT * v).astype(np.int64)


DIMS = 6


def _measured():
    names = (*BASE, *(f"v{i}" for i in range(DIMS)))
    schema = arrow_schema(doc_id=pa.int64(), lang=pa.string(), source=pa.string(), **{c: pa.int64() for c in names})

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch.column("text")):
                s = statistics(data, off)
                v = vector(s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[lo:hi] for c in ("doc_id", "lang", "source")]
                    + [pa.array(s[c].astype(np.int64)) for c in BASE] + [pa.array(v[:, i]) for i in range(DIMS)],
                    schema=schema)

    return run


V = [f"v{i}" for i in range(DIMS)]
KEYS = ["level", "g1", "g2", "start"]


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its language and source, its language, and all."""
    return rows.withColumn("lv", F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang").alias("g1"), F.col("source").alias("g2")),
        F.struct(F.lit(1).alias("level"), F.col("lang").alias("g1"), F.lit(None).cast("string").alias("g2")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("g1"), F.lit(None).cast("string").alias("g2"))))) \
        .select("lv.*", *V, "n_same")


def _join(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys that may be null; ``groups`` has a row for each key, and Spark picks the way."""
    renamed = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(renamed, on).drop(*[f"_{k}" for k in keys])


def _estimates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, centre and inverse spread of each key over rows weighted by ``n_same``."""
    w = F.col("n_same")
    sums = [F.sum(w).alias("n"), *[F.sum(w * F.col(a)).alias(f"s_{a}") for a in V],
            *[F.sum(w * F.col(a) * F.col(b)).alias(f"q_{a}_{b}") for i, a in enumerate(V) for b in V[i:]]]
    return rows.groupBy(*keys).agg(*sums)


def _solve(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``centre``, ``inverse`` (row by row) and ``logdet`` of each key's sums, null where singular."""

    def run(batches):
        for batch in batches:
            t = batch.to_pydict()
            centre, inverse, logdet = [], [], []
            for i in range(batch.num_rows):
                n = t["n"][i]
                m = np.array([t[f"s_{a}"][i] for a in V]) / n
                q = np.zeros((DIMS, DIMS))
                for x, a in enumerate(V):
                    for y in range(x, DIMS):
                        q[x, y] = q[y, x] = t[f"q_{a}_{V[y]}"][i] / n - m[x] * m[y]
                # a column that the kept rows hardly vary in is held to a least spread
                q[np.diag_indices(DIMS)] += FLOOR
                sign, det = np.linalg.slogdet(q)
                good = n > 2 * DIMS and sign > 0
                centre.append(m.tolist())
                inverse.append(np.linalg.inv(q).ravel().tolist() if good else None)
                logdet.append(float(det) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keys] + [batch.column("n"), pa.array(centre, pa.list_(pa.float64())),
                                                  pa.array(inverse, pa.list_(pa.float64())), pa.array(logdet, pa.float64())],
                names=[*keys, "n", "centre", "inverse", "logdet"])

    kinds = {f.name: f.dataType.simpleString() for f in sums.schema.fields}
    return sums.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys)
                           + ", n long, centre array<double>, inverse array<double>, logdet double")


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to its joined ``centre`` and ``inverse``."""
    d = [F.col(a) - F.col("centre")[i] for i, a in enumerate(V)]
    total = F.lit(0.0)
    for i in range(DIMS):
        for j in range(i, DIMS):
            total = total + d[i] * d[j] * F.col("inverse")[i * DIMS + j] * (1.0 if i == j else 2.0)
    return total


def _bin(d: Column) -> Column:
    return F.floor(F.log(F.greatest(d, F.lit(1e-6))) * BINS).cast("long")


def _cut_bins(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The bin of ``d`` at which a key's rows reach ``share`` of its rows."""
    hist = rows.groupBy(*keys, _bin(F.col("d")).alias("bin")).agg(F.sum("n_same").alias("n"))
    total = hist.groupBy(*keys).agg(F.sum("n").alias("total"),
                                    F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    # the histogram of a key has as many rows as bins, whatever the number of texts
    at = F.aggregate("bins", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("bin")),
                     lambda acc, x: F.struct((acc["sum"] + x["n"]).alias("sum"),
                                             F.when(acc["sum"] < share * F.col("total"), x["bin"]).otherwise(acc["bin"]).alias("bin")))
    return total.select(*keys, at["bin"].alias("cut"))


def _initial(rows: DataFrame) -> DataFrame:
    """Two starts: kept rows by standardised deviations from medians, summed or at most."""
    keys = ["level", "g1", "g2"]
    mid = rows.groupBy(*keys).agg(*[F.percentile(a, 0.5, F.col("n_same")).alias(f"m_{a}") for a in V])
    near = _join(rows, mid, keys)
    dev = near.groupBy(*keys).agg(*[F.percentile(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5, F.col("n_same")).alias(f"d_{a}") for a in V])
    z = [F.pow((F.col(a) - F.col(f"m_{a}")) / (F.col(f"d_{a}") + 50.0), 2) for a in V]
    both = _join(near, dev, keys)
    return both.select(*keys, *V, "n_same", F.explode(F.array(
        F.struct(F.lit(0).alias("start"), sum(z[1:], z[0]).alias("d")),
        F.struct(F.lit(1).alias("start"), F.greatest(*z).alias("d")))).alias("s")) \
        .select(*keys, *V, "n_same", "s.*")


def _kept(rows: DataFrame, share: float) -> DataFrame:
    return _join(rows, _cut_bins(rows, KEYS, share), KEYS).where(_bin(F.col("d")) <= F.col("cut"))


def robust_estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """The MCD estimate ``level, g1, g2, rows, centre, inverse, scale`` of every group."""
    levels = saved(_levels(rows), "rules-levels")
    groups = levels.groupBy("level", "g1", "g2").agg(F.sum("n_same").alias("rows"))
    now = saved(_solve(_estimates(_kept(_initial(levels), 0.5), KEYS), KEYS), "rules-start")
    for step in range(steps):
        near = _join(levels, now.where("inverse IS NOT NULL").select(*KEYS, "centre", "inverse"), ["level", "g1", "g2"]) \
            .withColumn("d", _distance())
        now = saved(_solve(_estimates(_kept(near, share), KEYS), KEYS), f"rules-step-{step}")
    best = now.where("inverse IS NOT NULL").groupBy("level", "g1", "g2").agg(
        F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start")).alias("e"))
    best = best.select("level", "g1", "g2", "e.*")
    # distances are scaled so that their median is that of the chi-square law
    d = _join(levels, best, ["level", "g1", "g2"]).withColumn("d", _distance())
    mid = _cut_bins(d, ["level", "g1", "g2"], 0.5).withColumn("scale", F.exp((F.col("cut") + 0.5) / BINS) / MEDIAN)
    out = _join(best, mid.select("level", "g1", "g2", "scale"), ["level", "g1", "g2"])
    return saved(_join(out, groups, ["level", "g1", "g2"]), "rules-estimates")


def quality_rules(docs: DataFrame, cut: float = CUT, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``doc_id``, base statistics, ``base_failed``, ``distance`` and ``kept`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    kinds = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in (*BASE, *V))
    rows = saved(docs.mapInArrow(_measured(), kinds), "rules-rows")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    # equal vectors of a group (copies, above all) are one row with a count
    same = rows.where("NOT base_failed").groupBy("lang", "source", *V).agg(F.count("*").alias("n_same"))
    found = robust_estimates(same).where((F.col("rows") >= least_rows) | (F.col("level") == 2))
    out = rows
    for level, (a, b) in enumerate((("lang", "source"), ("lang", None), (None, None))):
        e = found.where(F.col("level") == level).select(
            F.col("g1").alias("_g1"), F.col("g2").alias("_g2"),
            F.struct("centre", "inverse", "scale", "rows").alias(f"e{level}"))
        on = [F.col(c).eqNullSafe(F.col(g)) if c else F.col(g).isNull() for c, g in ((a, "_g1"), (b, "_g2"))]
        out = out.join(e, on, "left").drop("_g1", "_g2")
    out = out.withColumn("e", F.coalesce("e0", "e1", F.when(F.col("e2.rows") >= 10 * DIMS, F.col("e2")))) \
        .withColumn("centre", F.col("e.centre")).withColumn("inverse", F.col("e.inverse"))
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance() / F.col("e.scale")))
    return out.select("doc_id", *BASE, "base_failed", "distance",
                      (~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))).alias("kept"))
