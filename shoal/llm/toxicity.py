"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any other training texts, taken without
their labels, are unlabelled. Features say which words, and which beginnings of
words, a text holds at least once, twice or three times; those much commoner among the positives are kept, and a
linear score over them is fitted to the non-negative risk under the class prior.

Defined results: null and empty texts get the score of a text without features;
repeated rows are repeated; with no labels of the class (or no documents) every
score is 0; extra columns are not looked at.
"""

from __future__ import annotations

import io
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoal.llm.common import text_chunks
from shoal.llm.hashing import LOWER, U, Ranges, mix, words
from shoal.llm.pu import fit_sparse, sigmoid
from shoal.llm.training import (MOST_POSITIVE, MOST_UNLABELLED, THRESHOLD, fit, held_out, sample,
                                scored)

#: Lengths in bytes of the beginnings of words that are features.
PREFIXES = (3, 4, 5, 6, 7, 8)
MOST_FEATURES = 4096
#: A feature for each: so often at least.
LEVELS = (1, 2, 3)
BINS = 20
#: Standard errors by which a feature must be commoner among positives, and least positives with it.
EXCESS, LEAST = 5.0, 3

#: Everything that is no ASCII letter or digit and no part of a longer character separates words here.
BREAK = np.ones(256, bool)
BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(data: np.ndarray, offsets: np.ndarray, only: np.ndarray | None = None):
    """``(text, feature, base)``, each once: a beginning's hash (``base``) and how often it is there.

    ``only``: a filter of bases by their top 16 bits.
    """
    low = LOWER[data]
    start, end, first = words(low, offsets, BREAK)
    ranges = Ranges(low)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    size = end - start
    found = []
    for n in (0, *PREFIXES):
        at = slice(None) if n == 0 else size >= n
        s = start[at]
        h = ranges.hash(s, end if n == 0 else s + n)
        h = mix(h + U(n)) if n == 0 else h
        t = text[at]
        if only is not None:
            hit = only[h >> U(48)]
            t, h = t[hit], h[hit]
        found.append((t, h))
    text, h = (np.concatenate(x) for x in zip(*found, strict=True))
    _, once, count = np.unique(mix(h + text.astype(np.uint64) * U(0x9E3779B97F4A7C15)),
                               return_index=True, return_counts=True)
    text, h = text[once], h[once]
    levels = [np.flatnonzero(count >= n) for n in LEVELS]
    return (np.concatenate([text[i] for i in levels]),
            np.concatenate([mix(h[i] + U(n)) for n, i in zip(LEVELS, levels, strict=True)]),
            np.concatenate([h[i] for i in levels]))


def _learn(texts: pa.ChunkedArray, positive: np.ndarray, prior: float) -> bytes:
    if not positive.any() or positive.all() or prior <= 0:
        return b""
    n_p, n_u = positive.sum(), (~positive).sum()
    counts = np.zeros((2, 1 << BINS), np.int64)
    for lo, _, data, off in text_chunks(texts):
        text, h, _ = features(data, off)
        counts[0] += np.bincount((h >> U(64 - BINS))[positive[lo + text]].astype(np.int64), minlength=1 << BINS)
        counts[1] += np.bincount((h >> U(64 - BINS))[~positive[lo + text]].astype(np.int64), minlength=1 << BINS)
    z = _excess(counts, n_p, n_u)
    chosen = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    chosen = np.sort(chosen[z[chosen] > EXCESS])
    if not len(chosen):
        return b""
    rows, found, bases = [], [], []
    for lo, _, data, off in text_chunks(texts):
        text, h, base = features(data, off)
        hit = np.isin((h >> U(64 - BINS)).astype(np.int64), chosen)
        rows.append(lo + text[hit])
        found.append(h[hit])
        bases.append(base[hit])
    row, h = np.concatenate(rows), np.concatenate(found)
    names, at, col = np.unique(h, return_index=True, return_inverse=True)
    base = np.concatenate(bases)[at]
    both = np.stack([np.bincount(col[positive[row]], minlength=len(names)),
                     np.bincount(col[~positive[row]], minlength=len(names))])
    keep = _excess(both, n_p, n_u) > EXCESS
    names, base = names[keep], base[keep]
    hit = keep[col]
    row, col = row[hit], (np.cumsum(keep) - 1)[col[hit]]
    w, b = fit_sparse(row, col, len(names), positive, prior)
    out = io.BytesIO()
    np.savez(out, names=names, base=base, w=w, b=np.array([b]))
    return out.getvalue()


def _excess(counts: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """How many standard errors commoner a feature is among positives; 0 where too rare."""
    rate = (counts[0] + counts[1] + 1) / (n_p + n_u + 2)
    z = (counts[0] / n_p - counts[1] / n_u) / np.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u))
    return np.where(counts[0] >= LEAST, z, 0)


class Scorer:
    """Scores of texts under a learned model; the features kept are looked up by hash."""

    def __init__(self, model: bytes):
        self.empty = not model
        if model:
            got = np.load(io.BytesIO(model))
            self.names, self.w, self.b = got["names"], got["w"], float(got["b"][0])
            self.only = np.zeros(1 << 16, bool)
            self.only[(got["base"] >> U(48)).astype(np.int64)] = True

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if self.empty:
            return np.zeros(len(texts))
        out = np.full(len(texts), self.b)
        for lo, _, data, off in text_chunks(texts):
            text, h, _ = features(data, off, self.only)
            at = np.minimum(np.searchsorted(self.names, h), len(self.names) - 1)
            hit = self.names[at] == h
            out[lo:lo + len(off) - 1] += np.bincount(text[hit], weights=self.w[at[hit]], minlength=len(off) - 1)
        return sigmoid(out)


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, part: int = 2,
             most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    held = partial(held_out, parts=parts, part=part)
    rows, prior = sample(docs, labels, "toxic", held, most_positive, most_unlabelled)
    model = fit(rows, partial(_learn, prior=prior))
    return scored(docs, Scorer(model), held)


def drop_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    held = partial(held_out, parts=how.pop("parts", 4), part=how.pop("part", 2))
    rows, prior = sample(docs, labels, "toxic", held, how.pop("most_positive", MOST_POSITIVE),
                         how.pop("most_unlabelled", MOST_UNLABELLED))
    score = Scorer(fit(rows, partial(_learn, prior=prior)))

    def run(batches):
        for batch in batches:
            clean = score(batch.column("text")) < THRESHOLD
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
