"""Text quality by positive-unlabelled learning.

Trusted good texts are the positives, other training texts without their labels the
unlabelled rows; the class prior is estimated from the labelled training rows.
A small network over shape statistics of a text (shares of symbols, capitals, digits
and marks, word lengths, repetition) minimises the non-negative unbiased risk.

Defined results: null and empty texts are scored as a text without words;
repeated rows are repeated; with no trusted positives every score is 0; extra
columns are not looked at.
"""

from __future__ import annotations

import io
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoal.llm.common import text_chunks
from shoal.llm.hashing import LOWER, Ranges, shingles, words
from shoal.llm.pu import fit_dense, score_dense
from shoal.llm.training import MOST_POSITIVE, MOST_UNLABELLED, fit, held_out, sample, scored

#: Classes of bytes whose shares are statistics.
CLASSES = [b"#*$%&<>@^~=_+\\/", b"|", b"!", b"?", b".", b",", b";:", b"0123456789",
           bytes(range(65, 91)), bytes(range(97, 123)), b"\n", b"\t ", b"()[]{}", b"'\"`-", bytes(range(128, 256))]
CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _c in enumerate(CLASSES):
    CLASS[list(_c)] = _i


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of shape statistics for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    k = len(CLASSES) + 1
    share = np.bincount(text * k + CLASS[data], minlength=n * k).reshape(n, k) / np.maximum(size, 1)[:, None]
    low = LOWER[data]
    start, end, first = words(low, offsets)
    count = np.diff(first)
    ranges = Ranges(low)
    h = ranges.hash(start, end)
    owner = np.repeat(np.arange(n), count)
    length = end - start
    mean = np.bincount(owner, weights=length, minlength=n) / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(np.bincount(owner, weights=length * length, minlength=n)
                                / np.maximum(count, 1) - mean * mean, 0))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    runs = np.bincount(owner[same], minlength=n) / np.maximum(count, 1)
    marked = np.bincount(owner[CLASS[data[end - 1]] == 0], minlength=n) / np.maximum(count, 1) if len(end) else runs
    repeats = []
    for w in (1, 3, 8):
        s, at = (h, first) if w == 1 else shingles(h, first, w)
        once = np.array([len(np.unique(s[at[i]:at[i + 1]])) for i in range(n)])
        repeats.append(1 - once / np.maximum(np.diff(at), 1))
    return np.column_stack([share, np.log1p(count), np.log1p(mean), np.log1p(spread), runs, marked, *repeats,
                            np.log1p(np.minimum(count, 40)), count == 0]).astype(float)


def _table(texts) -> np.ndarray:
    found = [statistics(data, off) for _, _, data, off in text_chunks(texts)]
    return np.concatenate(found) if found else np.zeros((0, 1))


def _learn(texts: pa.ChunkedArray, positive: np.ndarray, prior: float) -> bytes:
    if not positive.any() or positive.all() or prior <= 0:
        return b""
    x = _table(texts)
    # share-like columns are heavy-tailed: their square roots spread small values
    shift, scale = _standard(x)
    model = fit_dense((np.sqrt(np.maximum(x, 0)) - shift) / scale, positive, min(prior, 0.99))
    out = io.BytesIO()
    np.savez(out, shift=shift, scale=scale, a=model[0], c=model[1], w=model[2], b=model[3])
    return out.getvalue()


def _standard(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r = np.sqrt(np.maximum(x, 0))
    scale = r.std(axis=0)
    return r.mean(axis=0), np.where(scale > 1e-9, scale, 1.0)


class Scorer:
    def __init__(self, model: bytes):
        self.model = dict(np.load(io.BytesIO(model))) if model else None

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if self.model is None or not len(texts):
            return np.zeros(len(texts))
        m = self.model
        x = np.clip((np.sqrt(np.maximum(_table(texts), 0)) - m["shift"]) / m["scale"], -12, 12)
        return score_dense([m["a"], m["c"], m["w"], m["b"]], x)


def quality(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0,
            most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    held = partial(held_out, parts=parts, part=part)
    rows, prior = sample(docs, labels, "quality", held, most_positive, most_unlabelled)
    return scored(docs, Scorer(fit(rows, partial(_learn, prior=prior))), held)
