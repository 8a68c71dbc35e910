"""Bounded training samples for the two classifiers, and scoring of whole tables.

Both classifiers see texts only. The sample holds at most ``MOST_POSITIVE`` rows of
the trusted class and ``MOST_UNLABELLED`` rows taken without their labels, each
chosen by the smallest hashes of doc_id among the rows that are not held out;
the class prior is the trusted class's share of the labelled training rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import arrow_schema

MOST_POSITIVE, MOST_UNLABELLED = 4000, 8000
THRESHOLD = 0.3


def held_out(doc_id: str | Column, parts: int, part: int) -> Column:
    """crc32 of the id's text leaves ``part`` when divided by ``parts``; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts == part, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, held: Callable[[str], Column],
           most_positive: int, most_unlabelled: int) -> tuple[DataFrame, float]:
    """``(text, positive)`` rows to train on, and the class prior."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")) \
        .where("id IS NOT NULL AND y IS NOT NULL").where(~held("id"))
    share = known.agg(F.avg("y")).first()[0]
    order = F.xxhash64("id")
    trusted = known.where("y = 1").select("id", order.alias("o")).orderBy("o", "id").limit(most_positive)
    open_ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL").where(~held("id"))
    free = open_ids.select("id", order.alias("o")).orderBy("o", "id").limit(most_unlabelled)
    ids = trusted.select("id", F.lit(True).alias("positive")) \
        .unionByName(free.select("id", F.lit(False).alias("positive"))).distinct()
    # at most most_positive + most_unlabelled rows of an id and a flag
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(ids), "id").select("id", "text", "positive")
    return rows, float(share or 0.0)


def fit(rows: DataFrame, learn: Callable[[pa.ChunkedArray, np.ndarray], bytes]) -> bytes:
    """The model that one task learns from the bounded sample, as bytes (empty: no rows to learn from)."""
    schema = arrow_schema(model=pa.binary())

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("positive", "ascending"), ("id", "ascending"), ("text", "ascending")])
        positive = np.array(group.column("positive").to_pylist(), bool)
        return pa.table({"model": [learn(group.column("text"), positive)]}, schema=schema)

    got = rows.groupBy(F.lit(0).alias("one")).applyInArrow(run, "model binary").collect()
    return bytes(got[0][0]) if got else b""


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], held: Callable[[str], Column]) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, null and empty texts included."""
    schema = arrow_schema(doc_id=pa.int64(), score=pa.float64())

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score(batch.column("text")), pa.float64())], schema=schema)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held("doc_id").alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
