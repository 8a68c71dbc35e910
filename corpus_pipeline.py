"""From raw documents to packed training sequences, stage by stage.

Every stage works on what its predecessor kept, which is written and read again in
between: toxic documents go, one document of each group of near-duplicates stays,
personal data is generalised in the texts, the documents are put in the order of the
mixing schedule, and their tokens are packed into windows that follow it.

In every stage null texts count as empty, columns beyond those of documents are carried
along, an empty table gives an empty result, and a text of any length is read whole.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm.common import saved, table
from shoal.llm.mixing import mixed, scheduled
from shoal.llm.near_dedup import dedup
from shoal.llm.packing import pack
from shoal.llm.queries import WEIGHTS
from shoal.llm.sanitise import sanitise
from shoal.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; empty texts and rows without doc_id are judged like any other."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates (five words, similarity 0.8).

    Texts without words and rows without doc_id are in no group and stay. Rows of one doc_id and text stay
    once, unlike texts of one doc_id are documents of their own.
    """
    return dedup(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms generalised; ``n_chars`` follows the text.

    No row goes; equal texts give equal texts.
    """
    return sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the schedule, in ranges of it.

    No row goes; sources without a weight, null ones too, share one stream. Repeated rows stay beside each other.
    """
    return mixed(docs, WEIGHTS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and place in it; sequences follow the schedule of the mixing stage.

    An empty text is its end id. Documents that no mixing stage has dealt (or that lost the note of it in a step
    that keeps no column metadata) are packed in no order, with a warning.
    """
    places = scheduled(docs)
    if places is None:
        warnings.warn("documents without a mixing schedule: sequences follow no target weights", stacklevel=2)
    return pack(docs, places=places)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the learned classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
