"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import byte_bpe
from shoal.llm.alignment import align, aligned
from shoal.llm.common import table
from shoal.llm.conversations import damage, repair
from shoal.llm.fingerprints import fingerprints
from shoal.llm.grammar_files import read_ids, write_ids
from shoal.llm.mixing import mix
from shoal.llm.near_dedup import near_duplicates
from shoal.llm.packing import pack
from shoal.llm.quality import quality
from shoal.llm.quality_rules import quality_rules
from shoal.llm.sanitise import find_spans, report
from shoal.llm.token_trees import count_edits
from shoal.llm.toxicity import toxicity
from shoal.session import checkpoint_dir

#: Target weights of the sources: one slot each in 22, two for the largest, one for all others together.
WEIGHTS = {"src0": 2, **{f"src{i}": 1 for i in range(1, 20)}}


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words_in_shingle=4, similarity=0.8)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), carry=lambda ids: F.crc32(ids).alias("ids_crc32"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), WEIGHTS)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_spans(table(spark, sf_dir, "documents")))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of every document: a replacement after a third, a deletion at the middle, an insertion behind it."""
    n = F.length("text")
    at = [F.floor(n / 3), F.floor(n / 2), F.floor(2 * n / 3)]
    edits = F.array(*[F.struct(a.alias("start"), (a + size).alias("stop"), F.lit(new).alias("text"))
                      for a, size, new in zip(at, (12, 20, 0), (" edited 42 words", "", " new text, isn't it?\n"), strict=True)])
    docs = table(spark, sf_dir, "documents").withColumn("edits", edits)
    return count_edits(docs).drop("edited_text")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = posixpath.join(checkpoint_dir(spark), f"token-files-{uuid.uuid4().hex}")
    write_ids(table(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder, digest=True)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = aligned(table(spark, sf_dir, "documents"), carry=lambda groups: F.when(F.length(groups) > 0, F.sha2(groups, 256)).otherwise(""))
    return align(kept).withColumnRenamed("groups", "groups_sha256")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("data", 256).alias("decoded_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_toxicity, op3_packing, op4_fingerprints, op5_mixing, op6_quality, op7_quality_rules, op8_sanitise, op9_edit_counts,
    op10_token_files, op11_alignment, op12_byte_bpe, op13_conversations)}
