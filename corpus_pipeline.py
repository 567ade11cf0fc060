"""From raw documents to token ids: classify, drop shared lines, near-duplicates and benchmark copies, encode.

Each stage takes the documents that its predecessor kept and returns documents with the columns of the
input; the last returns token ids. A stage's result is written as Parquet to the shared folder and read
again, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
import public_tokenizers

from mdlake.llm import bpe, decontaminate, line_dedup, quality_model, simhash
from mdlake.llm.common import joined_sha256, table
from mdlake.session import scratch_path

RANKS = "byte_bpe_50k.tiktoken"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts; it learns from the labels of these documents.

    Rows are judged one by one, null and empty texts too; repeated rows get the same verdict. Without labels all get
    the same score.
    """
    judged = quality_model.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where(F.col("predicted") == 1).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document has; texts and their lengths change, no document goes."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group, and documents without an id.

    Near-duplicates are linked by SimHash fingerprints of four-word shingles that differ in at most four bits. Null and
    empty texts are one group. An id whose rows have different texts stays if it is the smallest of any of their
    groups; its rows go or stay together.
    """
    found = simhash.near_duplicates(docs)
    stays = F.bool_or(F.col("doc_id") == F.col("component_id"))
    gone = found.groupBy("doc_id").agg(stays.alias("stays")).where(~F.col("stays")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no passage of the benchmark; without an id, the text's hash tells them apart.

    An id is one document: if one of its texts holds a passage, all its rows go. Null and empty texts hold none.
    """
    key = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    judged = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = judged.where("contaminated").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, key == F.col("_gone"), "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes that they decode to."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        joined_sha256(F.col("ids"), " ").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", encode),
]

# Trees and token ids have no SQL counterpart; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
