"""Documents to packed training sequences: each stage's rows are written and read again by the next.

Every stage looks at whole texts, whatever their length, keeps repeated rows as rows of their own unless it removes copies, and
gives no rows for no rows. What it does with null and empty texts is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callmill.llm import decontam, line_chunks, line_quality, order_minhash, packing
from callmill.llm.common import prepare, removed, saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null and empty ones among them, and lines that too many documents of a host have go from the
    others."""
    prepare(spark)
    return line_quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Multi-line chunks that occur earlier go, and documents that consist of nothing else. Null and empty texts stay."""
    prepare(spark)
    return line_chunks.drop_repeated_chunks(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays; null and empty texts are one class."""
    prepare(spark)
    return order_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, and benchmark windows are cut from the others. Null and empty texts stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences; a null or empty text is one piece, its end."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# SQL has neither the stages' hashes nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
        if before is not None:
            removed(before)  # nothing reads it again
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
