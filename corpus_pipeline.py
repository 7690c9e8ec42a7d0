"""A corpus pipeline over `documents`: quality rules, near-duplicates, decontamination, secrets, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelstream.llm import decontaminate, near_dedup, quality_rules, secrets_scan, sentencepiece_nbest
from modelstream.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, one of repeated rows."""
    return near_dedup.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets masked; n_chars is that of the new text."""
    masked = secrets_scan.mask_secrets(docs)
    count = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return masked.withColumn("n_chars", count)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the best segmentation and the scores of the N best."""
    found = sentencepiece_nbest.encode_nbest(docs)
    return found.select(
        "doc_id", F.col("segmentations")[0]["ids"].alias("ids"), F.transform("segmentations", lambda s: s["score"]).alias("scores")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("secrets", secrets),
    ("sentencepiece", encoding),
]

# Hashes of shingles, entropy-like tests and segmentations are beyond SQL; tests/llm hold it against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
