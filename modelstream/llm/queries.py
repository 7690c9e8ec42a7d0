"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from modelstream.llm import (
    chat_tree,
    decontaminate,
    filter_audit,
    language,
    near_dedup,
    pii,
    quality_model,
    quality_rules,
    secrets_scan,
    sentencepiece_nbest,
    substring_dedup,
    warc,
    whitening,
)
from modelstream.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        return function

    return register


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_nbest.nbest_digest(table(spark, sf_dir, "documents"))


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).drop("key", "text_key")


@query("op4_quality_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_chat_tree")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_tree.chat_digest(turns.unionByName(extra))


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query("op7_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination_digest(found)


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(substring_dedup.without_repeats(table(spark, sf_dir, "documents")))


@query("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.secrets_digest(secrets_scan.scan_secrets(table(spark, sf_dir, "documents")))


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


@query("op11_filter_audit")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op11_filter_audit"] = filter_audit.ORACLE


@query("op12_warc")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op12_warc"] = warc.ORACLE


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
