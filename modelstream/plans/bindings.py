"""The given tables read as a record stream, a model stream and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelstream.schemas import KIND_DOCUMENT, linear_params

DAY_MS = 86_400_000

TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The event times carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their type tag, epoch milliseconds and the number in their properties."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 5).cast("string").alias("data_type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event but a sign-up is a record with the inputs `value` and `k`."""
    return base(spark, sf_dir).filter("event_type <> 'signup'").select(
        F.col("event_id").alias("record_id"), "data_type", "ts", "value", "k"
    )


def inputs() -> list[Column]:
    return [F.col("value"), F.col("k")]


def signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).filter("event_type = 'signup'")


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sign-up is a linear model: intercept `value`, coefficient `k` / 100 for the first input."""
    return signups(spark, sf_dir).select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("name"),
        F.concat(F.lit("model of event "), F.col("event_id").cast("string")).alias("description"),
        "data_type",
        F.lit(KIND_DOCUMENT).alias("model_kind"),
        "ts",
        F.col("event_id").alias("seq"),
        linear_params(F.col("value"), [F.col("k") / 100.0]).alias("params"),
    )


_DOCUMENT = (
    '<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><RegressionModel functionName="regression">'
    '<RegressionTable intercept="%s"><NumericPredictor name="value" coefficient="%s"/></RegressionTable>'
    "</RegressionModel></PMML>"
)


def model_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same models as descriptors with document payloads. Every tenth value of `k` is broken, in one of three ways:
    an unknown kind, an empty payload, or a document cut short."""
    document = F.format_string(
        _DOCUMENT, F.col("value").cast("string"), (F.col("k") / 100.0).cast("string")
    )
    k = F.col("k").cast("int")
    return signups(spark, sf_dir).select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("name"),
        F.lit("linear document").alias("description"),
        "data_type",
        F.when(k % 30 == 0, F.lit(9)).otherwise(F.lit(KIND_DOCUMENT)).alias("model_kind"),
        F.when(k % 30 == 10, F.lit(""))
        .when(k % 30 == 20, F.substring(document, 1, 60))
        .otherwise(document)
        .cast("binary")
        .alias("model"),
        F.lit(None).cast("string").alias("location"),
        "ts",
        F.col("event_id").alias("seq"),
    )


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def line_features() -> list[Column]:
    return [F.col(c) for c in LINE_COLUMNS]


LINE_NAMES = ["quantity", "extended price", "discount", "tax"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
