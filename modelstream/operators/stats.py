"""Serving statistics and the queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.functions import text
from modelstream.functions.remote import REMOTE_NAME
from modelstream.plans import chunks
from modelstream.schemas import KIND_DOCUMENT, LONG_MAX, LONG_MIN

VERSION = ["data_type", "name", "since"]

# Sums of durations are kept as decimals: exact to nine places, whatever the order of the rows.
EXACT = "decimal(28,9)"
TOTAL = "decimal(37,9)"


def total(duration: Column) -> Column:
    """The sum of durations that does not depend on the order or the parts they are added in.

    Each one is taken to nine decimal places first; one that is no finite number adds nothing.
    """
    return F.sum(duration.try_cast(EXACT))


def average(duration: Column, usage: Column) -> Column:
    """Mean duration; NaN when nothing was scored."""
    return F.when(usage == 0, F.lit(float("nan"))).otherwise(duration / F.nullif(usage, F.lit(0)))


def stats_by_model(served: DataFrame, duration: str = "duration") -> DataFrame:
    """Count, sum, minimum and maximum of the scoring durations of each model version.

    A version is (type, name, since): statistics start anew when a model is replaced. Partial aggregates are built before
    the shuffle, so a version that served most records is no hot key.
    """
    return (
        served.groupBy(*VERSION)
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("usage"),
            total(F.col(duration)).cast("double").alias("duration"),
            F.min(F.col(duration).cast("bigint")).alias("min"),
            F.max(F.col(duration).cast("bigint")).alias("max"),
        )
        .withColumn("average", average(F.col("duration"), F.col("usage")))
    )


def merge_stats(parts: DataFrame, *more: str) -> DataFrame:
    """Statistics of the same version (and the same values of `more` columns) from several shards or batches, added up."""
    return parts.groupBy(*more, *VERSION).agg(
        F.sum("usage").cast("bigint").alias("usage"),
        total(F.col("duration")).cast("double").alias("duration"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def running_stats(
    served: DataFrame, duration: str = "duration", tie: str = "record_id", limits: Limits = Limits()
) -> DataFrame:
    """The statistics of the version as they stood after each record, in the order of time and `tie`.

    A version with more rows than one task should sort is cut into chunks; each chunk starts from the totals before it.
    `served` is read several times: give a written result table rather than the query that computes it.
    """
    rows_in_all = served.count()
    rows = served
    if rows_in_all > limits.rows_per_chunk:
        rows = served.withColumn("__version", F.to_json(F.struct(*VERSION)))
        parts = chunks.chunked(rows, "__version", ["submission_ts", tie], limits, rows_in_all)
    else:
        parts = chunks.Chunked(chunks.assign(rows, None, "", []), None, "", [])
    took = F.col(duration)
    carry = chunks.carried(
        parts,
        {
            "__usage": F.count(F.lit(1)),
            "__duration": total(took),
            "__min": F.min(took.cast("bigint")),
            "__max": F.max(took.cast("bigint")),
        },
        {"__usage": F.sum, "__duration": F.sum, "__min": F.min, "__max": F.max},
    )
    types = {"__usage": "bigint", "__duration": TOTAL, "__min": "bigint", "__max": "bigint"}
    frame = (
        Window.partitionBy(*VERSION, chunks.CHUNK)
        .orderBy("submission_ts", tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return chunks.with_carried(parts, carry, types).select(
        *served.columns,
        (F.count(F.lit(1)).over(frame) + F.coalesce("__usage", F.lit(0))).cast("bigint").alias("run_usage"),
        (total(took).over(frame).cast(TOTAL) + F.coalesce(F.col("__duration").cast(TOTAL), F.lit(0).cast(TOTAL)))
        .cast("double")
        .alias("run_duration"),
        F.least(F.min(took.cast("bigint")).over(frame), F.col("__min")).alias("run_min"),
        F.greatest(F.max(took.cast("bigint")).over(frame), F.col("__max")).alias("run_max"),
    )


def processors(records: DataFrame, models: DataFrame) -> DataFrame:
    """The known types: every type that has had a record or a model."""
    return records.select("data_type").unionByName(models.select("data_type")).distinct()


def current_stats(models: DataFrame, stats: DataFrame) -> DataFrame:
    """Statistics of the models in force, one row per type; a model that has served nothing has empty statistics.

    `models` is the registry (one row per type), `stats` the statistics by version.
    """
    version = models.select(
        "data_type", "name", "description", F.col("model_kind").alias("model_type"), F.col("ts").alias("since")
    )
    return version.join(stats.select(*VERSION, "usage", "duration", "min", "max"), VERSION, "left").select(
        "data_type", "name", "description", "model_type", "since", *_defaults()
    )


def _defaults() -> list[Column]:
    return [
        F.coalesce("usage", F.lit(0)).cast("bigint").alias("usage"),
        F.coalesce("duration", F.lit(0.0)).alias("duration"),
        F.coalesce("min", F.lit(LONG_MAX)).alias("min"),
        F.coalesce("max", F.lit(LONG_MIN)).alias("max"),
    ]


def state_of(wanted: DataFrame, current: DataFrame) -> DataFrame:
    """A statistics row for every wanted type: the default row for a type nobody has heard of."""
    return wanted.select("data_type").join(current, "data_type", "left").select(
        "data_type",
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("model_type", F.lit(KIND_DOCUMENT)).alias("model_type"),
        F.coalesce("since", F.lit(0)).cast("bigint").alias("since"),
        *_defaults(),
    )


def remote_state(served: DataFrame, duration: str = "duration") -> DataFrame:
    """Statistics of the one model an external scorer serves, under its fixed name."""
    return served.agg(
        F.count(F.lit(1)).cast("bigint").alias("usage"),
        total(F.col(duration)).cast("double").alias("duration"),
        F.min(F.col(duration).cast("bigint")).alias("min"),
        F.max(F.col(duration).cast("bigint")).alias("max"),
    ).select(
        F.lit(REMOTE_NAME).alias("name"),
        F.lit(REMOTE_NAME).alias("description"),
        F.lit(KIND_DOCUMENT).alias("model_type"),
        F.lit(0).cast("bigint").alias("since"),
        *_defaults(),
    )


def report(current: DataFrame) -> DataFrame:
    """The statistics rows with ``average``, the name of the model kind and the report ``line`` of each."""
    mean = average(F.col("duration"), F.col("usage"))
    return current.select(
        *current.columns,
        mean.alias("average"),
        text.kind_name(F.col("model_type")).alias("kind"),
        text.report_line(
            F.col("name"), F.col("description"), F.col("since"), mean, F.col("min"), F.col("max")
        ).alias("line"),
    )
