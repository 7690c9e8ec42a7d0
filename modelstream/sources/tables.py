"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelstream.config import Limits, ServingConfig
from modelstream.functions.text import model_name, number, parse_doubles
from modelstream.plans.chunks import written
from modelstream.plans.sizes import lookup_join
from modelstream.schemas import WINE_FIELDS


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the parquet files that appear under `path`."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def kafka_options(config: ServingConfig, topic: str) -> dict[str, str]:
    """Reader options: everything from the start of the topic, going on when old offsets are gone."""
    return {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def stream_topic(spark: SparkSession, config: ServingConfig, topic: str) -> DataFrame:
    """A stream of message values of a topic, for sessions that carry the Kafka connector."""
    options = kafka_options(config, topic)
    return spark.readStream.format("kafka").options(**options).load().select("key", "value")


def read_delimited(
    spark: SparkSession,
    path: str,
    fields: list[str] | None = None,
    *,
    tag: str = "wine",
    separator: str = ";",
) -> DataFrame:
    """Records of a delimited text without a header: the first columns are the fields, the rest is ignored.

    Blanks around a value are trimmed and a value that is no number fails the query. Every row gets the type `tag`.
    """
    fields = WINE_FIELDS if fields is None else fields
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    rows = (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("header", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return rows.select(*[number(F.col(name)).alias(name) for name in fields], F.lit(tag).alias("data_type"))


def read_lines(spark: SparkSession, path: str, limits: Limits = Limits()) -> DataFrame:
    """The lines of text files as read one after the other: value, file, ``line`` (the number in its file), ``number`` (the number
    over all files by path) and ``from_end`` (the number counted from the last line); all begin with 1.

    Files are read in splits by many tasks. A first pass counts the lines of each split; sums over the counts give the number a
    split begins with, and a line adds its place inside the split. What meets in one place is a row per split.
    """
    rows = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.format_string("%019d %s", F.col("_metadata.file_block_start"), F.col("_metadata.file_path")).alias("__split"),
        # Counts the rows of a task, which reads one split after the other.
        F.monotonically_increasing_id().alias("__place"),
    )
    splits = written(
        rows.groupBy("file", "__split").agg(F.count(F.lit(1)).alias("__lines"), F.min("__place").alias("__first")), "splits"
    )
    earlier = Window.unboundedPreceding, -1
    files = splits.groupBy("file").agg(F.sum("__lines").alias("__lines"))
    files = files.select(
        "file",
        F.coalesce(F.sum("__lines").over(Window.orderBy("file").rowsBetween(*earlier)), F.lit(0)).alias("__files_before"),
        F.sum("__lines").over(Window.partitionBy()).alias("__all"),
    )
    # `__split` begins with the place in the file, so the splits of a file come in order.
    before = F.sum("__lines").over(Window.partitionBy("file").orderBy("__split").rowsBetween(*earlier))
    begins = splits.withColumn("__before", F.coalesce(before, F.lit(0))).join(files, "file")
    begins = written(begins.select("__split", "__first", "__before", "__files_before", "__all"), "split-begins")
    line = F.col("__before") + F.col("__place") - F.col("__first") + 1
    return lookup_join(rows, begins, "__split", spread=F.col("__place"), limits=limits).select(
        "value",
        "file",
        line.alias("line"),
        (F.col("__files_before") + line).alias("number"),
        (F.col("__all") - F.col("__files_before") - line + 1).alias("from_end"),
    )


def read_delimited_lines(
    spark: SparkSession,
    path: str,
    fields: list[str] | None = None,
    *,
    tag: str = "wine",
    separator: str = ";",
    numbered: bool = False,
) -> DataFrame:
    """As `read_delimited`, by splitting lines: a line with too few fields or a field that is no number fails.

    With `numbered`, the numbers of `read_lines` are kept.
    """
    fields = WINE_FIELDS if fields is None else fields
    values = parse_doubles(F.col("value"), len(fields), separator)
    lines = read_lines(spark, path) if numbered else spark.read.text(path)
    return lines.select(
        *[v.alias(name) for v, name in zip(values, fields)],
        F.lit(tag).alias("data_type"),
        *(["line", "number", "from_end"] if numbered else []),
    )


def replay_order(rows: DataFrame, line_number: str) -> DataFrame:
    """The rows last line first."""
    return rows.orderBy(F.col(line_number).desc())


def read_model_files(spark: SparkSession, path: str, suffix: str = "pmml") -> DataFrame:
    """The model documents directly in a folder: name without suffix, whole payload, path and modification time."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(path)
        .select(
            model_name(F.col("path"), suffix).alias("name"),
            F.col("content").alias("model"),
            "path",
            F.unix_millis("modificationTime").alias("ts"),
        )
    )
