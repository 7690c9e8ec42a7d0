"""Batch and stream writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from modelstream.config import ServingConfig
from modelstream.functions.text import latency_ms, result_line


def result_lines(results: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Results as lines of text, the latency taken when the sink runs or from `now_ms`."""
    latency = latency_ms(F.col("submission_ts"), now_ms)
    line = result_line(latency, F.col("result"), F.col("name"), F.col("data_type"))
    return results.select(line.alias("value"))


def console(stream: DataFrame, mode: str = "update") -> DataStreamWriter:
    """Ten untruncated rows per batch on the console."""
    return (
        stream.writeStream.outputMode(mode).format("console").option("truncate", False).option("numRows", 10)
    )


def to_files(stream: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> DataStreamWriter:
    """Rows appended to files, each exactly once."""
    return (
        stream.writeStream.outputMode("append")
        .format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def messages(rows: DataFrame, value: Column, key: Column | None = None) -> DataFrame:
    """Rows as binary messages, with a null key when none is given."""
    key = F.lit(None) if key is None else key
    return rows.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"))


def publish(rows: DataFrame, target: str, config: ServingConfig | None = None) -> None:
    """Append messages to a topic (with `config`) or to a parquet folder."""
    if config is None:
        rows.write.mode("append").parquet(target)
    else:
        options = {"kafka.bootstrap.servers": config.brokers, "topic": target}
        rows.write.format("kafka").options(**options).save()


def discard(rows: DataFrame) -> None:
    """Run the query and keep nothing."""
    rows.write.format("noop").mode("overwrite").save()


def start(
    writer: DataStreamWriter, config: ServingConfig = ServingConfig(), trigger: str = "micro_batch"
) -> StreamingQuery:
    """Start a query: ``micro_batch`` at the configured interval, ``continuous`` for map-only queries over sources that
    support it, or ``available_now`` to process what is there and stop."""
    if trigger == "micro_batch":
        return writer.trigger(processingTime=config.trigger).start()
    if trigger == "continuous":
        return writer.trigger(continuous=config.continuous).start()
    if trigger == "available_now":
        return writer.trigger(availableNow=True).start()
    raise ValueError(f"unknown trigger {trigger!r}")
