"""Statistics kept current over a stream of results, and progress of the queries themselves."""

from __future__ import annotations

import json
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from modelstream.operators.stats import VERSION
from modelstream.schemas import fields
from modelstream.streaming.snapshots import BATCH, SnapshotTable


def running(served: DataFrame, duration: str = "duration") -> DataFrame:
    """Statistics per model version as a streaming aggregate, for ``update`` or ``complete`` mode."""
    return served.groupBy(*VERSION).agg(
        F.count(F.lit(1)).cast("bigint").alias("usage"),
        F.sum(F.col(duration).cast("double")).alias("duration"),
        F.min(F.col(duration).cast("bigint")).alias("min"),
        F.max(F.col(duration).cast("bigint")).alias("max"),
    )


LONG = T.LongType()
RUNNING = fields(
    data_type=T.StringType(), name=T.StringType(), since=LONG, usage=LONG, duration=T.DoubleType(), min=LONG, max=LONG
)


def newest(updates: DataFrame) -> DataFrame:
    """The statistics of each version as its last batch left them."""
    values = F.struct("usage", "duration", "min", "max", BATCH)
    return updates.groupBy(*VERSION).agg(F.max_by(values, BATCH).alias("s")).select(*VERSION, "s.*")


def write_running(
    served: DataFrame, path: str, checkpoint: str, duration: str = "duration", every: int = 16
) -> DataStreamWriter:
    """The job that writes, per batch, the statistics of the versions the batch touched, and a snapshot every `every` batches."""
    table = SnapshotTable(served.sparkSession, path, RUNNING, newest, every)

    return (
        running(served, duration)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: table.update(batch, batch_id))
        .option("checkpointLocation", checkpoint)
    )


def read_running(spark: SparkSession, path: str) -> DataFrame:
    """The newest statistics of each version of what `write_running` wrote: a snapshot and the few batches since."""
    return SnapshotTable(spark, path, RUNNING, newest).rows(spark).drop(BATCH)


class ProgressListener(StreamingQueryListener):
    """A row per source and batch of every query of the session it is added to.

    With a `path` the rows are appended to a table whenever `most` of them came together and when a query ends, so the driver
    never holds more; a table that cannot be written keeps the newest `most`, and `lost` counts the others. Without a path
    the newest `most` rows are kept.
    """

    SCHEMA = (
        "query string, batch_id bigint, at string, source string, start_offset string, end_offset string, "
        "input_rows bigint, rows_per_second double, durations string"
    )

    def __init__(self, spark: SparkSession | None = None, path: str | None = None, most: int = 1000) -> None:
        if path and spark is None:
            raise ValueError("a table needs a session to write with")
        self._spark, self._path, self.most, self.lost = spark, path, most, 0
        self._rows: deque[tuple] = deque()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        durations = json.dumps(dict(p.durationMs))
        rows = [
            (
                p.name or str(p.id),
                p.batchId,
                p.timestamp,
                s.description,
                s.startOffset,
                s.endOffset,
                s.numInputRows,
                float(s.processedRowsPerSecond),
                durations,
            )
            for s in p.sources
        ]
        with self._lock:
            self._rows.extend(rows)
            full = len(self._rows) >= self.most
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Append the rows held to the table of the listener, if it has one."""
        if self._path:
            try:
                self.drain(self._spark, self._path)
            except Exception:
                # The query goes on; what cannot be written stays until there are too many.
                pass
        with self._lock:
            while len(self._rows) > self.most:
                self._rows.popleft()
                self.lost += 1

    def progress(self, spark: SparkSession) -> DataFrame:
        """The rows held; `drain` also forgets them."""
        with self._lock:
            rows = list(self._rows)
        return spark.createDataFrame(rows, self.SCHEMA)

    def drain(self, spark: SparkSession, path: str) -> None:
        """Append the rows held to a table and forget them once they are written."""
        with self._lock:
            rows, self._rows = list(self._rows), deque()
        if not rows:
            return
        try:
            spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(path)
        except Exception:
            with self._lock:
                self._rows.extendleft(reversed(rows))
            raise
