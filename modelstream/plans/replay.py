"""The streaming queries: the events replayed in time order through the streaming jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from modelstream.config import ServingConfig, work_folder
from modelstream.operators import registry as reg
from modelstream.operators import stats, wire
from modelstream.plans import bindings as b
from modelstream.plans.catalog import model_messages, query, record_messages, wanted_types
from modelstream.schemas import ddl, fields
from modelstream.sources import sinks, tables
from modelstream.streaming import batches, keyed, statistics

SLICES = 3
LONG, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()
VECTOR = T.ArrayType(DOUBLE)
RECORDS = fields(record_id=LONG, data_type=STRING, ts=LONG, features=VECTOR, duration=DOUBLE)
LINEAR = fields(form=STRING, intercept=DOUBLE, coefs=VECTOR)
MODELS = fields(
    name=STRING,
    description=STRING,
    data_type=STRING,
    model_kind=T.IntegerType(),
    ts=LONG,
    seq=LONG,
    params=LINEAR,
)
MESSAGES = fields(event_id=LONG, value=T.BinaryType())
RESULTS = fields(record_id=LONG, name=STRING, data_type=STRING, submission_ts=LONG, result=DOUBLE, since=LONG)
SERVED = fields(
    record_id=LONG, duration=DOUBLE, name=STRING, data_type=STRING, submission_ts=LONG, result=DOUBLE, since=LONG
)


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """The settings of a stateful query while it starts and runs: RocksDB, and the state partitions of the deployment, which a
    checkpoint keeps for ever. The session's own settings come back afterwards."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # Changes of the state can be read back, and a batch uploads what changed rather than whole files.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(ServingConfig().state_partitions),
        # The rows that pass through Python are blocks of some thousand records: a worker holds this many at a time.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def finish(writer: DataStreamWriter) -> None:
    """Process what has arrived, then stop."""
    sinks.start(writer, trigger="available_now").awaitTermination()


def slices(spark: SparkSession, sf: str) -> list[tuple[int, int]]:
    """Consecutive time ranges that hold about the same number of events; together they hold all of them."""
    cuts = [i / SLICES for i in range(1, SLICES)]
    points = b.base(spark, sf).agg(F.percentile_approx("ts", cuts)).first()[0]
    edges = [-(2**62), *points, 2**62]
    return list(zip(edges, edges[1:]))


def during(rows: DataFrame, part: tuple[int, int]) -> DataFrame:
    return rows.filter((F.col("ts") >= part[0]) & (F.col("ts") < part[1]))


def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    return b.records(spark, sf).select(
        "record_id", "data_type", "ts", F.array("value", "k").alias("features"), F.col("k").alias("duration")
    )


class Replay:
    """Two folders that files arrive in, and the folders of one job over them."""

    def __init__(self, spark: SparkSession, sf: str, name: str) -> None:
        self.spark, self.sf = spark, sf
        root = work_folder(spark, name)
        self.records, self.models = f"{root}/records", f"{root}/models"
        self.out, self.checkpoint = f"{root}/out", f"{root}/checkpoint"
        self.registry, self.other = f"{root}/registry", f"{root}/other"
        # Sources need their folders; an empty file has no effect.
        spark.createDataFrame([], RECORDS).write.parquet(self.records)
        spark.createDataFrame([], MODELS).write.parquet(self.models)

    def arrive(self, part: tuple[int, int] | None = None, records: bool = True, models: bool = True) -> None:
        for wanted, rows, target in (
            (models, b.models(self.spark, self.sf), self.models),
            (records, stream_records(self.spark, self.sf), self.records),
        ):
            if wanted:
                (rows if part is None else during(rows, part)).write.mode("append").parquet(target)

    def record_stream(self) -> DataFrame:
        return tables.stream_files(self.spark, self.records, RECORDS)

    def model_stream(self) -> DataFrame:
        return tables.stream_files(self.spark, self.models, MODELS)

    def keyed(self, processor: bool = False) -> DataStreamWriter:
        rows = keyed.stream_rows(self.record_stream(), self.model_stream())
        met = keyed.meet_models_with_stats(rows) if processor else keyed.meet_models(rows)
        served = keyed.score_met(met, 2, forms=["linear"], params_type=ddl(LINEAR))
        return sinks.to_files(served, self.out, self.checkpoint)

    def served(self) -> DataFrame:
        return self.spark.read.schema(SERVED).parquet(self.out)


def _results(served: DataFrame) -> DataFrame:
    return served.select("record_id", "name", "data_type", "submission_ts", F.round("result", 6).alias("result"))


def _run_keyed(spark: SparkSession, sf: str, name: str, processor: bool = False) -> Replay:
    replay = Replay(spark, sf, name)
    with state_settings(spark):
        for part in slices(spark, sf):
            replay.arrive(part)
            finish(replay.keyed(processor))
    return replay


@query
def stream_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed state, slice after slice; the query is stopped and resumed from its checkpoint between slices."""
    return _results(_run_keyed(spark, sf, "stream-keyed").served())


@query
def stream_recover(spark: SparkSession, sf: str) -> DataFrame:
    """A run that ends after the first slice, and a later one from the same checkpoint over the rest at once."""
    replay = Replay(spark, sf, "stream-recover")
    first, *rest = slices(spark, sf)
    with state_settings(spark):
        replay.arrive(first)
        finish(replay.keyed())
        for part in rest:
            replay.arrive(part)
        finish(replay.keyed())
    return _results(replay.served())


@query
def state_reader(spark: SparkSession, sf: str) -> DataFrame:
    """The models in force, read from the state of the keyed job."""
    replay = _run_keyed(spark, sf, "state-reader")
    held = keyed.read_models(spark, replay.checkpoint)
    params = F.from_json("params", ddl(LINEAR))
    return held.select(
        "data_type",
        "name",
        "since",
        F.round(params.getField("intercept"), 6).alias("intercept"),
        F.round(F.get(params.getField("coefs"), 0), 6).alias("coef"),
    )


@query
def stream_state_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Two value states per key: the statistics of the models in force, read from the state."""
    replay = _run_keyed(spark, sf, "stream-state-stats", processor=True)
    current = keyed.read_stats(spark, replay.checkpoint)
    return current.filter("usage > 0").select("data_type", "name", "since", "usage", "duration", "min", "max")


@query
def stream_state_history(spark: SparkSession, sf: str) -> DataFrame:
    """Model in force and statistics after each batch, from the changes of the state; a batch is a third of the time."""
    first, last = b.base(spark, sf).agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) // SLICES + 1
    replay = Replay(spark, sf, "stream-state-history")
    with state_settings(spark):
        for i in range(SLICES):
            replay.arrive((first + i * step, first + (i + 1) * step))
            finish(replay.keyed(processor=True))
        history = keyed.read_history(spark, replay.checkpoint)
    return history.filter("usage > 0").select("batch_id", "data_type", "name", "since", "usage", "duration", "min", "max")


@query
def stream_state_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The state query over the state of the keyed job: known types and unknown ones."""
    replay = _run_keyed(spark, sf, "stream-state-lookup", processor=True)
    current = stats.current_stats(
        reg.latest_models(b.models(spark, sf)), keyed.read_stats(spark, replay.checkpoint)
    )
    return stats.state_of(wanted_types(spark, sf), current)


@query
def stream_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Batch operators per micro-batch over one stream of records and models."""
    replay = Replay(spark, sf, "stream-arrivals")
    registry = batches.Registry(spark, replay.registry, MODELS)
    records = replay.record_stream().select(F.struct("*").alias("record"), F.lit(None).alias("model"))
    models = replay.model_stream().select(F.lit(None).alias("record"), F.struct("*").alias("model"))

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (
            batch.filter("record IS NOT NULL").select("record.*"),
            batch.filter("model IS NOT NULL").select("model.*"),
        )

    for part in slices(spark, sf):
        replay.arrive(part)
        finish(
            batches.serve_arrivals(
                records.unionByName(models),
                split,
                registry,
                lambda: [F.get("features", i) for i in range(2)],
                replay.out,
                replay.checkpoint,
                keep=["record_id", "duration"],
                forms=["linear"],
            )
        )
    return _results(batches.read_results(spark, replay.out, SERVED))


@query
def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way: encoded messages on two streams, decoded, documents built, served per micro-batch."""
    root = work_folder(spark, "stream-messages")
    registry = batches.Registry(spark, f"{root}/registry", MODELS)
    sources = {"records": record_messages(spark, sf), "models": model_messages(spark, sf)}
    times = b.base(spark, sf).select("event_id", "ts")
    streams = {}
    for side, messages in sources.items():
        spark.createDataFrame([], MESSAGES).write.parquet(f"{root}/{side}")
        streams[side] = tables.stream_files(spark, f"{root}/{side}", MESSAGES)

    def split(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        records, models = wire.split_envelopes(batch)
        built = reg.build_models(models, ["value", "k"])
        narrow = F.when(F.col("params").isNotNull(), F.struct("params.form", "params.intercept", "params.coefs"))
        return records, built.withColumn("params", narrow)

    for part in slices(spark, sf):
        for side, messages in sources.items():
            now = during(times, part).select("event_id")
            messages.join(now, "event_id").select("event_id", "value").write.mode("append").parquet(f"{root}/{side}")
        finish(
            batches.serve_arrivals(
                wire.envelopes(streams["records"], streams["models"], arrival="event_id"),
                split,
                registry,
                lambda: [F.get("features", i) for i in range(2)],
                f"{root}/out",
                f"{root}/checkpoint",
                keep=["record_id"],
                forms=["linear"],
            )
        )
    return _results(batches.read_results(spark, f"{root}/out", RESULTS))


@query
def stream_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """The registry is brought up to date from the model stream, then the records are served from its snapshot."""
    replay = Replay(spark, sf, "stream-broadcast")
    registry = batches.Registry(spark, replay.registry, MODELS)
    for part in slices(spark, sf):
        replay.arrive(part)
        finish(batches.update_registry(replay.model_stream(), registry, replay.other))
    finish(
        batches.serve_snapshot(
            replay.record_stream(),
            registry,
            lambda: [F.get("features", i) for i in range(2)],
            replay.out,
            replay.checkpoint,
            keep=["record_id", "duration"],
            forms=["linear"],
        )
    )
    return _results(batches.read_results(spark, replay.out, SERVED))


@query
def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics kept current over the results of the keyed job."""
    replay = _run_keyed(spark, sf, "stream-stats")
    served = tables.stream_files(spark, replay.out, SERVED)
    with state_settings(spark):
        finish(statistics.write_running(served, f"{replay.other}/stats", f"{replay.other}/checkpoint"))
    return statistics.read_running(spark, f"{replay.other}/stats")
