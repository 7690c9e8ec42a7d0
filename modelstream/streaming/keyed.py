"""Serving with keyed state: the model in force of each type lives in the state store.

Records and models of a type meet in one stateful operator. The key is (type, shard): the models of a type go to all its
shards, each record to one, so a type with most of the traffic is served by many tasks and every shard still sees every
model. The operator only decides which model is in force for each record; scoring is a column expression after it, in
the JVM. State is declared columns, the parameters as JSON text. Its memory does not grow with the records of a key.

Rows reach the operator and leave it as Arrow blocks, so a model that goes to all shards is encoded once, and neither the shuffle
nor Python handles records and models one by one.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from modelstream.config import ship_package
from modelstream.operators.serve import Policy, in_force, route
from modelstream.operators.stats import merge_stats
from modelstream.schemas import PARAMS

STREAM_ROW = "data_type string, shard int, is_record boolean, block binary"
STATE = "name string, since bigint, params string"
MET = (
    "record_id bigint, data_type string, ts bigint, features array<double>, duration double, name string, since bigint, "
    "params string"
)
STATS_STATE = "name string, since bigint, usage bigint, duration double, min bigint, max bigint"

Model = tuple[Any, ...]

# What a block of records, of models or of results holds.
PENDING = pa.schema(
    [("seq", pa.int64()), ("data_type", pa.string()), ("ts", pa.int64()), ("features", pa.list_(pa.float64())), ("duration", pa.float64())]
)
UPDATES = pa.schema([("ts", pa.int64()), ("seq", pa.int64()), ("name", pa.string()), ("params", pa.string())])
ANSWERS = pa.schema(
    [("record_id", pa.int64()), ("data_type", pa.string()), ("ts", pa.int64()), ("features", pa.list_(pa.float64()))]
    + [("duration", pa.float64()), ("name", pa.string()), ("since", pa.int64()), ("params", pa.string())]
)
# Rows and bytes that a task gathers before it deals them to their keys, and rows of a block at most.
GATHERED_ROWS, GATHERED_BYTES, BLOCK_ROWS = 1 << 16, 16 << 20, 4096


def last_of_each_time(updates: pa.Table) -> pa.Table:
    """Models in the order of (ts, seq), of each time the last one: the others are never in force."""
    ts, seq = updates["ts"].to_numpy(), updates["seq"].to_numpy()
    order = np.lexsort((seq, ts))
    ts = ts[order]
    return updates.take(pa.array(order[np.append(ts[1:] != ts[:-1], True)[: len(ts)]])).combine_chunks()


def gathered(source: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in tables of some size."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in source:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= GATHERED_ROWS or size >= GATHERED_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def dealt(source: Iterator[pa.RecordBatch], is_record: bool) -> Iterator[pa.RecordBatch]:
    """Rows of (data_type, shard, what a block holds) to a row per type, shard and block."""
    schema = PENDING if is_record else UPDATES
    for table in gathered(source):
        kinds = table["data_type"].combine_chunks().dictionary_encode()
        shard = table["shard"].to_numpy().astype(np.int64)
        code = kinds.indices.to_numpy().astype(np.int64) * (int(shard.max()) + 1) + shard
        order = np.argsort(code, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(code[order]) != 0)).tolist() + [len(order)]
        rows = table.select(schema.names).cast(schema).take(pa.array(order))
        types, shards, blocks = [], [], []
        for low, high in zip(cuts, cuts[1:]):
            one = rows.slice(low, high - low)
            for batch in (one if is_record else last_of_each_time(one)).to_batches(BLOCK_ROWS):
                types.append(kinds.dictionary[kinds.indices[int(order[low])].as_py()])
                shards.append(int(shard[order[low]]))
                blocks.append(batch.serialize())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([t.as_py() for t in types], pa.string()),
                pa.array(shards, pa.int32()),
                pa.array([is_record] * len(blocks), pa.bool_()),
                pa.array([b.to_pybytes() for b in blocks], pa.binary()),
            ],
            ["data_type", "shard", "is_record", "block"],
        )


def _deal_records(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return dealt(source, True)


def _deal_models(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return dealt(source, False)


def _opened(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of results to their rows."""
    for batch in source:
        for block in batch.column(0):
            yield pa.ipc.read_record_batch(block.as_buffer(), ANSWERS)


def stream_rows(records: DataFrame, models: DataFrame, policy: Policy = Policy(), shards: int = 8) -> DataFrame:
    """Records (record_id, data_type, ts, features, optionally duration) and built models as one stream of blocks.

    Models without a type are left out: no record can meet them. So are records without one, unless bad input is marked:
    then they go by the empty type, for which no state is ever kept.
    """
    took = F.col("duration") if "duration" in records.columns else F.lit(0.0)
    ship_package(records.sparkSession)
    left = (
        in_force(models, policy)
        .filter(F.length("data_type") > 0)
        .select("data_type", F.lit(0).alias("shard"), "ts", "seq", "name", F.to_json("params").alias("params"))
        .mapInArrow(_deal_models, STREAM_ROW)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    right = records.select(
        F.coalesce("data_type", F.lit("")).alias("data_type"),
        F.pmod(F.xxhash64("record_id"), F.lit(shards)).cast("int").alias("shard"),
        "ts",
        F.col("record_id").alias("seq"),
        "features",
        took.cast("double").alias("duration"),
    )
    if policy.bad_input == "drop":
        right = right.filter(F.length("data_type") > 0)
    return left.unionByName(right.mapInArrow(_deal_records, STREAM_ROW))


# Bytes of records that a task holds in memory for a key and batch; what comes beyond goes to a scratch file of the task.
HELD_BYTES = 32 << 20


class Pending:
    """The records of one key and batch, kept until all its models are known.

    A record may meet a model that comes after it in the input, so nothing can be answered before the input has ended. Records
    are held as Arrow batches, in memory up to `limit` bytes and then in an unnamed file that only this task sees and that
    vanishes with it, like Spark's own spills; they are given back a batch at a time.
    """

    def __init__(self, limit: int = HELD_BYTES) -> None:
        self.limit, self.bytes, self.held, self.file, self.writer = limit, 0, [], None, None

    def add(self, batch: pa.RecordBatch) -> None:
        if self.writer is None and self.bytes + batch.nbytes <= self.limit:
            self.bytes += batch.nbytes
            self.held.append(batch)
            return
        if self.writer is None:
            self.file = tempfile.TemporaryFile()
            self.writer = pa.ipc.new_stream(self.file, PENDING)
        self.writer.write_batch(batch)

    def batches(self) -> Iterator[pa.RecordBatch]:
        while self.held:
            yield self.held.pop(0)
        if self.writer is not None:
            self.writer.close()
            self.file.seek(0)
            yield from pa.ipc.open_stream(self.file)
            self.file.close()


def sides(rows: pd.DataFrame) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Whether records or models, and a batch of them: of rows with blocks, or of plain rows with all columns."""
    if "block" in rows:
        for is_record, block in zip(rows["is_record"], rows["block"]):
            yield bool(is_record), pa.ipc.read_record_batch(pa.py_buffer(block), PENDING if is_record else UPDATES)
        return
    mine = rows["is_record"].to_numpy(dtype=bool)
    for is_record, part, schema in ((True, rows[mine], PENDING), (False, rows[~mine], UPDATES)):
        if len(part):
            yield is_record, pa.RecordBatch.from_pandas(part[schema.names], schema=schema, preserve_index=False)


class Meeting:
    """What one key's rows of a batch come to: the models (name, since, params) in their order, the `current` one or nulls first,
    and the position of the one in force for each record.

    Of the models of the batch one for each time is held, as Arrow columns; records only as far as `Pending` holds them.
    """

    def __init__(self, batches: Iterator[pd.DataFrame], current: Model | None, order: str, limit: int = HELD_BYTES) -> None:
        self.order, self.pending = order, Pending(limit)
        updates, held, kept = [], 0, 0
        for rows in batches:
            for is_record, batch in sides(rows):
                if is_record:
                    self.pending.add(batch)
                    continue
                updates.append(batch)
                held += batch.num_rows
                if held > 2 * kept + GATHERED_ROWS:
                    updates = last_of_each_time(pa.Table.from_batches(updates, UPDATES)).to_batches()
                    held = kept = sum(b.num_rows for b in updates)
        found = last_of_each_time(pa.Table.from_batches(updates, UPDATES))
        self.since = found["ts"].to_numpy()
        first = [[None if current is None else current[i]] for i in range(3)]
        kinds = {"name": pa.string(), "since": pa.int64(), "params": pa.string()}
        columns = zip(first, (found["name"], found["ts"], found["params"]), kinds.values())
        self.models = {
            name: pa.concat_arrays([pa.array(one, kind), *more.chunks]) for name, (one, more, kind) in zip(kinds, columns)
        }

    @property
    def last(self) -> int:
        """The position of the last model; 0 is the one that was in force before."""
        return len(self.since)

    @property
    def newest(self) -> Model | None:
        """The model in force after the batch."""
        name, since, params = (column[self.last].as_py() for column in self.models.values())
        return None if since is None else (name, since, params)

    def met(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Records and the positions of their models, a batch at a time: models apply from their time on, those of the same
        time before the record, or all of the batch with ``models_first``."""
        for records in self.pending.batches():
            if self.order == "models_first":
                yield records, np.full(records.num_rows, self.last)
            else:
                yield records, np.searchsorted(self.since, records["ts"].to_numpy(zero_copy_only=False), side="right")


def answers(records: pa.RecordBatch, version: np.ndarray, models: dict[str, pa.Array]) -> pa.RecordBatch:
    """The records with their models."""
    found = [pc.take(column, pa.array(version)) for column in models.values()]
    return pa.RecordBatch.from_arrays([*records.columns, *found], schema=ANSWERS)


def _output(records: pa.RecordBatch, version: np.ndarray, models: dict[str, pa.Array]) -> pd.DataFrame:
    """`answers` as plain rows."""
    return answers(records, version, models).to_pandas()


def _block(batch: pa.RecordBatch) -> pd.DataFrame:
    return pd.DataFrame({"block": [batch.serialize().to_pybytes()]})


def meet_models(stream: DataFrame, order: str = "event_time") -> DataFrame:
    """`stream_rows` to records with the model in force, by arbitrary state without timeout.

    Rows of a batch meet in the order of time, a model before a record of the same time, or with
    ``order="models_first"`` all models of the batch before its records. A task holds the models of a key's batch and
    `HELD_BYTES` of its records, however many there are. A model that arrives in a later batch than a
    record applies from its arrival on.
    """

    ship_package(stream.sparkSession)

    def serve(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        meeting = Meeting(batches, state.get if state.exists else None, order)
        if meeting.last:
            state.update(meeting.newest)
        for records, version in meeting.met():
            yield _block(answers(records, version, meeting.models))

    met = stream.groupBy("data_type", "shard").applyInPandasWithState(
        serve, "block binary", STATE, "append", GroupStateTimeout.NoTimeout
    )
    return met.mapInArrow(_opened, MET)


class ServingProcessor(StatefulProcessor):
    """Two value states per key: the model in force and its running statistics, which start anew on a swap."""

    def __init__(self, order: str = "event_time") -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.model = handle.getValueState("model", STATE)
        self.stats = handle.getValueState("stats", STATS_STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        current = tuple(self.model.get()) if self.model.exists() else None
        meeting = Meeting(rows, current, self.order)
        last, newest = meeting.last, meeting.newest
        if last > 0:
            self.model.update(newest)
        old = self.stats.get() if last == 0 and self.stats.exists() else None
        usage, total, low, high = (old[2], old[3], old[4], old[5]) if old else (0, 0.0, None, None)
        for records, version in meeting.met():
            # Of the batch, what the model served that is in force at its end.
            mine = records["duration"].to_numpy(zero_copy_only=False)[version == last]
            if len(mine):
                usage, total = usage + len(mine), total + float(mine.sum())
                low = int(mine.min()) if low is None else min(low, int(mine.min()))
                high = int(mine.max()) if high is None else max(high, int(mine.max()))
            yield _block(answers(records, version, meeting.models))
        if newest is not None and (last > 0 or usage):
            self.stats.update((newest[0], newest[1], usage, total, low, high))

    def close(self) -> None:
        pass


def meet_models_with_stats(stream: DataFrame, order: str = "event_time") -> DataFrame:
    """As `meet_models`, with the statistics of the current model kept beside it. Needs the RocksDB state store."""
    ship_package(stream.sparkSession)
    met = stream.groupBy("data_type", "shard").transformWithStateInPandas(
        ServingProcessor(order), "block binary", "Append", "None"
    )
    return met.mapInArrow(_opened, MET)


def score_met(
    met: DataFrame, width: int, policy: Policy = Policy(), forms: list[str] | None = None, params_type: str = PARAMS
) -> DataFrame:
    """Results of the records that `meet_models` gave a model, with record_id, since and duration kept."""
    model = F.when(
        F.col("name").isNotNull(),
        F.struct("name", F.col("since").alias("ts"), F.from_json("params", params_type).alias("params")),
    )
    inputs = [F.get("features", F.lit(i)) for i in range(width)]
    rows = met.select("record_id", "data_type", "ts", "features", "duration", model.alias("model"))
    return route(rows, inputs, policy, ["record_id", "duration"], forms)


# --- reading the state --------------------------------------------------------------------------------------------


def read_models(spark: SparkSession, checkpoint: str, processor: bool = False) -> DataFrame:
    """The model in force of each type from the state of a stopped or running query.

    `processor` says that the query was built with `meet_models_with_stats`. All shards of a type hold the same model.
    """
    reader = spark.read.format("statestore")
    if processor:
        rows = reader.option("stateVarName", "model").load(checkpoint).select("key.data_type", "value.*")
    else:
        rows = reader.load(checkpoint).select("key.data_type", "value.groupState.*")
    held = F.struct("since", "name", "params")
    return rows.groupBy("data_type").agg(F.max(held).alias("m")).select("data_type", "m.name", "m.since", "m.params")


def read_stats(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Statistics of the models in force from the state of a `meet_models_with_stats` query, the shards added up.

    `batch` asks for the state as it stood after that batch, as far back as the checkpoint keeps it.
    """
    reader = spark.read.format("statestore").option("stateVarName", "stats")
    if batch is not None:
        reader = reader.option("batchId", batch)
    return merge_stats(reader.load(checkpoint).select("key.data_type", "value.*"))


def read_history(spark: SparkSession, checkpoint: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Model in force and statistics of each type after each batch (batch_id first), from the changes of the state of a
    `meet_models_with_stats` query.

    Batches `first` to `last` (by default the last one committed) are read; `first` must be the query's first batch, or the
    types that were silent since are missing. A key that did not change in a batch keeps its value from before. Needs the
    changelog of the RocksDB state store.
    """
    reader = spark.read.format("statestore").option("stateVarName", "stats").option("readChangeFeed", True)
    reader = reader.option("changeStartBatchId", first)
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    changes = reader.load(checkpoint).filter("change_type = 'update'")
    changes = changes.select("batch_id", "key.data_type", "key.shard", "value.*")
    if last is None:
        last = changes.agg(F.max("batch_id")).first()[0]
    if last is None:
        last = first
    until = F.lead("batch_id", 1, last + 1).over(Window.partitionBy("data_type", "shard").orderBy("batch_id"))
    valid = changes.withColumn("__until", until).withColumn("batch_id", F.explode(F.expr("sequence(batch_id, __until - 1)")))
    return merge_stats(valid.drop("__until", "shard"), "batch_id")
