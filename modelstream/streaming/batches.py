"""Serving per micro-batch with batch operators: no Python per record, no task per type.

The registry is a table of model updates by batch: deltas, a snapshot every so many batches, and a manifest that names both. A
batch joins its records with the registry as it stood before plus its own updates, and writes results and updates under its
batch number: a batch that is run again after a failure replaces what it wrote. What a batch reads of the registry does not
grow with the number of batches before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from modelstream.config import Limits
from modelstream.operators.asof import MODEL, asof_join
from modelstream.operators.registry import latest_models
from modelstream.operators.serve import Policy, in_force, route, serve_latest
from modelstream.plans.sizes import lookup_join
from modelstream.streaming.snapshots import BATCH, SnapshotTable

def still_needed(updates: DataFrame) -> DataFrame:
    """Of all model updates (with their batch) the last of each type and the last usable one: what either policy serves."""
    order = (BATCH, "ts", "seq")
    usable = updates.filter(F.col("params").isNotNull())
    return latest_models(updates, order).filter(F.col("params").isNull()).unionByName(latest_models(usable, order))


class Registry:
    """The model updates under a path, by batch. The schema is that of a built model table."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, every: int = 16) -> None:
        self.path, self.schema = path.rstrip("/"), schema
        self.table = SnapshotTable(spark, path, schema, still_needed, every)

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Keep the models of a batch. Documents are parsed here, once."""
        self.table.update(batch, batch_id)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The models a batch brought, while its updates are kept."""
        return self.table.batch(spark, batch_id)

    def snapshot(self, spark: SparkSession, before: int | None = None, policy: Policy = Policy()) -> DataFrame:
        """The models in force, of the updates of the batches before `before` (all of them without it).

        A model applies from its arrival on: a later batch replaces an earlier one, whatever the times in it. `before` may go
        back to the last snapshot but one.
        """
        rows = self.table.rows(spark, before)
        return latest_models(in_force(rows, policy), (BATCH, "ts", "seq")).drop(BATCH)

    def compact(self, spark: SparkSession, target: str, policy: Policy = Policy()) -> Registry:
        """The snapshot as a new registry at `target`, whose first update it is."""
        fresh = Registry(spark, target, self.schema, self.table.every)
        fresh.update(self.snapshot(spark, policy=policy), -1)
        return fresh


def update_registry(models: DataFrame, registry: Registry, checkpoint: str) -> DataStreamWriter:
    """The job that keeps the registry current from a stream of built models."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            registry.update(batch, batch_id)

    return models.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def _write(results: DataFrame, path: str, batch_id: int) -> None:
    results.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def serve_snapshot(
    records: DataFrame,
    registry: Registry,
    inputs: Callable[[], list[Column]],
    path: str,
    checkpoint: str,
    policy: Policy = Policy(),
    *,
    keep: list[str] | None = None,
    forms: list[str] | None = None,
    limits: Limits = Limits(),
) -> DataStreamWriter:
    """The job that scores each batch of records with the registry as it stands when the batch starts.

    A new model is used from the next batch on; the query is never stopped for it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        models = registry.snapshot(batch.sparkSession, policy=policy)
        _write(
            serve_latest(batch, models, inputs(), policy, keep=keep, forms=forms, limits=limits), path, batch_id
        )

    return records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def serve_arrivals(
    both: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    registry: Registry,
    inputs: Callable[[], list[Column]],
    path: str,
    checkpoint: str,
    policy: Policy = Policy(),
    *,
    order: str = "event_time",
    keep: list[str] | None = None,
    forms: list[str] | None = None,
    limits: Limits = Limits(),
) -> DataStreamWriter:
    """The job over one stream of records and models: each record meets the last model at or before its time.

    `split` takes a batch apart into records and built models. The models in force from earlier batches enter the batch
    before everything in it. ``order="models_first"`` applies all models of a batch before its records. One stream
    drives both sides, so the result depends on the batches only, not on the pace of two queries.
    """
    if order not in ("event_time", "models_first"):
        raise ValueError(f"order must be event_time or models_first, not {order!r}")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            records, models = split(batch)
            entering = registry.snapshot(batch.sparkSession, batch_id, policy)
            if models.isEmpty():
                met = lookup_join(records, _packed(entering, MODEL), "data_type", "left", limits=limits)
            else:
                # Written first and read back. A batch that is run again replaces its own part, which `entering` excludes.
                registry.update(models, batch_id)
                changes = in_force(registry.batch(batch.sparkSession, batch_id), policy)
                if order == "models_first":
                    newest = _packed(latest_models(changes), MODEL)
                    met = lookup_join(records, newest, "data_type", "left", limits=limits)
                else:
                    met = asof_join(records, changes, how="left", limits=limits)
                met = lookup_join(met, _packed(entering, "__entering"), "data_type", "left", limits=limits)
                met = met.withColumn(MODEL, F.coalesce(MODEL, "__entering")).drop("__entering")
            _write(route(met, inputs(), policy, keep, forms), path, batch_id)
        finally:
            batch.unpersist()

    return both.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def _packed(models: DataFrame, name: str) -> DataFrame:
    return models.select("data_type", F.struct(*[F.col(c) for c in models.columns]).alias(name))


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a serving job wrote."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).parquet(path).drop(BATCH)
