"""Each record meets the latest model of its type.

Two plans give the same rows:

* ``broadcast``: the models' validity intervals, cut at the cells of a time grid, are broadcast and hashed on
  (type, cell); the models themselves are broadcast once each and fetched by type and time. The records are not shuffled.
  Chosen when the counted size of both allows it; beyond that ``auto`` takes the other plan, ``broadcast`` alone is an error.
* ``chunked``: records and models are shuffled once on (type, chunk of time), sorted, and the last model is filled
  forward; the model in force where a chunk begins is carried in. No type and no instant goes to a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.plans import chunks
from modelstream.plans.sizes import fits, measure, row_bytes

MODEL = "model"


def asof_join(
    records: DataFrame,
    models: DataFrame,
    *,
    key: str = "data_type",
    at: str = "ts",
    seq: str = "seq",
    how: str = "inner",
    strategy: str = "auto",
    limits: Limits = Limits(),
) -> DataFrame:
    """`records` with a struct column ``model``: the last model of the same `key` with ``model.at <= record.at``.

    A model and a record at the same point meet. Of several models at one point the one with the largest `seq` counts.
    ``how="left"`` keeps records without a model.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if MODEL in records.columns:
        raise ValueError("the records already have a column called model")
    if strategy not in ("auto", "broadcast", "chunked"):
        raise ValueError(f"strategy must be auto, broadcast or chunked, not {strategy!r}")
    if strategy != "chunked":
        joined = _broadcast(records, models, key, at, seq, how, limits)
        if joined is not None:
            return joined
        if strategy == "broadcast":
            raise ValueError("the models exceed the broadcast limits")
    return _chunked(records, models, key, at, seq, how, limits)


def _broadcast(
    records: DataFrame, models: DataFrame, key: str, at: str, seq: str, how: str, limits: Limits
) -> DataFrame | None:
    size = models.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.approx_count_distinct(key).alias("keys"),
    ).first()
    if size["rows"] > limits.broadcast_rows:
        return None
    if size["first"] is None:
        cells, width, first = 0, 1, 0
    else:
        # About one switch per key and cell, so a record is compared with few models.
        cells = max(1, min(size["rows"] // max(size["keys"], 1), 8192))
        width = (size["last"] - size["first"]) // cells + 1
        first = size["first"]

    def cell(point):
        return F.floor((point - F.lit(first)) / F.lit(width)).cast("bigint")

    # Bytes of the models, and the most switches of one key in one cell.
    crowd = (
        models.groupBy(key, cell(F.col(at)).alias("cell"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(models)).alias("bytes"))
        .agg(F.coalesce(F.max("rows"), F.lit(0)).alias("most"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .first()
    )
    if crowd["most"] > limits.cell_candidates or crowd["bytes"] > limits.broadcast_bytes:
        return None
    # A model is in force until the next one; one that is replaced at its own point never is. The models are few here.
    until = F.lead(at).over(Window.partitionBy(key).orderBy(at, seq))
    last_cell = F.when(F.col("__until").isNull(), F.lit(cells)).otherwise(cell(F.col("__until") - F.lit(1)))
    forced = (
        models.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
        .select(
            F.col(key).alias("__key"),
            F.col(at).alias("__from"),
            until.alias("__until"),
            F.struct(*[F.col(f"`{c}`") for c in models.columns]).alias(MODEL),
        )
        .filter(F.col("__until").isNull() | (F.col("__until") > F.col("__from")))
    )
    # An interval is repeated for each of its cells, so it carries no model.
    table = forced.select(
        "__key", "__from", "__until", F.explode(F.sequence(cell(F.col("__from")), last_cell)).alias("__at_cell")
    )
    size = measure(table)
    if not fits({"rows": size["rows"], "bytes": size["bytes"] + crowd["bytes"]}, limits):
        return None
    # Of one key and point one model is in force.
    versions = forced.select(F.col("__key").alias("__of"), F.col("__from").alias("__since"), MODEL)
    record_cell = F.least(F.greatest(cell(F.col(at)), F.lit(-1)), F.lit(cells))
    meets = (
        (F.col(key) == F.col("__key"))
        & (F.col("__cell") == F.col("__at_cell"))
        & (F.col(at) >= F.col("__from"))
        & (F.col("__until").isNull() | (F.col(at) < F.col("__until")))
    )
    joined = records.withColumn("__cell", record_cell).join(F.broadcast(table), meets, how)
    version = (F.col("__key") == F.col("__of")) & (F.col("__from") == F.col("__since"))
    joined = joined.join(F.broadcast(versions), version, how)
    return joined.select(*[F.col(f"`{c}`") for c in records.columns], MODEL)


def _chunked(
    records: DataFrame, models: DataFrame, key: str, at: str, seq: str, how: str, limits: Limits
) -> DataFrame:
    # Records without a key or a point cannot meet a model; they pass by the window.
    lost = F.col(key).isNull() | F.col(at).isNull()
    placed = records.filter(~lost)
    bounds = chunks.chunk_bounds(
        placed.select(key, at).unionByName(models.select(key, at)),
        key,
        [at],
        limits.rows_per_chunk,
        isolate=True,
    )
    data = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    packed = F.struct(*[F.col(f"`{c}`") for c in models.columns]).alias(MODEL)
    points = models.filter(~lost).select(key, at, F.col(seq).alias("__seq"), packed)
    if bounds is not None and bounds.filter(F.col(chunks.SALTS) > 1).count():
        # A point with very many records gets copies of its models: only the last model of a point is copied.
        points = points.groupBy(key, at).agg(
            F.max("__seq").alias("__seq"), F.max_by(MODEL, "__seq").alias(MODEL)
        )
    switches = chunks.Chunked(chunks.assign(points, bounds, key, [at], limits), bounds, key, [at], limits)
    updates = switches.rows.select(
        key, chunks.CHUNK, chunks.SALTS, at, F.lit(1).alias("__rank"), "__seq", MODEL
    )
    carry = chunks.carried(
        switches,
        {MODEL: F.max_by(MODEL, F.struct(at, "__seq"))},
        {MODEL: lambda c: F.last(c, ignorenulls=True)},
    )
    if carry is not None:
        entering = carry.filter(F.col(MODEL).isNotNull()).select(
            key, chunks.CHUNK, chunks.SALTS, F.col(f"__lo_{at}").alias(at), F.lit(0).alias("__rank"), MODEL
        )
        updates = updates.unionByName(entering, allowMissingColumns=True)
    # A chunk that could not be cut (many rows at one point) is spread over salts, each with its own copy of the models.
    updates = updates.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.col(chunks.SALTS) - F.lit(1)))
    ).drop(chunks.SALTS)
    rows = (
        chunks.assign(placed.select(key, at, data.alias("__data")), bounds, key, [at], limits)
        .withColumns(
            {
                "__rank": F.lit(2),
                "__salt": F.pmod(F.xxhash64("__data"), F.col(chunks.SALTS)).cast("int"),
            }
        )
        .drop(chunks.SALTS)
    )
    frame = (
        Window.partitionBy(key, chunks.CHUNK, "__salt")
        .orderBy(at, "__rank", "__seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = (
        rows.unionByName(updates, allowMissingColumns=True)
        .withColumn("__model", F.last(MODEL, ignorenulls=True).over(frame))
        .filter(F.col("__data").isNotNull())
        .select("__data.*", F.col("__model").alias(MODEL))
    )
    if how == "inner":
        return filled.filter(F.col(MODEL).isNotNull())
    empty = records.filter(lost).withColumn(MODEL, F.lit(None).cast(filled.schema[MODEL].dataType))
    return filled.unionByName(empty)
