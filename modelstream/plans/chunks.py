"""Ordered chunks: per-key sequential work without one task per key.

A window partitioned by a hot key sorts all its rows in one task. Here the rows of such a key are cut into consecutive
chunks of about `rows_per_chunk` rows along the sort order. Each (key, chunk) is a window of its own, and what a chunk
needs from its neighbours is one aggregate per chunk, carried over by a window over the chunk list.

The cut points come from a random sample that never leaves the tasks: it is dealt by range, numbered inside each part, and
the parts' counts give the numbers over all of it; every so-many-th row is a cut. The cut table is a written table with a row per
chunk. Rows find their chunk by a broadcast of the table while its counted size allows, else level by level: blocks of
blocks of chunks are broadcast, the finer levels are joined on (key, block). Cuts decide only where rows go, every row is kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelstream.config import Limits, work_folder
from modelstream.plans.sizes import fits, measure, salted_sides

CHUNK = "__chunk"
SALTS = "__salts"
PART = "__part"
INDEX = "__index"
SAMPLES_PER_CHUNK = 30
# Chunks, or blocks of them, of one key that a row is compared with in a step.
BLOCK_CHUNKS = 64


@dataclass(frozen=True)
class Chunked:
    """Rows with their chunk number, and the chunk list of the keys that were cut (None when no key was)."""

    rows: DataFrame
    bounds: DataFrame | None
    key: str
    order: list[str]
    limits: Limits = Limits()


def _sized(side: DataFrame, limits: Limits) -> DataFrame:
    """`side`, marked for a broadcast if its counted size allows it."""
    return F.broadcast(side) if fits(measure(side), limits) else side


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back, so that every use sees the same rows."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """`rows` with ``__index``, their place in `order` over the whole table from 0 on, and their number.

    Rows are dealt by range and numbered inside their part; what meets in one place is one count per part.
    """
    parts = written(
        rows.repartitionByRange(*[F.col(c) for c in order]).withColumn(PART, F.spark_partition_id()), "chunk-sample"
    )
    counts = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    own = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    placed = parts.withColumn("__own", own).join(F.broadcast(offsets), PART)
    return placed.withColumn(INDEX, F.col("__offset") + F.col("__own") - 1).select(*rows.columns, INDEX), parts.count()


def chunk_bounds(
    keys: DataFrame,
    key: str,
    order: list[str],
    rows_per_chunk: int,
    total: int | None = None,
    isolate: bool = False,
) -> DataFrame | None:
    """The cut table over `keys` (columns `key` and `order`): one row per chunk of every key that is cut.

    `__lo_*` is the first order value of a chunk (null before the first cut), `__hi_*` that of the next one. `__salts`
    counts the cuts that fell on the same value: rows with equal order values cannot be cut, only spread. With `isolate`
    (one integer order column) such a value is a chunk of its own.
    """
    keys = keys.select(key, *order)
    total = keys.count() if total is None else total
    chunks = math.ceil(total / rows_per_chunk)
    if chunks <= 1:
        return None
    fraction = min(1.0, SAMPLES_PER_CHUNK * chunks / total)
    sample, size = numbered(keys.dropna().sample(fraction, seed=7), [key, *order])
    if not size:
        return None
    # The i-th cut is the first row of the sample at or beyond i * size / chunks, if its place is a step of its own.
    step = max(size / chunks, 1.0)
    turn = F.ceil(F.col(INDEX) / F.lit(step))
    is_cut = (F.col(INDEX) > 0) & (turn < chunks) & (F.floor(turn * F.lit(step)) == F.col(INDEX))
    cuts = sample.filter(is_cut).groupBy(key, *order).agg(F.count(F.lit(1)).cast("int").alias(SALTS))
    if isolate:
        (at,) = order
        after = cuts.filter(F.col(SALTS) > 1).select(key, (F.col(at) + 1).alias(at), F.lit(1).alias(SALTS))
        cuts = cuts.unionByName(after).groupBy(key, at).agg(F.max(SALTS).alias(SALTS))
    cuts = cuts.withColumn("__first", F.lit(1))
    starts = cuts.select(key).distinct().select(
        key, *[F.lit(None).cast(keys.schema[c].dataType).alias(c) for c in order], F.lit(1).alias(SALTS), F.lit(0).alias("__first")
    )
    # A key has as many rows here as it has chunks.
    frame = Window.partitionBy(key).orderBy("__first", *order)
    bounds = starts.unionByName(cuts.select(*starts.columns)).select(
        key,
        (F.row_number().over(frame) - 1).alias(CHUNK),
        SALTS,
        *[F.col(c).alias(f"__lo_{c}") for c in order],
        *[F.lead(c).over(frame).alias(f"__hi_{c}") for c in order],
    )
    bounds = written(bounds, "chunk-bounds")
    return None if bounds.isEmpty() else bounds


def _not_before(order: list[str], side: str) -> Column:
    """The row's order values are at or after the bound's, compared left to right."""
    result = F.lit(True)
    for c in reversed(order):
        bound = F.col(f"__{side}_{c}")
        result = (F.col(f"r.{c}") > bound) | ((F.col(f"r.{c}") == bound) & result)
    return result


def _inside(order: list[str]) -> Column:
    lo, hi = F.col(f"__lo_{order[0]}"), F.col(f"__hi_{order[0]}")
    return (lo.isNull() | _not_before(order, "lo")) & (hi.isNull() | ~_not_before(order, "hi"))


def _level(bounds: DataFrame, key: str, order: list[str], height: int) -> DataFrame:
    """The blocks of `BLOCK_CHUNKS` ** `height` chunks with the block above each: (__key, __block, __above, __lo_*, __hi_*)."""
    number = F.floor(F.col(CHUNK) / F.lit(BLOCK_CHUNKS**height)).cast("int")
    blocks = bounds.groupBy(F.col(key).alias("__key"), number.alias("__block")).agg(
        *[F.min_by(f"__lo_{c}", CHUNK).alias(f"__lo_{c}") for c in order],
        *[F.max_by(f"__hi_{c}", CHUNK).alias(f"__hi_{c}") for c in order],
        F.min_by(SALTS, CHUNK).alias(SALTS),
    )
    return blocks.withColumn("__above", F.floor(F.col("__block") / F.lit(BLOCK_CHUNKS)).cast("int"))


def assign(
    rows: DataFrame, bounds: DataFrame | None, key: str, order: list[str], limits: Limits = Limits()
) -> DataFrame:
    """`rows` with chunk number and salt count; keys that are not cut have one chunk, 0."""
    if bounds is None:
        return rows.withColumns({CHUNK: F.lit(0), SALTS: F.lit(1)})
    size = measure(bounds, F.max(CHUNK).alias("last"), F.approx_count_distinct(key, 0.01).alias("keys"))

    def few(level: int) -> bool:
        """Whether the blocks of a level may be broadcast: a key has one block of its own at least."""
        share = min(1.0, 1 / BLOCK_CHUNKS**level + 1.05 * size["keys"] / size["rows"])
        return fits({"rows": share * size["rows"], "bytes": share * size["bytes"]}, limits)

    height = 0
    while BLOCK_CHUNKS ** (height + 1) <= size["last"] or BLOCK_CHUNKS**height <= size["last"] and not few(height):
        height += 1
    # From the largest blocks down to single chunks: a row is compared with few in each step.
    found = rows.withColumn("__at", F.lit(0))
    for level in range(height, -1, -1):
        table, left, more = _level(bounds, key, order, level), found, F.lit(True)
        if level < height:
            more = F.col("r.__at") == F.col("__above")
        if few(level):
            table = F.broadcast(table)
        elif level == height:
            # Very many cut keys: those with many rows are dealt over salts.
            left, table = salted_sides(found, table.withColumnRenamed("__key", key), key, F.struct(*[F.col(c) for c in order]), limits)
            table = table.withColumnsRenamed({key: "__key", "__salt": "__copy"}).hint("merge")
            more = F.col("r.__salt") == F.col("__copy")
        else:
            table = table.hint("merge")
        found = (
            left.alias("r")
            .join(table, (F.col(f"r.{key}") == F.col("__key")) & more & _inside(order), "left")
            .select(*[F.col(f"r.`{c}`") for c in rows.columns], F.coalesce("__block", F.lit(0)).alias("__at"), SALTS)
        )
        if level:
            found = found.drop(SALTS)
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__at").alias(CHUNK), F.coalesce(SALTS, F.lit(1)).alias(SALTS))


def chunked(
    rows: DataFrame, key: str, order: list[str], limits: Limits = Limits(), total: int | None = None
) -> Chunked:
    """Cut the keys of `rows` that hold more than about `limits.rows_per_chunk` rows."""
    bounds = chunk_bounds(rows, key, order, limits.rows_per_chunk, total)
    return Chunked(assign(rows, bounds, key, order, limits), bounds, key, order, limits)


def carried(
    parts: Chunked,
    aggregates: dict[str, Column],
    combine: dict[str, Callable[[Column], Column]],
    *,
    forward: bool = True,
) -> DataFrame | None:
    """For each chunk of a cut key, `combine` over the `aggregates` of the chunks before it (after it with
    ``forward=False``). The aggregates are built map-side; what is left is one row per chunk."""
    if parts.bounds is None:
        return None
    key = parts.key
    local = (
        parts.rows.join(_sized(parts.bounds.select(key).distinct(), parts.limits), key, "left_semi")
        .groupBy(key, CHUNK)
        .agg(*[a.alias(name) for name, a in aggregates.items()])
    )
    frame = Window.partitionBy(key).orderBy(F.col(CHUNK) if forward else F.col(CHUNK).desc())
    frame = frame.rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.bounds.join(local, [key, CHUNK], "left")
        .select(
            key,
            CHUNK,
            SALTS,
            *[F.col(f"__lo_{c}") for c in parts.order],
            *[combine[name](F.col(name)).over(frame).alias(name) for name in aggregates],
        )
    )


def with_carried(parts: Chunked, carry: DataFrame | None, names: dict[str, str]) -> DataFrame:
    """`parts.rows` with the carried values of their chunk in columns, null where nothing is carried."""
    if carry is None:
        return parts.rows.withColumns({n: F.lit(None).cast(t) for n, t in names.items()})
    carry = _sized(written(carry.select(parts.key, CHUNK, *names), "chunk-carry"), parts.limits)
    return parts.rows.join(carry, [parts.key, CHUNK], "left")
