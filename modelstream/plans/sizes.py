"""Counted sizes: nothing is broadcast on a guess."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelstream.config import Limits


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """Bytes a value takes, from its type and the lengths of its variable parts."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + F.lit(16)
    if isinstance(kind, T.VariantType):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)).cast("bigint") + F.lit(16)
    if isinstance(kind, T.StructType):
        total = F.lit(16).cast("bigint")
        for field in kind.fields:
            total = total + value_bytes(column.getField(field.name), field.dataType)
        return F.when(column.isNull(), F.lit(8).cast("bigint")).otherwise(total)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            return F.aggregate(
                F.coalesce(column, F.array().cast(kind)),
                F.lit(16).cast("bigint"),
                lambda s, v: s + value_bytes(v, kind.elementType),
            )
        return F.coalesce(F.size(column), F.lit(0)).cast("bigint") * F.lit(8) + F.lit(16)
    if isinstance(kind, T.MapType):
        return value_bytes(F.map_keys(column), T.ArrayType(kind.keyType)) + value_bytes(
            F.map_values(column), T.ArrayType(kind.valueType)
        )
    return F.lit(8).cast("bigint")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of `df`."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        total = total + value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return total


def measure(df: DataFrame, *more: Column) -> dict[str, object]:
    """Rows and bytes of `df` and any further aggregates, in one job."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"), *more
    ).first()
    return row.asDict()


def fits(size: dict[str, object], limits: Limits) -> bool:
    return size["rows"] <= limits.broadcast_rows and size["bytes"] <= limits.broadcast_bytes


def heavy_keys(rows: DataFrame, key: str, limits: Limits = Limits()) -> DataFrame:
    """(__hash, __pieces): the keys of `rows` that would weigh on one task, by hash, and the pieces their rows are cut into.

    One pass fills a frequent-items sketch in each task; the sketches are merged, so nothing grows with the number of keys. A
    key is heavy from half of a task's mean share on, so there are at most two per shuffle partition, and it is cut into
    pieces of 1 / `limits.pieces` of that share. The sketch may count a key too high, never so many rows too low that it matters.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * tasks + 1, 50_000)
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(xxhash64(`{key}`), {most}, {min(20 * most, 1_000_000)})").alias("top")
    ).first()
    share = max(seen["n"] / tasks, 1.0)
    heavy = [(x["item"], math.ceil(limits.pieces * x["count"] / share)) for x in seen["top"] or [] if 2 * x["count"] > share]
    return spark.createDataFrame(heavy, "__hash bigint, __pieces int")


def salted_sides(
    rows: DataFrame, small: DataFrame, key: str, spread: Column, limits: Limits = Limits()
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``__salt`` to join on beside `key`: rows of heavy keys are dealt over as many salts as their
    share asks for, and only their rows of the small side are repeated; all others have salt 0 and one copy."""
    heavy = F.broadcast(heavy_keys(rows, key, limits))

    def salts(side: DataFrame) -> DataFrame:
        return side.withColumn("__hash", F.xxhash64(F.col(f"`{key}`"))).join(heavy, "__hash", "left").drop("__hash")

    count = F.coalesce("__pieces", F.lit(1))
    dealt = salts(rows).withColumn("__salt", F.pmod(F.xxhash64(spread), count).cast("int")).drop("__pieces")
    copies = salts(small).withColumn("__salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("__pieces")
    return dealt, copies


def lookup_join(
    rows: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    *,
    spread: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Join on `key` with a side of one row per key.

    The side is broadcast when its counted size allows. Otherwise both sides are shuffled on the key, and rows of heavy keys
    on a salt taken from `spread` too, so that they go to many tasks; the rows are counted once more for that.
    """
    if fits(measure(small), limits):
        return rows.join(F.broadcast(small), key, how)
    if spread is None:
        spread = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    dealt, copies = salted_sides(rows, small, key, spread, limits)
    # The side is known to be too large, whatever the estimate of its size says.
    return dealt.join(copies.hint("merge"), [key, "__salt"], how).drop("__salt")
