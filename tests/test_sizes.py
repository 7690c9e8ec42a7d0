"""Joins with a side of one row per key: heavy keys are found by a sketch and dealt out, others are not copied."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.plans.sizes import heavy_keys, lookup_join, salted_sides

PARTITIONS = 40


@pytest.fixture
def settings(spark):
    names = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, n=200_000):
    """A third of the rows in one key, a tenth without one, a twentieth in another, the rest over 5,000."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .when(F.col("id") % 20 == 2, F.lit("warm"))
        .otherwise(F.concat(F.lit("k"), F.col("id") * 31 % 5_000))
    )
    return spark.range(n).select(key.alias("k"), F.col("id"))


def sides(spark):
    rows = skewed(spark)
    small = rows.filter("k is not null").select("k").distinct().withColumn("v", F.concat(F.lit("of "), "k"))
    return rows, small


def test_heavy_keys(spark, settings):
    rows, _ = sides(spark)
    found = {r["__hash"]: r["__pieces"] for r in heavy_keys(rows, "k").collect()}
    hashes = {name: spark.sql(f"SELECT xxhash64({name})").first()[0] for name in ("'hot'", "'warm'", "CAST(NULL AS STRING)")}
    assert set(found) == set(hashes.values())
    # Pieces by share: of a third of the rows more than of a twentieth.
    assert found[hashes["'hot'"]] > 4 * found[hashes["'warm'"]] > 4


def test_no_task_gets_twice_the_median(spark, settings):
    rows, small = sides(spark)
    out = lookup_join(rows, small, "k", "left", limits=Limits(broadcast_rows=10))
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 200_000 and len(sizes) == PARTITIONS
    assert max(sizes) <= 2 * median(sizes)
    assert out.filter("v is distinct from 'of ' || k").count() == 0


def test_cold_keys_are_not_copied(spark, settings):
    rows, small = sides(spark)
    _, copies = salted_sides(rows, small, "k", F.col("id"), Limits())
    per_key = {r["k"]: r["n"] for r in copies.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {k for k, n in per_key.items() if n > 1} == {"hot", "warm"}
    assert copies.count() < small.count() + 8 * PARTITIONS


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(spark, how):
    rows, small = sides(spark)
    rows, small = rows.filter("id < 3000"), small.filter("k <> 'k31'")
    plain = sorted(map(repr, rows.join(small, "k", how).collect()))
    for limits in (Limits(), Limits(broadcast_rows=0)):
        assert sorted(map(repr, lookup_join(rows, small, "k", how, limits=limits).select("k", "id", "v").collect())) == plain
    nothing = rows.filter("false")
    assert lookup_join(nothing, small, "k", how, limits=Limits(broadcast_rows=0)).count() == 0
