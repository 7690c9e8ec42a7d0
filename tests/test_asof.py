"""The as-of join against brute force, on both plans, with ties, hot types and hot instants."""

import random

import pytest
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.operators.asof import asof_join
from modelstream.plans import chunks

RECORDS = "record_id long, data_type string, ts long"
MODELS = "name string, data_type string, ts long, seq long"


def brute_force(records, models):
    met = {}
    for record_id, kind, ts in records:
        best = None
        for name, other, at, seq in models:
            if kind is not None and ts is not None and other == kind and at is not None and at <= ts:
                best = max(best, (at, seq, name)) if best else (at, seq, name)
        met[record_id] = best[2] if best else None
    return met


def joined(spark, records, models, how="left", **options):
    out = asof_join(
        spark.createDataFrame(records, RECORDS), spark.createDataFrame(models, MODELS), how=how, **options
    )
    return {r.record_id: r.model.name if r.model else None for r in out.collect()}


def mixed(seed, records=400, models=60, span=50):
    rng = random.Random(seed)
    kinds = ["a"] * 6 + ["b", "c", "d", None]
    return (
        [(i, rng.choice(kinds), rng.choice([rng.randrange(span), None] if i % 50 == 0 else [rng.randrange(span)])) for i in range(records)],
        [(f"m{i}", rng.choice("aaab"), rng.randrange(span), i) for i in range(models)],
    )


def hot_instant(seed):
    """A third of the records, and many models, at one instant of one type."""
    rng = random.Random(seed)
    records = [(i, "a", 20 if i % 3 == 0 else rng.randrange(100)) for i in range(400)]
    models = [(f"m{i}", "a", 20 if i % 4 == 0 else rng.randrange(100), i) for i in range(40)]
    return records, models


PLANS = [
    {"strategy": "broadcast"},
    {"strategy": "chunked"},
    {"strategy": "chunked", "limits": Limits(rows_per_chunk=25)},
    # Cut tables that may not be broadcast: found level by level.
    {"strategy": "chunked", "limits": Limits(rows_per_chunk=2, broadcast_rows=6)},
    {"strategy": "chunked", "limits": Limits(rows_per_chunk=25, broadcast_rows=0)},
]


@pytest.mark.parametrize("options", PLANS)
@pytest.mark.parametrize("data", [mixed(1), mixed(2), hot_instant(3)])
def test_left_join_equals_brute_force(spark, data, options):
    records, models = data
    assert joined(spark, records, models, **options) == brute_force(records, models)


@pytest.mark.parametrize("options", PLANS)
def test_inner_join_keeps_records_with_a_model(spark, options):
    records, models = mixed(4)
    expected = {k: v for k, v in brute_force(records, models).items() if v is not None}
    assert joined(spark, records, models, how="inner", **options) == expected


@pytest.mark.parametrize("options", PLANS)
def test_no_models(spark, options):
    assert joined(spark, [(1, "a", 5)], [], **options) == {1: None}


def test_crowded_models_leave_the_broadcast_plan(spark):
    records = [(i, "a", i) for i in range(50)]
    models = [(f"m{i}", "a", 10, i) for i in range(30)] + [("late", "a", 1_000_000, 99)]
    limits = Limits(cell_candidates=8)
    with pytest.raises(ValueError):
        joined(spark, records, models, strategy="broadcast", limits=limits)
    assert joined(spark, records, models, limits=limits) == brute_force(records, models)


def test_too_many_models_leave_the_broadcast_plan(spark):
    records, models = mixed(5)
    limits = Limits(broadcast_rows=10)
    with pytest.raises(ValueError):
        joined(spark, records, models, strategy="broadcast", limits=limits)
    assert joined(spark, records, models, limits=limits) == brute_force(records, models)


def test_intervals_are_counted_as_often_as_they_are_sent(spark):
    # 21 models, the first of which is in force in all cells but those of the others.
    models = [("long", "b", 0, 0)] + [(f"m{i}", "a", 10 * i, i) for i in range(1, 21)]
    records = [(i, "ab"[i % 2], i) for i in range(250)]
    assert joined(spark, records, models, strategy="broadcast", limits=Limits(broadcast_rows=60)) == brute_force(records, models)
    with pytest.raises(ValueError):
        joined(spark, records, models, strategy="broadcast", limits=Limits(broadcast_rows=25))
    assert joined(spark, records, models, limits=Limits(broadcast_rows=25)) == brute_force(records, models)


def test_registered_interval_query_serves_crowded_models(spark, monkeypatch):
    from modelstream.plans import catalog

    source = "/root/testdata/sf0.001"
    copies = spark.range(100).withColumnRenamed("id", "__copy")
    crowded = catalog.b.models(spark, source).crossJoin(copies).withColumn("seq", F.col("seq") * 100 + F.col("__copy")).drop("__copy")
    monkeypatch.setattr(catalog.b, "models", lambda *_: crowded)
    found = catalog.QUERIES["serve_asof_interval"](spark, source).collect()
    assert found and sorted(found) == sorted(catalog.QUERIES["serve_asof_chunked"](spark, source).collect())


def test_broadcast_plan_does_not_shuffle_records(spark):
    records = spark.range(1000).select(F.col("id").alias("record_id"), F.lit("a").alias("data_type"), F.col("id").alias("ts"))
    models = spark.createDataFrame([("m", "a", 5, 1)], MODELS)
    plan = asof_join(records, models, strategy="broadcast")._jdf.queryExecution().executedPlan().toString()
    record_side = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in record_side and "Exchange hashpartitioning" not in record_side


def test_hot_type_is_cut_into_bounded_chunks(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), F.col("id").alias("ts"))
    parts = chunks.chunked(rows, "k", ["ts"], Limits(rows_per_chunk=1000))
    sizes = parts.rows.groupBy("k", chunks.CHUNK).count().collect()
    assert sum(r["count"] for r in sizes) == 20_000
    assert max(r["count"] for r in sizes) < 3000
    # Chunks are consecutive in time.
    edges = parts.rows.groupBy("k", chunks.CHUNK).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("k", "lo").collect()
    for one, two in zip(edges, edges[1:]):
        assert one.k != two.k or one.hi < two.lo


def test_hot_instant_is_spread_over_salts(spark):
    rows = spark.range(9000).select(F.lit("k").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(500)).otherwise(F.col("id")).alias("ts"))
    bounds = chunks.chunk_bounds(rows, "k", ["ts"], 500, isolate=True)
    hot = chunks.assign(rows, bounds, "k", ["ts"]).filter("ts = 500").select(chunks.CHUNK, chunks.SALTS).distinct().collect()
    assert len(hot) == 1 and hot[0][chunks.SALTS] >= 5


def test_long_chunk_lists_are_searched_in_two_steps(spark):
    rows = spark.range(30_000).select(F.lit("k").alias("k"), F.col("id").alias("ts"))
    bounds = chunks.chunk_bounds(rows, "k", ["ts"], 100)
    assert bounds.count() > 3 * chunks.BLOCK_CHUNKS
    placed = chunks.assign(rows, bounds, "k", ["ts"])
    checked = placed.join(bounds.drop(chunks.SALTS), ["k", chunks.CHUNK]).filter(
        "(__lo_ts IS NULL OR ts >= __lo_ts) AND (__hi_ts IS NULL OR ts < __hi_ts)"
    )
    assert checked.count() == placed.count() == 30_000


def test_chunks_are_not_limited_in_number(spark):
    """70,000 chunks, three levels of blocks, and no row is compared with a whole list."""
    rows = spark.range(140_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), (F.col("id") * 7919 % 1_000_003).alias("ts"))
    limits = Limits(rows_per_chunk=2, broadcast_rows=2_000)
    parts = chunks.chunked(rows, "k", ["ts"], limits)
    sizes = parts.rows.groupBy("k", chunks.CHUNK).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high"))
    found = sizes.agg(F.count(F.lit(1)).alias("chunks"), F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    assert found["rows"] == 140_000 and found["chunks"] > 60_000 and found["most"] <= 4
    # Chunks of a key follow one another.
    from pyspark.sql import Window

    before = F.lag("high").over(Window.partitionBy("k").orderBy(chunks.CHUNK))
    assert sizes.withColumn("before", before).filter("before >= low").count() == 0


def test_cut_table_of_many_keys(spark):
    """Every key is cut and even the largest blocks are too many for a broadcast."""
    rows = spark.range(3_000).select((F.col("id") % 100).alias("k"), F.floor(F.col("id") / 100 % 17).alias("ts"), F.col("id"))
    limits = Limits(rows_per_chunk=3, broadcast_rows=10)
    parts = chunks.chunked(rows, "k", ["ts", "id"], limits)
    plain = chunks.chunked(rows, "k", ["ts", "id"], Limits(rows_per_chunk=3))
    number = lambda p: {r.id: (r[chunks.CHUNK], r[chunks.SALTS]) for r in p.rows.collect()}
    found = number(parts)
    assert len(found) == 3_000 and found == number(plain)
    assert max(c for c, _ in found.values()) >= 5
