import random

import pytest

from modelstream.config import Limits
from modelstream.operators import stats

SERVED = "record_id long, data_type string, name string, since long, submission_ts long, duration double"


def served(spark, seed=1, rows=300):
    rng = random.Random(seed)
    data = [(i, "a", "hot" if rng.random() < 0.8 else "cold", 0, rng.choice([7, rng.randrange(50)]), float(rng.randrange(20))) for i in range(rows)]
    return data, spark.createDataFrame(data, SERVED)


@pytest.mark.parametrize("limits", [Limits(), Limits(rows_per_chunk=20)])
def test_running_statistics(spark, limits):
    data, frame = served(spark)
    expected = {}
    for name in ("hot", "cold"):
        took = []
        for i, _, _, _, _, d in sorted((r for r in data if r[2] == name), key=lambda r: (r[4], r[0])):
            took.append(d)
            expected[i] = (len(took), sum(took), min(took), max(took))
    got = {r.record_id: (r.run_usage, r.run_duration, r.run_min, r.run_max) for r in stats.running_stats(frame, limits=limits).collect()}
    assert got == expected


def test_totals_add_up_and_merge(spark):
    data, frame = served(spark)
    totals = stats.stats_by_model(frame)
    assert totals.agg({"usage": "sum"}).first()[0] == len(data)
    parts = stats.stats_by_model(frame.filter("record_id < 100")).unionByName(stats.stats_by_model(frame.filter("record_id >= 100")))
    merged = stats.merge_stats(parts).select("name", "usage", "duration", "min", "max")
    assert sorted(merged.collect()) == sorted(totals.select("name", "usage", "duration", "min", "max").collect())


def test_sums_do_not_depend_on_the_cut(spark):
    """Durations that no double holds exactly: grouped and running sums are the same bits for any chunks and partitions."""
    from decimal import Decimal

    rng = random.Random(4)
    data = [(i, "a", "m", 0, i, rng.choice([0.1, 0.7, 1e9 + 0.3, 1e-9, rng.randrange(10**6) / 1000])) for i in range(400)]
    frame = spark.createDataFrame(data, SERVED)
    expected, total = {}, Decimal(0)
    for i, *_, d in data:
        total += Decimal(repr(d))
        expected[i] = float(total)
    for rows in (7, 30, 10_000):
        got = stats.running_stats(frame.repartition(3), limits=Limits(rows_per_chunk=rows)).select("record_id", "run_duration").collect()
        assert {r.record_id: r.run_duration for r in got} == expected
    for parts in (1, 5, 13):
        assert stats.stats_by_model(frame.repartition(parts)).first().duration == float(total)


def test_durations_that_are_no_numbers(spark):
    frame = spark.createDataFrame([(1, "a", "m", 0, 1, float("nan")), (2, "a", "m", 0, 2, 2.5), (3, "a", "m", 0, 3, None)], SERVED)
    row = stats.stats_by_model(frame.select("data_type", "name", "since", "duration")).select("usage", "duration").first()
    assert (row.usage, row.duration) == (3, 2.5)
