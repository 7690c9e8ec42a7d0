"""One small case per edge policy."""

import math

import pytest
from pyspark.sql import functions as F

from modelstream.functions import features, text
from modelstream.operators import registry, stats
from modelstream.operators.serve import Policy, serve_asof, serve_few, serve_latest
from modelstream.plans import fixtures
from modelstream.schemas import BAD_INPUT, LONG_MAX, LONG_MIN, NO_MODEL, linear_params

RECORDS = "record_id long, data_type string, ts long, x double"


def models(spark, rows):
    """Rows (name, type, ts, intercept); an intercept of None is a model that failed to build."""
    frame = spark.createDataFrame(
        [(n, d, t, i, v) for i, (n, d, t, v) in enumerate(rows)],
        "name string, data_type string, ts long, seq long, v double",
    )
    params = F.when(F.col("v").isNotNull(), linear_params(F.col("v"), [F.lit(1.0)]))
    return frame.select(
        "name", F.lit("d").alias("description"), "data_type", F.lit(2).alias("model_kind"), "ts", "seq", params.alias("params")
    )


def run(spark, records, model_rows, policy=Policy(), serve=serve_asof, **options):
    frame = spark.createDataFrame(records, RECORDS)
    out = serve(frame, models(spark, model_rows), [F.col("x")], policy, keep=["record_id"], forms=["linear"], **options)
    return {r.record_id: (r.name, r.data_type, r.submission_ts, r.result) for r in out.collect()}


def test_bad_input_is_dropped_or_marked(spark):
    rows = [(1, "", 5, 1.0), (2, None, 5, 1.0), (3, "a", 5, 1.0)]
    assert set(run(spark, rows, [("m", "a", 1, 1.0)])) == {3}
    marked = run(spark, rows, [("m", "a", 1, 1.0)], Policy(bad_input="mark"))
    assert marked[1] == marked[2] == (BAD_INPUT, "", 0, 0.0)
    assert marked[3] == ("m", "a", 5, 2.0)


def test_no_model_is_dropped_or_marked(spark):
    rows = [(1, "a", 0, 1.0), (2, "b", 9, 1.0), (3, "a", 9, 1.0)]
    assert set(run(spark, rows, [("m", "a", 1, 1.0)])) == {3}
    for serve in (serve_asof, serve_latest):
        marked = run(spark, rows, [("m", "a", 1, 1.0)], Policy(no_model="mark"), serve)
        assert marked[2] == (NO_MODEL, "", 0, 0.0)


def test_bad_model_keeps_or_clears(spark):
    rows = [(1, "a", 2, 1.0), (2, "a", 5, 1.0), (3, "a", 9, 1.0)]
    updates = [("good", "a", 1, 1.0), ("bad", "a", 4, None), ("next", "a", 8, 2.0)]
    keep = run(spark, rows, updates)
    clear = run(spark, rows, updates, Policy(on_bad_model="clear"))
    assert [keep[i][0] for i in (1, 2, 3)] == ["good", "good", "next"]
    assert {i: clear[i][0] for i in clear} == {1: "good", 3: "next"}
    assert clear.items() <= keep.items()
    assert run(spark, rows, updates, Policy(on_bad_model="clear", no_model="mark"))[2][0] == NO_MODEL


def test_submission_time_is_the_records_own(spark):
    assert run(spark, [(1, "a", 7, 0.0)], [("m", "a", 1, 1.0)])[1][2] == 7
    assert spark.range(1).select(text.latency_ms(F.lit(7), F.lit(30))).first()[0] == 23


def test_model_applies_before_a_record_of_the_same_time(spark):
    assert run(spark, [(1, "a", 5, 0.0)], [("old", "a", 1, 1.0), ("new", "a", 5, 2.0)])[1][0] == "new"


def test_models_first_in_a_batch(spark):
    records = spark.createDataFrame([(1, "a", 2, 0.0), (2, "a", 12, 0.0)], RECORDS).withColumn("batch", F.col("ts") - F.col("ts") % 10)
    updates = models(spark, [("first", "a", 3, 1.0), ("last", "a", 8, 2.0)]).withColumn("batch", F.col("ts") - F.col("ts") % 10)
    out = serve_asof(records, updates, [F.col("x")], order="models_first", keep=["record_id"], forms=["linear"])
    assert {r.record_id: r.name for r in out.collect()} == {1: "last", 2: "last"}


def test_last_of_several_models_wins(spark):
    latest = registry.latest_models(models(spark, [("one", "a", 5, 1.0), ("two", "a", 5, 2.0), ("old", "a", 1, 3.0)]))
    assert [r.name for r in latest.collect()] == ["two"]


def test_statistics_start_anew_on_a_swap(spark):
    served = serve_asof(
        spark.createDataFrame([(1, "a", 2, 3.0), (2, "a", 3, 5.0), (3, "a", 9, 7.0)], RECORDS),
        models(spark, [("m", "a", 1, 1.0), ("m", "a", 8, 1.0)]),
        [F.col("x")],
        keep=["record_id", "x"],
        forms=["linear"],
    ).withColumnRenamed("x", "duration")
    rows = {r.since: (r.usage, r.duration, r["min"], r["max"]) for r in stats.stats_by_model(served).collect()}
    assert rows == {1: (2, 8.0, 3, 5), 8: (1, 7.0, 7, 7)}


def test_unknown_type_has_default_statistics(spark):
    current = stats.current_stats(
        models(spark, [("m", "a", 1, 1.0)]),
        spark.createDataFrame([], "data_type string, name string, since long, usage long, duration double, min long, max long"),
    )
    wanted = spark.createDataFrame([("a",), ("nobody",)], "data_type string")
    rows = {r.data_type: r for r in stats.state_of(wanted, current).collect()}
    unknown = rows["nobody"]
    assert (unknown.name, unknown.model_type, unknown.since, unknown.usage) == ("", 2, 0, 0)
    assert (unknown["min"], unknown["max"]) == (LONG_MAX, LONG_MIN)
    assert rows["a"].name == "m" and rows["a"].usage == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_average_without_usage_is_nan(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        value = spark.range(1).select(stats.average(F.lit(0.0), F.lit(0).cast("bigint"))).first()[0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert math.isnan(value)


def test_a_type_is_known_after_a_record_or_a_model(spark):
    a = spark.createDataFrame([("a",), ("b",)], "data_type string")
    b = spark.createDataFrame([("b",), ("c",)], "data_type string")
    assert sorted(r.data_type for r in stats.processors(a, b).collect()) == ["a", "b", "c"]


def test_unknown_feature_is_zero(spark):
    x = features.value_by_name(["a", "b"], [F.lit(1.0), F.lit(2.0)], F.col("n"))
    rows = spark.createDataFrame([("a",), ("b",), ("z",)], "n string").select(x.alias("x")).collect()
    assert [r.x for r in rows] == [1.0, 2.0, 0.0]


def test_unusable_models_are_not_built(spark):
    rows = [
        ("unknown kind", 9, fixtures.LINEAR),
        ("empty", 2, ""),
        ("cut", 2, fixtures.LINEAR[:80]),
        ("not layers", 0, "{}"),
        ("good", 2, fixtures.LINEAR),
        ("layers", 1, fixtures.layers_document([([[1.0]], [0.0], "sigmoid")])),
    ]
    frame = spark.createDataFrame(rows, "name string, model_kind int, text string").select(
        "name", "model_kind", F.col("text").cast("binary").alias("model")
    )
    built = registry.build_models(frame, ["quantity"])
    usable = {r.name: r.params is not None for r in built.collect()}
    assert usable == {"unknown kind": False, "empty": False, "cut": False, "not layers": False, "good": True, "layers": True}
    assert [r.name for r in registry.unsupported(frame).collect()] == ["unknown kind"]
    assert registry.with_payload(frame).count() == 5


def test_argmax_takes_the_first_of_equals(spark):
    row = spark.range(1).select(features.argmax(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("i")).first()
    assert row.i == 1


def test_policy_rejects_unknown_options():
    with pytest.raises(ValueError):
        Policy(no_model="ignore")


def test_results_of_the_types_together_are_those_of_each(spark):
    rows = [(i, "abc"[i % 3], i, float(i)) for i in range(60)]
    updates = [(f"m{i}", "abc"[i % 3], i * 7, float(i)) for i in range(6)]
    together = run(spark, rows, updates)
    apart = {}
    for kind in "abc":
        apart.update(run(spark, [r for r in rows if r[1] == kind], [u for u in updates if u[1] == kind]))
    assert together == apart


@pytest.mark.parametrize("most", [32, 1])
@pytest.mark.parametrize("policy", [Policy(), Policy("mark", "mark"), Policy("mark", "mark", "clear")])
def test_few_models_in_the_plan_serve_as_a_join_does(spark, most, policy):
    records = spark.createDataFrame([(1, "a", 2, 1.0), (2, "b", 2, 2.0), (3, "it's", 2, 3.0), (4, "z", 2, 1.0), (5, None, 2, 1.0)], RECORDS)
    updates = models(spark, [("m1", "a", 1, 1.0), ("m2", "b", 1, 2.0), ("bad", "b", 2, None), ("m\\3", "it's", 1, 5.0)])
    few = serve_few(records, updates, ["x"], policy, most=most, keep=["record_id"])
    join = serve_latest(records, updates, [F.col("x")], policy, keep=["record_id"], forms=["linear"])
    assert sorted(few.collect()) == sorted(join.collect())
