import pytest
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.functions import scoring
from modelstream.operators import registry
from modelstream.schemas import params_struct
from modelstream.sources import tables

SCHEMA = "name string, data_type string, ts long, seq long, model binary"


def frame(spark, rows):
    return spark.createDataFrame([(n, d, t, i, bytearray(m)) for i, (n, d, t, m) in enumerate(rows)], SCHEMA)


MANY = [(f"m{i}", "ab"[i % 5 == 0], (i * 37) % 101, bytes([i // 4 % 3])) for i in range(120)]


@pytest.mark.parametrize("limits", [Limits(), Limits(rows_per_chunk=10)])
def test_changes_and_validity_do_not_depend_on_chunks(spark, limits):
    models = frame(spark, MANY)
    expected_changed, expected_until = {}, {}
    for kind in "ab":
        rows = sorted([(t, i, n, m) for i, (n, d, t, m) in enumerate(MANY) if d == kind])
        for at, (t, i, n, m) in enumerate(rows):
            expected_changed[n] = at == 0 or rows[at - 1][3] != m
            expected_until[n] = rows[at + 1][0] if at + 1 < len(rows) else None
    assert {r.name: r.changed for r in registry.payload_changes(models, limits).collect()} == expected_changed
    assert {r.name: r.valid_to for r in registry.model_validity(models, limits).collect()} == expected_until


def test_merge_history_and_rollback(spark):
    old = frame(spark, [("a1", "a", 1, b"x"), ("b1", "b", 1, b"x")])
    new = frame(spark, [("a2", "a", 5, b"y"), ("a3", "a", 6, b"y")])
    assert sorted(r.name for r in registry.merge_registry(old, new).collect()) == ["a3", "b1"]
    history = registry.model_history(old.unionByName(new), 2).collect()
    assert sorted((r.name, r["rank"]) for r in history) == [("a2", 2), ("a3", 1), ("b1", 1)]
    assert [r.name for r in registry.rolled_back(old.unionByName(new)).collect()] == ["a2"]
    assert sorted(r.name for r in registry.drop_unchanged(old.unionByName(new)).collect()) == ["a1", "a2", "b1"]


def test_register_a_kind(spark):
    def parser(models, text, names, out):
        return models.withColumn(out, F.when(F.col(text) == "twice", params_struct(form=F.lit("twice"))))

    kinds = registry.Kinds().register(7, parser, "twice", lambda x, p: x[0] * 2)
    models = spark.createDataFrame([(7, bytearray(b"twice")), (7, bytearray(b"other")), (8, bytearray(b"twice"))], "model_kind int, model binary")
    built = registry.build_models(models, ["x"], kinds)
    rows = built.select(scoring.score([F.lit(4.0)], F.col("params"), kinds.scorers).alias("s")).collect()
    assert [r.s for r in rows] == [8.0, None, None]
    with pytest.raises(ValueError):
        registry.Kinds({}).register(1, parser, "new form")
    with pytest.raises(ValueError):
        registry.build_models(models, ["x"], registry.Kinds({}))


def test_model_files_and_locations(spark, tmp_path):
    for name, body in (("one.pmml", "<a/>"), ("two.pmml", "<b/>"), ("notes.txt", "no")):
        (tmp_path / name).write_text(body)
    files = tables.read_model_files(spark, str(tmp_path))
    assert {r.name: bytes(r.model) for r in files.collect()} == {"one": b"<a/>", "two": b"<b/>"}
    path = files.filter("name = 'one'").first().path
    models = spark.createDataFrame(
        [("by location", bytearray(b""), path), ("inline", bytearray(b"x"), None), ("lost", bytearray(b""), "nowhere")],
        "name string, model binary, location string",
    )
    fetched = registry.fetch_locations(models, files.withColumnRenamed("model", "content"))
    assert {r.name: r.model and bytes(r.model) for r in fetched.collect()} == {"by location": b"<a/>", "inline": b"x", "lost": None}


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, rows_per_chunk=3)])
def test_a_kind_with_parameters_of_its_own(spark, folder, limits):
    """A document of any shape as parameters: built, saved, read back, served as of time and from the registry."""
    from modelstream.operators.serve import serve_asof, serve_latest

    def parser(models, text, names, out):
        own = F.try_parse_json(F.col(text))
        return models.withColumn(out, F.when(own.isNotNull(), F.struct(F.lit("table").alias("form"), own.alias("own"))))

    def scorer(x, p):
        weights = registry.own(p, "$.by.size", "map<string,double>")
        return F.coalesce(F.try_element_at(weights, x[0].cast("int").cast("string")), registry.own(p, "$.other", "double"))

    kinds = registry.Kinds().register(7, parser, "table", scorer, {"own": "variant"})
    documents = [("m1", "a", 1, '{"by": {"size": {"1": 10, "2": 20.5}}, "other": -1}'), ("m2", "a", 5, '{"other": 7}'), ("m3", "a", 9, "{no"), ("m4", "b", 2, "3")]
    models = spark.createDataFrame(documents, "name string, data_type string, ts long, model string").select(
        "name", "data_type", F.lit(7).alias("model_kind"), F.col("model").cast("binary").alias("model"), "ts", F.col("ts").alias("seq")
    )
    saved = registry.save_models(registry.build_models(models, ["x"], kinds), f"{folder}/saved")
    assert [r.name for r in saved.filter("params IS NULL").collect()] == ["m3"]
    records = spark.createDataFrame(
        [(1, "a", 1, 1.0), (2, "a", 4, 2.0), (3, "a", 4, 3.0), (4, "a", 6, 1.0), (5, "a", 99, 2.0), (6, "b", 3, 1.0)],
        "record_id int, data_type string, ts long, x double",
    )
    options = {"keep": ["record_id"], "forms": {"table": kinds.scorers["table"]}, "limits": limits}
    strategy = "auto" if limits.broadcast_rows else "chunked"
    served = serve_asof(records, saved, [F.col("x")], strategy=strategy, **options)
    assert {r.record_id: (r.name, r.result) for r in served.collect()} == {
        1: ("m1", 10.0), 2: ("m1", 20.5), 3: ("m1", -1.0), 4: ("m2", 7.0), 5: ("m2", 7.0), 6: ("m4", None)}
    latest = serve_latest(records, saved, [F.col("x")], **options)
    assert {r.record_id: r.result for r in latest.collect()} == {1: 7.0, 2: 7.0, 3: 7.0, 4: 7.0, 5: 7.0, 6: None}


def test_own_parameters_do_not_clash():
    parser = lambda models, text, names, out: models
    kinds = registry.Kinds().register(7, parser, fields={"own": "variant"}).register(8, parser, fields={"own": "variant", "depth": "int"})
    assert kinds.fields == {"own": "variant"}
    with pytest.raises(ValueError, match="own"):
        kinds.register(9, parser, fields={"own": "string"})
