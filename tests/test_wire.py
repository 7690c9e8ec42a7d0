import base64
import json

from pyspark.sql import functions as F

from modelstream.functions import text
from modelstream.operators import wire

GOOD = {"record_id": 1, "data_type": "wine", "ts": 5, "features": [1.0, 2.5]}


def messages(spark, *values):
    rows = [(i, bytearray(v if isinstance(v, bytes) else json.dumps(v).encode())) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, value binary")


def test_records(spark):
    frame = messages(spark, GOOD, {}, b"{cut", b"", b"\xff\xfe", {"ts": "soon"})
    rows = frame.select("i", wire.decode_record(F.col("value")).alias("r")).orderBy("i").collect()
    assert rows[0].r.asDict() == GOOD
    assert rows[1].r.asDict() == {"record_id": 0, "data_type": "", "ts": 0, "features": []}
    assert [r.r is None for r in rows[2:]] == [True] * 4
    whole = frame.select(wire.decode_record_or_default(F.col("value")).alias("r")).collect()
    assert whole[2].r.data_type == "" and whole[2].r.features == []
    assert wire.decodable(frame, wire.decode_record).count() == 2
    assert sorted(r.i for r in wire.quarantine(frame, wire.decode_record).collect()) == [2, 3, 4, 5]


def test_models(spark):
    payload = base64.b64encode(b"<x/>").decode()
    frame = messages(
        spark,
        {"name": "m", "description": "d", "data_type": "wine", "model_kind": 2, "data": payload, "ts": 3},
        {"name": "m", "model_kind": 1, "location": "there"},
        {"name": "m", "data": "not base64!"},
        {"name": "m", "model_kind": 9, "data": payload},
        b"nothing",
    )
    rows = [r.m for r in frame.select("i", wire.decode_model(F.col("value")).alias("m")).orderBy("i").collect()]
    assert bytes(rows[0].model) == b"<x/>" and rows[0].location is None
    assert bytes(rows[1].model) == b"" and rows[1].location == "there"
    assert rows[2] is None and rows[4] is None
    assert rows[3].model_kind == 9


def test_sql_functions_agree_with_the_columns(spark):
    wire.register_decoders(spark)
    payload = base64.b64encode(b"<x/>").decode()
    records = messages(spark, GOOD, {}, b"{cut")
    models = messages(spark, {"name": "m", "model_kind": 2, "data": payload}, {"location": "x"}, {"data": "?"}, b"")
    for frame, call, column in (
        (records, "deserialize_record(value)", wire.data_envelope(wire.decode_record(F.col("value")))),
        (models, "deserialize_model(value)", wire.model_envelope(wire.decode_model(F.col("value")))),
    ):
        part = "data" if frame is records else "model"
        rows = frame.select(F.expr(call).alias("a"), column.alias("b")).collect()
        for r in rows:
            assert (r.a and r.a[part]) == r.b[part]


def test_envelopes_keep_both_sides(spark):
    payload = base64.b64encode(b"<x/>").decode()
    both = wire.envelopes(
        messages(spark, GOOD, b"{cut", {"ts": 1}), messages(spark, {"name": "m", "data_type": "wine", "data": payload}, b"")
    )
    records, models = wire.split_envelopes(both)
    assert [r.record_id for r in records.collect()] == [1]
    assert [r.name for r in models.collect()] == ["m"]


def test_encoding_round_trip(spark):
    rows = spark.createDataFrame([(1, "wine", 5, [1.0, 2.5])], "record_id long, data_type string, ts long, features array<double>")
    encoded = rows.select(wire.encode_record(*[F.col(c) for c in rows.columns]).alias("value"))
    assert wire.decodable(encoded, wire.decode_record).collect() == rows.collect()


def test_text_functions(spark):
    row = spark.range(1).select(
        text.model_name(F.lit("/a/b/wine model.pmml")).alias("name"),
        text.split_fields(F.lit(" 1 ; 2;x ")).alias("fields"),
        text.kind_name(F.lit(1)).alias("kind"),
        text.kind_name(F.lit(7)).alias("none"),
        text.kind_code(F.lit("PMML")).alias("code"),
        text.result_line(F.lit(30), F.lit(6.0), F.lit("m"), F.lit("wine")).alias("line"),
        text.report_line(F.lit("n"), F.lit("d"), F.lit(0), F.lit(0.26531), F.lit(0), F.lit(5)).alias("report"),
    ).first()
    assert row.name == "wine model" and row.fields == ["1", "2", "x"]
    assert (row.kind, row.none, row.code) == ("TENSORFLOWSAVED", None, 2)
    assert row.line == "Model served in 30 ms, with result 6.0 (model m, data type wine)"
    assert row.report == f"| {'n':<50} | {'d':<38} | 1970/01/01 00:00:00 |  0.26531 |   0 |   5 |"
    assert [len(line) for line in text.report_header()] == [len(row.report)] * 2


def test_envelopes_of_bad_messages(spark):
    """Dropped, or passed with the empty type for the policy to answer: one result for each record message."""
    from modelstream.operators.serve import Policy, serve_latest
    from modelstream.schemas import BAD_INPUT, linear_params

    records = messages(spark, GOOD, b"{cut", {"record_id": 4}, b"\xff").select("value")
    models = messages(spark, {"name": "m", "data_type": "wine", "model_kind": 2, "ts": 1}, {"name": "no type"}, b"?").select("value")
    for bad_input, types in (("drop", ["wine"]), ("mark", ["", "", "", "wine"])):
        rows = wire.envelopes(records, models, bad_input=bad_input)
        data, built = wire.split_envelopes(rows)
        assert sorted(r.data_type for r in data.collect()) == types
        assert [r.name for r in built.collect()] == ["m"]
        built = built.withColumns({"seq": F.col("ts"), "params": linear_params(F.lit(1.0), [F.lit(1.0)])})
        served = serve_latest(data, built, [F.get("features", 0)], Policy(bad_input=bad_input), forms=["linear"])
        assert sorted(r.name for r in served.collect()) == [BAD_INPUT] * (len(types) - 1) + ["m"]


def test_the_order_of_arrival_goes_with_the_models(spark):
    """Of two models of one time the last to arrive counts, also where its name sorts first."""
    from modelstream.operators.registry import latest_models

    sent = [{"name": name, "data_type": "wine", "model_kind": 2, "ts": 7} for name in ("m9", "m5", "m10")]
    both = wire.envelopes(messages(spark, GOOD), messages(spark, *sent), arrival="i")
    records, models = wire.split_envelopes(both)
    assert records.columns == ["record_id", "data_type", "ts", "features"] and records.count() == 1
    assert sorted((r.seq, r.name) for r in models.collect()) == [(0, "m9"), (1, "m5"), (2, "m10")]
    assert [r.name for r in latest_models(models).collect()] == ["m10"]
