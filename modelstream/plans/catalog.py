"""The registered batch queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modelstream.config import Limits, work_folder
from modelstream.functions import compiled, features, remote, text
from modelstream.operators import blocks, registry, stats, wire
from modelstream.operators.external import batch_score
from modelstream.operators.serve import Policy, serve_asof, serve_few, serve_latest
from modelstream.plans import bindings as b
from modelstream.plans import fixtures
from modelstream.schemas import KIND_DOCUMENT, KIND_GRAPH
from modelstream.sources import sinks, tables
from modelstream.sources.documents import parse_document
from modelstream.sources.models import load_model

# The elements of the embeddings as SQL expressions.
VECTOR = [f"get(embedding, {i})" for i in range(fixtures.WIDTH)]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed time the latency queries measure against: 2024-02-01 00:00:00 UTC.
NOW_MS = 1_706_745_600_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- serving ------------------------------------------------------------------------------------------------------


def _served(spark: SparkSession, sf: str, policy: Policy = Policy(), **options) -> DataFrame:
    options = {"keep": ["record_id"], "forms": ["linear"], **options}
    return serve_asof(b.records(spark, sf), b.models(spark, sf), b.inputs(), policy, **options)


def _results(served: DataFrame) -> DataFrame:
    return rounded(served.select("record_id", "name", "data_type", "submission_ts", "result"), "result")


@query
def serve_asof_auto(spark: SparkSession, sf: str) -> DataFrame:
    return _results(_served(spark, sf))


QUERIES["serve_asof"] = QUERIES.pop("serve_asof_auto")


@query
def serve_asof_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Broadcast validity intervals: the records are not shuffled. Models too large or crowded for it go by chunks."""
    return _results(_served(spark, sf, strategy="auto"))


@query
def serve_asof_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """One shuffle on (type, chunk of time), with chunks small enough to be many on the test tables."""
    return _results(_served(spark, sf, strategy="chunked", limits=Limits(rows_per_chunk=2000)))


@query
def serve_asof_mark(spark: SparkSession, sf: str) -> DataFrame:
    return _results(_served(spark, sf, Policy(no_model="mark")))


@query
def serve_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    served = serve_latest(
        b.records(spark, sf),
        b.models(spark, sf),
        b.inputs(),
        keep=["record_id"],
        forms=["linear"],
        spread=F.col("record_id"),
    )
    return _results(served)


@query
def serve_salted(spark: SparkSession, sf: str) -> DataFrame:
    """As serve_broadcast beyond the broadcast limits: both sides shuffled, heavy types dealt over salts by their share."""
    served = serve_latest(
        b.records(spark, sf),
        b.models(spark, sf),
        b.inputs(),
        keep=["record_id"],
        forms=["linear"],
        spread=F.col("record_id"),
        limits=Limits(broadcast_rows=0),
    )
    return _results(served)


@query
def serve_models_first(spark: SparkSession, sf: str) -> DataFrame:
    """A day is a batch: its models apply before its records, the last one wins."""
    day = F.floor(F.col("ts") / b.DAY_MS).cast("bigint")
    served = serve_asof(
        b.records(spark, sf).withColumn("batch", day),
        b.models(spark, sf).withColumn("batch", day),
        b.inputs(),
        order="models_first",
        keep=["record_id"],
        forms=["linear"],
    )
    return _results(served)


def _bad_models(spark: SparkSession, sf: str, on_bad_model: str) -> DataFrame:
    models = registry.save_models(registry.build_models(b.model_documents(spark, sf), ["value", "k"]))
    served = serve_asof(
        b.records(spark, sf),
        models,
        b.inputs(),
        Policy(on_bad_model=on_bad_model),
        keep=["record_id"],
        forms=["linear"],
    )
    return _results(served)


@query
def bad_model_keep(spark: SparkSession, sf: str) -> DataFrame:
    return _bad_models(spark, sf, "keep_old")


@query
def bad_model_clear(spark: SparkSession, sf: str) -> DataFrame:
    return _bad_models(spark, sf, "clear")


@query
def results_per_type_top(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best results of each type as one list per type, and the list flattened again."""
    order = Window.partitionBy("data_type").orderBy(F.col("result").desc(), "record_id")
    best = _results(_served(spark, sf)).withColumn("rank", F.row_number().over(order)).filter("rank <= 10")
    lists = best.groupBy("data_type").agg(
        F.sort_array(F.collect_list(F.struct("rank", "record_id", "name", "result"))).alias("value")
    )
    return lists.select("data_type", F.explode("value").alias("value")).select("data_type", "value.*")


@query
def display_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The ten rows a display shows, under a total order."""
    return _results(_served(spark, sf)).orderBy(F.col("submission_ts").desc(), F.col("record_id").desc()).limit(10)


@query
def result_lines(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.result_lines(_results(_served(spark, sf)), F.lit(NOW_MS)).withColumnRenamed("value", "line")


@query
def latency(spark: SparkSession, sf: str) -> DataFrame:
    return _served(spark, sf).select(
        "record_id", text.latency_ms(F.col("submission_ts"), F.lit(NOW_MS)).alias("latency_ms")
    )


# --- registry -----------------------------------------------------------------------------------------------------


@query
def model_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to parameters; broken ones have none."""
    built = registry.build_models(b.model_documents(spark, sf), ["value", "k"])
    return built.select(
        "name", "params.form", "params.intercept", F.get("params.coefs", 0).alias("coef"), "data_type"
    )


@query
def kind_lookup(spark: SparkSession, sf: str) -> DataFrame:
    documents = b.model_documents(spark, sf)
    yes = registry.supported(documents).select("name", F.lit("supported").alias("verdict"), "model_kind")
    no = registry.unsupported(documents).select("name", F.lit("rejected").alias("verdict"), "model_kind")
    return yes.unionByName(no).withColumn("kind", text.kind_name(F.col("model_kind")))


@query
def payload_guard(spark: SparkSession, sf: str) -> DataFrame:
    return registry.with_payload(b.model_documents(spark, sf)).select(
        "name", F.length("model").alias("bytes"), F.sha2("model", 256).alias("digest")
    )


@query
def registry_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The registry after the sign-ups of small value, updated with the others."""
    models = b.models(spark, sf)
    current = registry.latest_models(models.filter(F.col("params.intercept") < 50))
    merged = registry.merge_registry(current, models.filter(F.col("params.intercept") >= 50))
    return merged.select("data_type", "name", "ts", F.col("params.intercept").alias("intercept"))


@query
def model_validity(spark: SparkSession, sf: str) -> DataFrame:
    return registry.model_validity(b.models(spark, sf)).select("name", "data_type", "ts", "valid_to")


@query
def model_history(spark: SparkSession, sf: str) -> DataFrame:
    return registry.model_history(b.models(spark, sf), 3).select("name", "data_type", "ts", "rank")


@query
def model_rollback(spark: SparkSession, sf: str) -> DataFrame:
    return registry.rolled_back(b.models(spark, sf)).select("name", "data_type", "ts")


@query
def model_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads that often repeat: is a model equal to the one it replaces?"""
    payload = F.concat(F.lit("payload "), F.floor(F.col("k") / 50).cast("string")).cast("binary")
    models = b.signups(spark, sf).select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("name"),
        "data_type",
        "ts",
        F.col("event_id").alias("seq"),
        payload.alias("model"),
    )
    return registry.payload_changes(models).select("name", "data_type", "ts", "digest", "changed")


# --- scoring ------------------------------------------------------------------------------------------------------


def _score_lines(spark: SparkSession, sf: str, document: str) -> DataFrame:
    params = load_model(spark, document, b.LINE_NAMES)
    return compiled.with_score(b.lines(spark, sf), b.LINE_COLUMNS, params)


@query
def linear_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_score_lines(spark, sf, fixtures.LINEAR).select("l_orderkey", "l_linenumber", "result"), "result")


@query
def glm_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_score_lines(spark, sf, fixtures.GLM_LOG).select("l_orderkey", "l_linenumber", "result"), "result")


@query
def tree_reg(spark: SparkSession, sf: str) -> DataFrame:
    return _score_lines(spark, sf, fixtures.TREE_REGRESSION).select("l_orderkey", "l_linenumber", "result")


def _class_shares(df: DataFrame) -> list:
    return [F.round(F.get("result_probs", i), 6).alias(f"p_{c}") for i, c in enumerate(fixtures.CLASSES)]


@query
def tree_class(spark: SparkSession, sf: str) -> DataFrame:
    scored = _score_lines(spark, sf, fixtures.TREE_CLASSES)
    return scored.select("l_orderkey", "l_linenumber", "result", *_class_shares(scored))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    sold = (
        b.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_quantity").alias("sold"), F.count(F.lit(1)).alias("lines"))
    )
    return b.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice").join(sold, "p_partkey", "left")


@query
def forest_class(spark: SparkSession, sf: str) -> DataFrame:
    params = load_model(spark, fixtures.FOREST, fixtures.PART_NAMES)
    scored = compiled.with_score(_parts(spark, sf), ["p_size", "p_retailprice", "sold", "lines"], params)
    return scored.select("p_partkey", "result", *_class_shares(scored))


@query
def mlp_class(spark: SparkSession, sf: str) -> DataFrame:
    params = load_model(spark, fixtures.NETWORK, fixtures.VECTOR_NAMES)
    rows = b.table(spark, sf, "embeddings").select("vec_id", "embedding")
    scored = compiled.with_score(rows, VECTOR, params)
    return scored.select("vec_id", "result", *_class_shares(scored))


@query
def dense_argmax(spark: SparkSession, sf: str) -> DataFrame:
    params = load_model(spark, fixtures.DENSE, fixtures.VECTOR_NAMES)
    rows = b.table(spark, sf, "embeddings").select("vec_id", "embedding")
    scored = compiled.with_score(rows, VECTOR, params)
    return scored.select("vec_id", "result", F.round(F.array_max("result_probs"), 6).alias("best"))


def _models_by_key(spark: SparkSession, names: list[str], *rows: tuple[str, int, str]) -> DataFrame:
    """Built models (key, kind, document)."""
    descriptors = spark.createDataFrame(list(rows), "key string, model_kind int, model string")
    built = registry.build_models(descriptors.withColumn("model", F.col("model").cast("binary")), names)
    return registry.save_models(built)


def _vectors(spark: SparkSession, sf: str, key: Column) -> DataFrame:
    rows = b.table(spark, sf, "embeddings")
    return rows.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), key.alias("key"))


@query
def mlp_class_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """One matrix product per layer and block of rows."""
    models = _models_by_key(spark, fixtures.VECTOR_NAMES, ("mlp", KIND_DOCUMENT, fixtures.NETWORK))
    scored = blocks.score_blocks(_vectors(spark, sf, F.lit("mlp")), models, "key", "x")
    return scored.select("vec_id", "result", *_class_shares(scored))


@query
def dense_argmax_blocks(spark: SparkSession, sf: str) -> DataFrame:
    models = _models_by_key(spark, fixtures.VECTOR_NAMES, ("dense", KIND_GRAPH, fixtures.DENSE))
    scored = blocks.score_blocks(_vectors(spark, sf, F.lit("dense")), models, "key", "x")
    return scored.select("vec_id", "result", F.round(F.array_max("result_probs"), 6).alias("best"))


@query
def network_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions, one with two thirds of the rows, as if their parameters were too large to be broadcast."""
    models = _models_by_key(
        spark, fixtures.VECTOR_NAMES, ("mlp", KIND_DOCUMENT, fixtures.NETWORK), ("dense", KIND_GRAPH, fixtures.DENSE)
    )
    rows = _vectors(spark, sf, F.when(F.col("vec_id") % 3 == 0, "dense").otherwise("mlp"))
    scored = blocks.score_blocks(rows, models, "key", "x", spread=F.col("vec_id"), limits=Limits(broadcast_rows=0))
    return scored.select("vec_id", F.col("key").alias("version"), "result")


@query
def forest_class_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The leaves of a forest by bit vectors, without walking its nodes."""
    models = _models_by_key(spark, fixtures.PART_NAMES, ("forest", KIND_DOCUMENT, fixtures.FOREST))
    rows = _parts(spark, sf).select(
        "p_partkey",
        F.lit("forest").alias("key"),
        F.array(*[F.col(c).cast("double") for c in ("p_size", "p_retailprice", "sold", "lines")]).alias("x"),
    )
    scored = blocks.score_blocks(rows, models, "key", "x")
    return scored.select("p_partkey", "result", *_class_shares(scored))


@query
def serve_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """As serve_asof: the version in force is joined, its parameters never are."""
    served = blocks.serve_blocks(
        b.records(spark, sf), b.models(spark, sf), F.array("value", "k"), keep=["record_id"]
    )
    return _results(served)


# A kind whose parameters have no place in the common struct: levels between knots, as a document.
KIND_STEPS = 7


def _parse_steps(models: DataFrame, text: str, names: list[str], out: str) -> DataFrame:
    own = F.try_parse_json(F.col(text))
    whole = F.try_variant_get(own, "$.levels", "array<double>").isNotNull()
    return models.withColumn(out, F.when(whole, F.struct(F.lit("steps").alias("form"), own.alias("own"))))


def _score_steps(x: list[Column], p: Column) -> Column:
    knots, levels = (registry.own(p, f"$.{name}", "array<double>") for name in ("knots", "levels"))
    return F.get(levels, F.size(F.filter(knots, lambda k: k <= x[0])))


STEPS = registry.Kinds().register(KIND_STEPS, _parse_steps, "steps", _score_steps, {"own": "variant"})


def _step_models(spark: SparkSession, sf: str) -> DataFrame:
    document = F.to_json(
        F.struct(
            F.array(F.col("value") / 2, F.col("value")).alias("knots"),
            F.array(F.lit(0.5), 10 * (F.col("k") / 100.0), 100 * (F.col("k") / 100.0)).alias("levels"),
        )
    )
    descriptors = b.signups(spark, sf).select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("name"),
        F.lit("levels between knots").alias("description"),
        "data_type",
        F.lit(KIND_STEPS).alias("model_kind"),
        document.cast("binary").alias("model"),
        "ts",
        F.col("event_id").alias("seq"),
    )
    return registry.save_models(registry.build_models(descriptors, ["value", "k"], STEPS))


@query
def own_kind_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Models of a kind of the caller's own, as of the time of the record."""
    scorers = {"steps": STEPS.scorers["steps"]}
    return _results(
        serve_asof(b.records(spark, sf), _step_models(spark, sf), b.inputs(), keep=["record_id"], forms=scorers)
    )


@query
def own_kind_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the registry: the newest model of each type."""
    scorers = {"steps": STEPS.scorers["steps"]}
    return _results(
        serve_latest(b.records(spark, sf), _step_models(spark, sf), b.inputs(), keep=["record_id"], forms=scorers)
    )


def _three_models(spark: SparkSession) -> DataFrame:
    dense = fixtures.layers_document(
        [([[0.1, 0.0, -2.0, 1.0], [0.05, 0.00001, 3.0, -1.0], [-0.02, 0.00002, 0.0, 4.0]], [0.0, 0.2, 0.4], "sigmoid")]
    )
    descriptors = spark.createDataFrame(
        [
            ("lines linear", "A", KIND_DOCUMENT, fixtures.LINEAR, 1, 1),
            ("lines tree", "N", KIND_DOCUMENT, fixtures.TREE_REGRESSION, 1, 2),
            ("lines dense", "R", KIND_GRAPH, dense, 1, 3),
        ],
        "name string, data_type string, model_kind int, model string, ts bigint, seq bigint",
    ).withColumn("model", F.col("model").cast("binary"))
    return registry.save_models(registry.build_models(descriptors, b.LINE_NAMES))


def _typed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *b.LINE_COLUMNS,
        F.col("l_returnflag").alias("data_type"),
        F.lit(0).cast("bigint").alias("ts"),
    )


@query
def score_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Models of three forms, chosen by the return flag of the line, scored in one pass as data."""
    served = serve_latest(
        _typed_lines(spark, sf),
        _three_models(spark),
        b.line_features(),
        keep=["l_orderkey", "l_linenumber"],
        forms=["linear", "tree", "dense"],
    )
    return rounded(served.select("l_orderkey", "l_linenumber", "name", "result"), "result")


@query
def score_dispatch_compiled(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the three models written into the plan."""
    served = serve_few(
        _typed_lines(spark, sf), _three_models(spark), b.LINE_COLUMNS, keep=["l_orderkey", "l_linenumber"]
    )
    return rounded(served.select("l_orderkey", "l_linenumber", "name", "result"), "result")


@query
def batch_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """An external scorer called with a matrix of many records."""
    rows = b.records(spark, sf).select("record_id", F.array("value", "k").alias("features"))

    def external(matrix: np.ndarray) -> np.ndarray:
        return matrix[:, 0] + matrix[:, 0] * matrix[:, 1] / 100.0

    return rounded(batch_score(rows, "features", external).drop("features"), "result")


@query
def predict_request(spark: SparkSession, sf: str) -> DataFrame:
    """Request bodies, read back: what they ask for."""
    bodies = b.table(spark, sf, "embeddings").select(
        "vec_id", remote.predict_request(F.col("embedding")).alias("body")
    )
    read = F.from_json("body", "struct<signature_name:string,instances:array<struct<inputs:array<double>>>>")
    inputs = F.get(F.get("r.instances", 0).getField("inputs"), F.lit(0))
    weighed = F.transform(F.get("r.instances", 0).getField("inputs"), lambda v, i: v * (i + 1))
    return bodies.select("vec_id", read.alias("r")).select(
        "vec_id",
        F.col("r.signature_name").alias("signature"),
        F.size("r.instances").cast("bigint").alias("instances"),
        F.size(F.get("r.instances", 0).getField("inputs")).cast("bigint").alias("width"),
        F.round(inputs, 6).alias("first_input"),
        F.round(F.aggregate(weighed, F.lit(0.0), lambda s, v: s + v), 4).alias("weighed_inputs"),
    )


@query
def predict_response(spark: SparkSession, sf: str) -> DataFrame:
    """Response bodies with the vector as scores: the best class of each."""
    body = F.to_json(F.struct(F.array(F.col("embedding").cast("array<double>")).alias("predictions")))
    bodies = b.table(spark, sf, "embeddings").select("vec_id", body.alias("body"))
    return bodies.select(
        "vec_id",
        F.size(remote.first_prediction(F.col("body"))).cast("bigint").alias("scores"),
        remote.predicted_class(F.col("body")).alias("result"),
    )


@query
def field_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The input each line names, 0.0 for a name nobody knows."""
    rows = b.table(spark, sf, "lineitem")
    wanted = (
        F.when(F.col("l_returnflag") == "A", "quantity").when(F.col("l_returnflag") == "N", "tax").otherwise("colour")
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        features.value_by_name(b.LINE_NAMES, b.line_features(), wanted).alias("input"),
    )


# --- statistics ---------------------------------------------------------------------------------------------------


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Served records; `k` stands for the time scoring took."""
    return _served(spark, sf, keep=["record_id", "k"]).withColumnRenamed("k", "duration")


def _timed_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a written table: running statistics read their input several times."""
    target = work_folder(spark, "served")
    served = _timed(spark, sf)
    served.write.parquet(target)
    return spark.read.schema(served.schema).parquet(target)


@query
def stats_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(stats.stats_by_model(_timed(spark, sf)), "average")


@query
def stats_running(spark: SparkSession, sf: str) -> DataFrame:
    return stats.running_stats(_timed_table(spark, sf)).select(
        "record_id", "data_type", "name", "run_usage", "run_duration", "run_min", "run_max"
    )


@query
def stats_running_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """Running statistics per type rather than per model: few groups, each cut into chunks."""
    per_type = _timed_table(spark, sf).withColumns({"name": F.lit("all"), "since": F.lit(0).cast("bigint")})
    return stats.running_stats(per_type, limits=Limits(rows_per_chunk=1000)).select(
        "record_id", "data_type", "run_usage", "run_duration", "run_min", "run_max"
    )


@query
def processors(spark: SparkSession, sf: str) -> DataFrame:
    return stats.processors(b.records(spark, sf), b.models(spark, sf))


def _current(spark: SparkSession, sf: str) -> DataFrame:
    return stats.current_stats(
        registry.latest_models(b.models(spark, sf)), stats.stats_by_model(_timed(spark, sf))
    )


def wanted_types(spark: SparkSession, sf: str) -> DataFrame:
    """Seven types, two of which nobody has heard of."""
    return b.table(spark, sf, "events").select((F.col("user_id") % 7).cast("string").alias("data_type")).distinct()


@query
def state_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return stats.state_of(wanted_types(spark, sf), _current(spark, sf))


@query
def stats_report(spark: SparkSession, sf: str) -> DataFrame:
    lookup = stats.state_of(wanted_types(spark, sf), _current(spark, sf))
    reported = stats.report(lookup)
    return rounded(
        reported.select("data_type", "name", "kind", "usage", F.nanvl("average", F.lit(None)).alias("average"), "line"),
        "average",
    )


@query
def remote_state(spark: SparkSession, sf: str) -> DataFrame:
    return stats.remote_state(_timed(spark, sf))


# --- messages -----------------------------------------------------------------------------------------------------


def record_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every record as a message; those of error events are cut short."""
    events = b.base(spark, sf).filter("event_type <> 'signup'")
    whole = wire.encode_record(
        F.col("event_id").alias("record_id"),
        F.col("data_type"),
        F.col("ts"),
        F.array("value", "k").alias("features"),
    )
    broken = F.substring(whole.cast("string"), 1, 20).cast("binary")
    return events.select(
        "event_id", "event_type", F.when(F.col("event_type") == "error", broken).otherwise(whole).alias("value")
    )


def model_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every model as a message: `k` under 10 cut short, from 50 on by location instead of payload."""
    documents = b.model_documents(spark, sf).join(
        b.signups(spark, sf).select(F.col("event_id").alias("seq"), "k"), "seq"
    )
    by_location = F.col("k") >= 50
    whole = wire.encode_model(
        F.col("name"),
        F.col("description"),
        F.col("data_type"),
        F.col("model_kind"),
        F.when(~by_location, F.col("model")),
        F.concat(F.lit("models/"), F.col("name")),
        F.col("ts"),
    )
    broken = F.substring(whole.cast("string"), 1, 25).cast("binary")
    return documents.select(
        F.col("seq").alias("event_id"), F.when(F.col("k") < 10, broken).otherwise(whole).alias("value")
    )


@query
def decode_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = wire.decodable(record_messages(spark, sf), wire.decode_record)
    return rows.select("record_id", "data_type", "ts", F.get("features", 0).alias("value"), F.get("features", 1).alias("k"))


@query
def decode_records_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the SQL function."""
    wire.register_decoders(spark)
    rows = record_messages(spark, sf).selectExpr("deserialize_record(value) AS data").filter("data IS NOT NULL")
    return rows.select("data.data_type", "data.data").select(
        "data.record_id",
        "data_type",
        "data.ts",
        F.get("data.features", 0).alias("value"),
        F.get("data.features", 1).alias("k"),
    )


@query
def decode_or_default(spark: SparkSession, sf: str) -> DataFrame:
    """Broken messages become empty records, which serving names as bad input."""
    rows = record_messages(spark, sf).select(
        "event_id", wire.decode_record_or_default(F.col("value")).alias("r")
    )
    served = serve_latest(
        rows.select("event_id", "r.*"),
        b.models(spark, sf),
        [F.get("features", 0), F.get("features", 1)],
        Policy(no_model="mark", bad_input="mark"),
        keep=["event_id"],
        forms=["linear"],
        spread=F.col("event_id"),
    )
    return rounded(served.select("event_id", "name", "data_type", "submission_ts", "result"), "result")


@query
def decode_models(spark: SparkSession, sf: str) -> DataFrame:
    rows = wire.decodable(model_messages(spark, sf), wire.decode_model)
    return rows.select(
        "name",
        "description",
        "data_type",
        "model_kind",
        text.kind_name(F.col("model_kind")).alias("kind"),
        F.length("model").cast("bigint").alias("bytes"),
        "location",
        "ts",
    )


@query
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    records = wire.quarantine(record_messages(spark, sf), wire.decode_record)
    models = wire.quarantine(model_messages(spark, sf), wire.decode_model)
    return records.select("event_id", F.lit("record").alias("stream")).unionByName(
        models.select("event_id", F.lit("model").alias("stream"))
    )


@query
def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Both message streams through one envelope stream and apart again; models score as before."""
    both = wire.envelopes(record_messages(spark, sf), model_messages(spark, sf))
    records, models = wire.split_envelopes(both)
    built = registry.build_models(models, ["value", "k"])
    scored = F.col("params.intercept") + 2.0 * F.get("params.coefs", 0)
    return records.select(
        F.lit("record").alias("side"),
        F.col("record_id").cast("string").alias("name"),
        "data_type",
        "ts",
        F.round(F.get("features", 0), 6).alias("amount"),
    ).unionByName(
        built.select(F.lit("model").alias("side"), "name", "data_type", "ts", F.round(scored, 6).alias("amount"))
    )


# --- files --------------------------------------------------------------------------------------------------------


def _delimited(spark: SparkSession, sf: str, name: str, ordered: bool = False) -> str:
    """The parts as delimited text with blanks around the values and one column too many; `ordered` by key over the files."""
    target = work_folder(spark, name)
    line = F.concat_ws(" ; ", *[F.col(c).cast("string") for c in ("p_partkey", "p_size", "p_retailprice", "p_brand")])
    parts = b.table(spark, sf, "part")
    (parts.orderBy("p_partkey") if ordered else parts).select(line.alias("value")).write.text(target)
    return target


@query
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_delimited(
        spark, _delimited(spark, sf, "csv"), ["part_key", "size", "price"], tag="part"
    )


@query
def csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same by splitting lines, with their numbers over all files, last line first."""
    path = _delimited(spark, sf, "lines", ordered=True)
    rows = tables.read_delimited_lines(spark, path, ["part_key", "size", "price"], tag="part", numbered=True)
    return tables.replay_order(rows.drop("line"), "number")


@query
def model_files(spark: SparkSession, sf: str) -> DataFrame:
    """One document per brand, computed from its parts, written as files and parsed from them."""
    brand = F.regexp_replace("p_brand", "[^0-9]", "")
    document = F.format_string(
        '<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><RegressionModel functionName="regression">'
        '<RegressionTable intercept="%s"><NumericPredictor name="size" coefficient="%s"/></RegressionTable>'
        "</RegressionModel></PMML>",
        F.count(F.lit(1)).cast("double").cast("string"),
        F.max("p_size").cast("double").cast("string"),
    )
    target = work_folder(spark, "documents")
    documents = b.table(spark, sf, "part").groupBy(brand.alias("brand")).agg(document.alias("value"))
    documents.write.partitionBy("brand").text(target)
    files = tables.read_model_files(spark, target, suffix="txt")
    read = parse_document(files.withColumn("text", F.col("model").cast("string")), "text", ["size"], "params")
    return read.select(
        F.regexp_extract("path", "brand=([0-9]+)", 1).alias("brand"),
        F.col("name").startswith("part-").alias("named"),
        "params.form",
        "params.intercept",
        F.get("params.coefs", 0).alias("coef"),
    )


@query
def publish_read(spark: SparkSession, sf: str) -> DataFrame:
    """Record messages published with a key and read back."""
    target = work_folder(spark, "messages")
    rows = record_messages(spark, sf)
    sinks.publish(sinks.messages(rows, F.col("value"), F.col("event_id").cast("string")), target)
    back = spark.read.schema("key binary, value binary").parquet(target)
    return back.select(
        F.col("key").cast("string").alias("key"),
        F.length("value").cast("bigint").alias("bytes"),
        F.sha2("value", 256).alias("digest"),
    )
