"""The model table: building, rejecting, merging and comparing models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelstream.config import Limits, work_folder
from modelstream.functions.scoring import SCORERS, Scorer
from modelstream.functions.text import payload_digest
from modelstream.plans import chunks
from modelstream.schemas import KIND_BUNDLE, KIND_DOCUMENT, KIND_GRAPH, PARAM_FIELDS
from modelstream.sources.documents import parse_document, parse_layers

# Adds a PARAMS column to a model table: (models, payload column as text, input names, output column) -> models.
Parser = Callable[[DataFrame, str, list[str], str], DataFrame]


@dataclass(frozen=True)
class Kinds:
    """Which model kinds can be built, how each form is scored, and what parameters kinds have beside the common ones.
    `register` returns an extended copy."""

    parsers: dict[int, Parser] = field(
        default_factory=lambda: {
            KIND_GRAPH: parse_layers,
            KIND_BUNDLE: parse_layers,
            KIND_DOCUMENT: parse_document,
        }
    )
    scorers: dict[str, Scorer] = field(default_factory=lambda: dict(SCORERS))
    fields: dict[str, str] = field(default_factory=dict)

    def register(
        self,
        code: int,
        parser: Parser,
        form: str | None = None,
        scorer: Scorer | None = None,
        fields: dict[str, str] | None = None,
    ) -> Kinds:
        """These kinds plus one: `parser` builds its parameters, `scorer` evaluates those of a new `form`.

        Parameters that the common struct has no place for go into `fields` of the kind's own (name to type; ``variant`` holds
        any document, read with `own`). The parser gives a struct with ``form`` and whatever fields it sets.
        """
        scorers = dict(self.scorers)
        if form is not None:
            if scorer is None:
                raise ValueError(f"form {form!r} needs a scorer")
            scorers[form] = scorer
        clash = set(fields or {}) & {*PARAM_FIELDS, *self.fields}
        if any({**PARAM_FIELDS, **self.fields}[name] != fields[name] for name in clash):
            raise ValueError(f"parameters {sorted(clash)} exist with another type")
        added = {name: kind for name, kind in (fields or {}).items() if name not in PARAM_FIELDS}
        return Kinds({**self.parsers, code: parser}, scorers, {**self.fields, **added})

    def params(self, parsed: Column, present: list[str]) -> Column:
        """A parser's struct, which has the fields `present`, as the struct all kinds share; null stays null."""
        every = {**PARAM_FIELDS, **self.fields}
        values = [
            (parsed.getField(name) if name in present else F.lit(None)).cast(kind).alias(name) for name, kind in every.items()
        ]
        return F.when(parsed.isNotNull(), F.struct(*values))

    def table(self, models: DataFrame) -> DataFrame:
        """The known kind codes as a one-column table."""
        rows = [(code,) for code in sorted(self.parsers)]
        return models.sparkSession.createDataFrame(rows, "model_kind int")


def own(params: Column, path: str, kind: str, name: str = "own") -> Column:
    """The value at `path` of a kind's VARIANT parameters as type `kind`; null where it is missing or of another type."""
    return F.try_variant_get(params.getField(name), path, kind)


def supported(models: DataFrame, kinds: Kinds = Kinds()) -> DataFrame:
    """Models of a known kind. The kind table has one row per registered parser."""
    return models.join(F.broadcast(kinds.table(models)), "model_kind", "left_semi")


def unsupported(models: DataFrame, kinds: Kinds = Kinds()) -> DataFrame:
    """Models of an unknown kind."""
    return models.join(F.broadcast(kinds.table(models)), "model_kind", "left_anti")


def with_payload(models: DataFrame) -> DataFrame:
    """Models with a non-empty payload."""
    return models.filter(F.length("model") > 0)


def fetch_locations(models: DataFrame, files: DataFrame) -> DataFrame:
    """Models given by location, with their payload taken from `files` (columns path, content)."""
    found = files.select(F.col("path").alias("location"), F.col("content").alias("__content"))
    empty = F.col("model").isNull() | (F.length("model") == 0)
    return (
        models.join(found, "location", "left")
        .withColumn("model", F.when(empty, F.col("__content")).otherwise(F.col("model")))
        .select(*models.columns)
    )


def build_models(models: DataFrame, names: list[str], kinds: Kinds = Kinds()) -> DataFrame:
    """The model table with ``params``, the parsed model: null when it cannot be built.

    A model of an unknown kind, an empty payload and a malformed document are all null. `names` are the input names in
    the order of the feature columns. Parsing a document costs far more than moving it, so the documents are spread over
    all cores first.
    """
    if not kinds.parsers:
        raise ValueError("no model kind is registered")
    parsed = models.repartition(models.sparkSession.sparkContext.defaultParallelism)
    columns: dict[int, str] = {}
    by_parser: dict[Parser, list[int]] = {}
    for code, parser in kinds.parsers.items():
        by_parser.setdefault(parser, []).append(code)
    for number, (parser, codes) in enumerate(by_parser.items()):
        text, out = f"__text{number}", f"__params{number}"
        mine = F.col("model_kind").isin(codes) & (F.length("model") > 0)
        parsed = parsed.withColumn(text, F.when(mine, F.col("model").cast("string")))
        parsed = parser(parsed, text, names, out)
        columns.update({code: out for code in codes})
    chain = None
    for code, out in columns.items():
        hit = F.col("model_kind") == code
        value = kinds.params(F.col(out), parsed.schema[out].dataType.names)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return parsed.select(*models.columns, chain.alias("params"))


def save_models(models: DataFrame, path: str | None = None) -> DataFrame:
    """Write a built model table and read it back without the payloads.

    Documents are parsed once, when a model arrives; what serves reads the parameters, and only those its score needs.
    Without a path the table goes to a new folder under the shared checkpoint folder.
    """
    spark = models.sparkSession
    path = path or work_folder(spark, "models")
    models.drop("model").write.mode("overwrite").parquet(path)
    return spark.read.schema(models.drop("model").schema).parquet(path)


def latest_models(models: DataFrame, order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """The last model of each type, by time and then arrival unless another `order` is named. Partial maxima are taken before
    the shuffle."""
    packed = F.struct(*[F.col(c) for c in models.columns])
    return (
        models.groupBy("data_type")
        .agg(F.max_by(packed, F.struct(*order)).alias("m"))
        .select("m.*")
    )


def merge_registry(current: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after an update: a new model replaces the current one of its type."""
    return latest_models(current.unionByName(new))


def payload_changes(models: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``changed``: does the payload differ from that of the model before it of the same type?

    The digest, not the payload, is compared across rows, and a type with very many models is cut into chunks.
    """
    digested = models.withColumn("digest", payload_digest(F.col("model")))
    parts = chunks.chunked(digested, "data_type", ["ts", "seq"], limits)
    carry = chunks.carried(
        parts,
        {"__before": F.max_by("digest", F.struct("ts", "seq"))},
        {"__before": lambda c: F.last(c, ignorenulls=True)},
    )
    frame = Window.partitionBy("data_type", chunks.CHUNK).orderBy("ts", "seq")
    previous = F.coalesce(F.lag("digest").over(frame), F.col("__before"))
    return (
        chunks.with_carried(parts, carry, {"__before": "string"})
        .withColumn("changed", previous.isNull() | (previous != F.col("digest")))
        .select(*models.columns, "digest", "changed")
    )


def drop_unchanged(models: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Only the models that change what is served: an update equal to the model it replaces is left out."""
    return payload_changes(models, limits).filter("changed").drop("changed", "digest")


def model_validity(models: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Models with ``valid_to``: the time the next model of the type takes over, null for the current one."""
    parts = chunks.chunked(models, "data_type", ["ts", "seq"], limits)
    carry = chunks.carried(
        parts, {"__next": F.min("ts")}, {"__next": lambda c: F.min(c)}, forward=False
    )
    frame = Window.partitionBy("data_type", chunks.CHUNK).orderBy("ts", "seq")
    return (
        chunks.with_carried(parts, carry, {"__next": "bigint"})
        .withColumn("valid_to", F.coalesce(F.lead("ts").over(frame), F.col("__next")))
        .select(*models.columns, "valid_to")
    )


def model_history(models: DataFrame, depth: int) -> DataFrame:
    """The last `depth` models of each type with their ``rank``, 1 for the current one.

    The rank filter is applied per task before the shuffle, so at most `depth` models per type and task travel.
    """
    frame = Window.partitionBy("data_type").orderBy(F.col("ts").desc(), F.col("seq").desc())
    return models.withColumn("rank", F.row_number().over(frame)).filter(F.col("rank") <= depth)


def rolled_back(models: DataFrame) -> DataFrame:
    """The registry after taking back the newest model of each type."""
    return model_history(models, 2).filter(F.col("rank") == 2).drop("rank")
