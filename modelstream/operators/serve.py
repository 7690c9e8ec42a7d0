"""Batch serving: records meet models, are scored, and the edge cases follow an explicit policy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.functions import compiled, scoring
from modelstream.operators.asof import MODEL, asof_join
from modelstream.operators.registry import latest_models
from modelstream.plans.sizes import fits, lookup_join, measure
from modelstream.schemas import BAD_INPUT, NO_MODEL


@dataclass(frozen=True)
class Policy:
    """What happens at the edges.

    no_model: ``drop`` a record that has no model yet, or ``mark`` it as a result named "No model available".
    bad_input: ``drop`` a record without a type, or ``mark`` it as a result named "Bad input record".
    on_bad_model: a model that failed to build leaves the old one in force (``keep_old``) or leaves none (``clear``).
    """

    no_model: str = "drop"
    bad_input: str = "drop"
    on_bad_model: str = "keep_old"

    def __post_init__(self) -> None:
        for name, allowed in {
            "no_model": ("drop", "mark"),
            "bad_input": ("drop", "mark"),
            "on_bad_model": ("keep_old", "clear"),
        }.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")


def in_force(models: DataFrame, policy: Policy) -> DataFrame:
    """The models that change what is served: all of them under ``clear``, the usable ones under ``keep_old``."""
    return models if policy.on_bad_model == "clear" else models.filter(F.col("params").isNotNull())


def route(
    joined: DataFrame,
    inputs: list[Column],
    policy: Policy = Policy(),
    keep: list[str] | None = None,
    forms: dict[str, scoring.Scorer] | list[str] | None = None,
    score: str | None = None,
) -> DataFrame:
    """Results for records with the struct ``model`` (null when there is none) next to them.

    Three ways: bad input, no model, scored. `keep` names further columns to pass through; ``since`` is the time the
    model took over, null for a marked row. `score` names a column that holds the score already;
    without it `forms` are the model forms that can occur, by default all that the parameters have fields for.
    """
    typed = F.coalesce(F.length("data_type"), F.lit(0)) > 0
    params = F.col(MODEL).getField("params")
    has_model = F.col(MODEL).isNotNull() & params.isNotNull()
    wanted = F.lit(True)
    if policy.bad_input == "drop":
        wanted = wanted & typed
    if policy.no_model == "drop":
        wanted = wanted & (has_model | ~typed)
    scored = typed & has_model
    if score is not None:
        result = F.col(score)
    else:
        fields = joined.schema[MODEL].dataType["params"].dataType.names
        result = scoring.score(inputs, params, forms or scoring.possible_forms(fields))
    return joined.filter(wanted).select(
        *(keep or []),
        F.when(scored, F.col(MODEL).getField("name"))
        .when(typed, F.lit(NO_MODEL))
        .otherwise(F.lit(BAD_INPUT))
        .alias("name"),
        F.when(scored, F.col("data_type")).otherwise(F.lit("")).alias("data_type"),
        F.when(scored, F.col("ts")).otherwise(F.lit(0).cast("bigint")).alias("submission_ts"),
        F.when(scored, result).otherwise(F.lit(0.0)).alias("result"),
        F.when(scored, F.col(MODEL).getField("ts")).alias("since"),
    )


def serve_asof(
    records: DataFrame,
    models: DataFrame,
    inputs: list[Column],
    policy: Policy = Policy(),
    *,
    order: str = "event_time",
    batch: str = "batch",
    keep: list[str] | None = None,
    forms: dict[str, scoring.Scorer] | list[str] | None = None,
    strategy: str = "auto",
    limits: Limits = Limits(),
) -> DataFrame:
    """Each record is scored with the latest model of its type at its time.

    ``order="event_time"`` compares `ts`, a model before a record of the same time. ``order="models_first"`` compares the
    batch numbers in column `batch`: all models of a batch apply before any of its records, the last of them wins.
    """
    if order not in ("event_time", "models_first"):
        raise ValueError(f"order must be event_time or models_first, not {order!r}")
    marked = policy.no_model == "mark" or policy.bad_input == "mark"
    changes, at, seq = in_force(models, policy), "ts", "seq"
    if order == "models_first":
        changes, at, seq = changes.withColumn("arrival", F.struct("ts", "seq")), batch, "arrival"
    joined = asof_join(
        records,
        changes,
        at=at,
        seq=seq,
        how="left" if marked else "inner",
        strategy=strategy,
        limits=limits,
    )
    return route(joined, inputs, policy, keep, forms)


def serve_latest(
    records: DataFrame,
    models: DataFrame,
    inputs: list[Column],
    policy: Policy = Policy(),
    *,
    keep: list[str] | None = None,
    forms: dict[str, scoring.Scorer] | list[str] | None = None,
    spread: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Every record is scored with the newest model of its type: the registry is small and goes to the records."""
    newest = latest_models(in_force(models, policy))
    side = newest.select("data_type", F.struct(*[F.col(c) for c in newest.columns]).alias(MODEL))
    marked = policy.no_model == "mark" or policy.bad_input == "mark"
    joined = lookup_join(
        records, side, "data_type", "left" if marked else "inner", spread=spread, limits=limits
    )
    return route(joined, inputs, policy, keep, forms)


def serve_few(
    records: DataFrame,
    models: DataFrame,
    inputs: list[str],
    policy: Policy = Policy(),
    *,
    most: int = 32,
    keep: list[str] | None = None,
    forms: dict[str, scoring.Scorer] | list[str] | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """As `serve_latest`, for a registry of few types: the models are written into the plan and nothing is joined.

    `inputs` are SQL expressions. The newest models are read to the driver only after they were measured and found to be
    at most `most` and within the broadcast limits; beyond that, and where a model cannot be written out (a form of the
    caller's own, a very deep tree), `serve_latest` does the work. Both score alike.
    """
    newest = latest_models(in_force(models, policy))
    size = measure(newest)
    rows = newest.collect() if size["rows"] <= most and fits(size, limits) else None
    if rows is None or not all(compiled.writable(r["params"] and r["params"].asDict(recursive=True)) for r in rows):
        return serve_latest(
            records, models, [F.expr(text) for text in inputs], policy, keep=keep, forms=forms, limits=limits
        )
    # `route` reads the model's name, time and usability; the score is a column of its own.
    scores, known = [], F.lit(None).cast("struct<name:string,ts:bigint,params:boolean>")
    scored = records
    for number, row in enumerate(rows):
        mine = F.col("data_type") == row["data_type"]
        usable = F.lit(True) if row["params"] is not None else F.lit(None).cast("boolean")
        known = F.when(
            mine, F.struct(F.lit(row["name"]).alias("name"), F.lit(row["ts"]).alias("ts"), usable.alias("params"))
        ).otherwise(known)
        if row["params"] is not None:
            out = f"__score{number}"
            condition = f"data_type = {compiled.text(row['data_type'])}"
            scored = compiled.with_score(scored, inputs, row["params"].asDict(recursive=True), out, condition)
            scored = scored.drop(f"{out}_probs")
            scores.append(F.col(out))
    total = F.coalesce(*scores, F.lit(None).cast("double"))
    return route(scored.withColumn(MODEL, known).withColumn("__score", total), [], policy, keep, score="__score")
