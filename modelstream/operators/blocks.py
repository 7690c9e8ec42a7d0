"""Serving by blocks: the records of one model version are scored together, on arrays.

Parameters do not travel with the records. A model table within the broadcast limits is sent once to every task; a larger one
is shuffled with the records on the version, heavy versions on salts too, and sorted so that a model comes before its
records. Either way a task holds the scorers it is using and one Arrow batch of records.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelstream.config import Limits, ship_package
from modelstream.functions.blocks import block_scorer
from modelstream.operators.asof import MODEL, asof_join
from modelstream.operators.serve import Policy, in_force, route
from modelstream.plans.sizes import fits, measure, salted_sides

Scorer = Callable[[pa.Array], tuple[np.ndarray, np.ndarray | None]]
SHARES = pa.list_(pa.float64())

# The scorers a Python worker has built from the last model table it was sent, by version.
_built: tuple[str, dict[object, Scorer | None]] = ("", {})


def _scores(vectors: pa.Array, groups: list[tuple[np.ndarray, Scorer | None]]) -> tuple[pa.Array, pa.Array]:
    """Results and shares of all rows; `groups` are the rows of each scorer, together all rows."""
    result = np.full(len(vectors), np.nan)
    order, shares = [], []
    for rows, scorer in groups:
        order.append(rows)
        if scorer is None:
            shares.append(pa.nulls(len(rows), SHARES))
            continue
        result[rows], some = scorer(vectors if len(rows) == len(vectors) else vectors.take(pa.array(rows)))
        if some is None:
            shares.append(pa.nulls(len(rows), SHARES))
        else:
            ends = np.arange(len(some) + 1, dtype=np.int32) * some.shape[1]
            shares.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(some.ravel())))
    if not order:
        return pa.array(result), pa.nulls(0, SHARES)
    back = np.argsort(np.concatenate(order), kind="stable")
    return pa.array(result, mask=np.isnan(result)), pa.concat_arrays(shares).take(pa.array(back))


def _sent(records: DataFrame, side: DataFrame, key: str, features: str, schema: T.StructType) -> DataFrame:
    """The models go to the tasks as one Arrow table; the records stay where they are."""
    table = side.toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    content, token = records.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _built
        models = pa.ipc.open_stream(content.value).read_all().combine_chunks()
        place = {k: i for i, k in enumerate(models.column("__key").to_pylist())}
        if _built[0] != token:
            _built = (token, {})
        known = _built[1]

        def scorer(version: object) -> Scorer | None:
            if version not in place:
                return None
            if version not in known:
                known[version] = block_scorer(models.column("params")[place[version]])
            return known[version]

        for batch in source:
            versions = batch.column(key).dictionary_encode()
            # A null version has no place in the dictionary.
            codes = pc.fill_null(versions.indices, -1).to_numpy(zero_copy_only=False)
            groups = [(np.flatnonzero(codes == c), scorer(versions.dictionary[int(c)].as_py()) if c >= 0 else None) for c in np.unique(codes)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *_scores(batch.column(features), groups)], schema.names)

    return records.mapInArrow(run, schema)


def _runs(*columns: pa.Array) -> np.ndarray:
    """Where the values of the columns change from one row to the next, the first row included."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = False
        for c in columns:
            differs = pc.fill_null(pc.not_equal(c[1:], c[:-1]), False).to_numpy(zero_copy_only=False)
            valid = c.is_valid().to_numpy(zero_copy_only=False)
            new[1:] |= differs | (valid[1:] != valid[:-1])
    return np.flatnonzero(new)


def _met(records: DataFrame, side: DataFrame, key: str, features: str, schema: T.StructType, spread: Column, limits: Limits) -> DataFrame:
    """Records and models shuffled together; a model is at hand when its records come."""
    rows = records.select(F.col(f"`{key}`").alias("__key"), spread.alias("__spread"), F.struct("*").alias("__row"))
    dealt, copies = salted_sides(rows, side, "__key", F.col("__spread"), limits)
    both = dealt.select("__key", "__salt", F.lit(True).alias("__record"), "__row", F.lit(None).alias("params")).unionByName(
        copies.select("__key", "__salt", F.lit(False).alias("__record"), F.lit(None).alias("__row"), "params")
    )

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[object, Scorer | None] = (None, None)
        for batch in source:
            keys, salts, is_record, row, params = batch.columns
            starts = _runs(keys, salts, is_record)
            wanted, groups, met = [], [], 0
            for a, b in zip(starts, [*starts[1:], len(keys)]):
                version = (keys[int(a)].as_py(), salts[int(a)].as_py())
                if not is_record[int(a)].as_py():
                    held = (version, block_scorer(params[int(a)]))
                    continue
                wanted.append(np.arange(a, b))
                groups.append((np.arange(met, met + b - a), held[1] if held[0] == version else None))
                met += b - a
            if met:
                own = row.take(pa.array(np.concatenate(wanted)))
                columns = own.flatten()
                vectors = columns[own.type.get_field_index(features)]
                yield pa.RecordBatch.from_arrays([*columns, *_scores(vectors, groups)], schema.names)

    dealt_out = both.repartition("__key", "__salt").sortWithinPartitions("__key", "__salt", "__record")
    return dealt_out.mapInArrow(run, schema)


def score_blocks(
    records: DataFrame,
    models: DataFrame,
    key: str,
    features: str,
    out: str = "result",
    *,
    spread: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """`records` with the score of the model of their `key` in column `out` and class shares or outputs in `{out}_probs`.

    `features` names an array of inputs; missing, null and absent elements count as 0.0. `models` has one row per `key` with
    its ``params``; it is read more than once, so give a written table. Records without a key or a model that was built have null in
    both columns. Results are those of the other two ways of scoring; outputs of networks may differ in the last bits, since
    a matrix product adds in an order of its own. Select only the columns to keep before: every column crosses to Python.
    """
    ship_package(records.sparkSession)
    side = models.filter(F.col("params").isNotNull() & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("__key"), "params")
    own = [T.StructField(f.name, f.dataType) for f in records.schema.fields]
    schema = T.StructType([*own, T.StructField(out, T.DoubleType()), T.StructField(f"{out}_probs", T.ArrayType(T.DoubleType()))])
    if fits(measure(side), limits):
        return _sent(records, side, key, features, schema)
    if spread is None:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in records.columns])
    return _met(records, side, key, features, schema, spread, limits)


def serve_blocks(
    records: DataFrame,
    models: DataFrame,
    features: Column,
    policy: Policy = Policy(),
    *,
    keep: list[str] | None = None,
    strategy: str = "auto",
    limits: Limits = Limits(),
) -> DataFrame:
    """As `serve_asof` by event time, scored by blocks: only the version of a model meets the records in the join."""
    marked = policy.no_model == "mark" or policy.bad_input == "mark"
    version = F.to_json(F.struct("data_type", "ts", "seq")).alias("version")
    changes = in_force(models, policy)
    usable = F.when(F.col("params").isNotNull(), F.lit(True)).alias("params")
    light = changes.select("data_type", "ts", "seq", "name", version, usable)
    joined = asof_join(records, light, how="left" if marked else "inner", strategy=strategy, limits=limits)
    wanted = list(dict.fromkeys([*(keep or []), "data_type", "ts"]))
    rows = joined.select(*wanted, MODEL, F.col(MODEL).getField("version").alias("__version"), features.alias("__features"))
    scored = score_blocks(
        rows, changes.select(version.alias("__version"), "params"), "__version", "__features", "__score", limits=limits
    )
    return route(scored, [], policy, keep, score="__score")
