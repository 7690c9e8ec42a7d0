"""Scoring by blocks against both other ways of scoring and against plain walks and sums."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from modelstream.config import Limits
from modelstream.functions import blocks as arrays
from modelstream.functions import compiled, scoring
from modelstream.operators.blocks import score_blocks, serve_blocks
from modelstream.operators.serve import Policy, serve_asof
from modelstream.schemas import PARAMS, linear_params

NODE = pa.struct([("f", pa.int32()), ("thr", pa.float64()), ("strict", pa.bool_()), ("l", pa.int32()), ("r", pa.int32()),
                  ("score", pa.string()), ("probs", pa.list_(pa.float64()))])
FOREST = pa.struct([("form", pa.string()), ("labels", pa.list_(pa.string())), ("trees", pa.list_(pa.list_(NODE)))])


def random_tree(rng, depth, features, classes, full=False):
    nodes = []

    def grow(left):
        at = len(nodes)
        nodes.append(None)
        if not left or (not full and rng.random() < 0.15):
            probs = [rng.random() for _ in range(classes)]
            nodes[at] = {"f": -1, "thr": None, "strict": None, "l": None, "r": None, "score": str(rng.randrange(9)), "probs": probs if classes else None}
            return at
        threshold = rng.choice([rng.randrange(5), rng.uniform(-1, 6), 0.0, -0.0, math.inf, -math.inf] if not full else [rng.random()])
        one = {"f": rng.randrange(features), "thr": float(threshold), "strict": rng.random() < 0.5, "score": None, "probs": None}
        one["l"] = grow(left - 1)
        one["r"] = grow(left - 1)
        nodes[at] = one
        return at

    grow(depth)
    return nodes


def folded(values):
    """The sum from left to right: `sum` compensates."""
    total = 0.0
    for v in values:
        total += v
    return total


def plain_network(layers, x):
    h = [0.0 if v is None else v for v in x]
    for one in layers:
        z = [b + folded(w * v for w, v in zip(row, h)) for row, b in zip(one["w"], one["b"])]
        act = {"tanh": math.tanh, "relu": lambda v: max(v, 0.0), "sigmoid": lambda v: 1 / (1 + math.exp(-v))}.get(one["act"])
        h = [act(v) for v in z] if act else [math.exp(v - max(z)) / folded(math.exp(u - max(z)) for u in z) for v in z]
    return h


def walk(nodes, x):
    """The leaf, by the order of numbers that Spark has: NaN is the largest."""
    at = nodes[0]
    while at["f"] >= 0:
        v = x[at["f"]] if at["f"] < len(x) else 0.0
        v = 0.0 if v is None else v
        below = not math.isnan(v) and (v < at["thr"] if at["strict"] else v <= at["thr"])
        at = nodes[at["l"] if below else at["r"]]
    return at


@pytest.mark.parametrize("leaves", [1024, 4])
@pytest.mark.parametrize("classes", [0, 3])
def test_forests_equal_a_walk(monkeypatch, leaves, classes):
    """By bit vectors, and beyond `LEAVES` from the root: the same leaf of every tree."""
    monkeypatch.setattr(arrays, "LEAVES", leaves)
    rng = random.Random(leaves + classes)
    special = [0.0, -0.0, math.nan, math.inf, -math.inf, 1.0, 2.0, 5e-324, -5e-324, None]
    for depth in (0, 1, 4, 9):
        trees = [random_tree(rng, depth, 5, classes) for _ in range(7)]
        rows = [[rng.choice(special + [rng.uniform(-1, 6)]) for _ in range(rng.choice([5, 5, 3, 6]))] for _ in range(400)] + [None, []]
        labels = ["4", "5", "six"][:classes]
        params = pa.array([{"form": "forest", "labels": labels, "trees": trees}], FOREST)[0]
        result, shares = arrays.block_scorer(params)(pa.array(rows, pa.list_(pa.float64())))
        for i, x in enumerate(rows):
            met = [walk(t, x or []) for t in trees]
            if classes:
                mean = [folded(m["probs"][c] for m in met) / len(met) for c in range(classes)]
                assert shares[i].tolist() == mean
                best = mean.index(max(mean))
                assert result[i] == float(labels[best]) if best < 2 else math.isnan(result[i])
            else:
                assert shares is None and result[i] == sum((float(m["score"]) for m in met), 0.0) / len(met)


def test_a_cycle_is_no_tree():
    node = {"f": 0, "thr": 1.0, "strict": False, "l": 0, "r": 0, "score": None, "probs": None}
    with pytest.raises(ValueError, match="tree"):
        arrays.block_scorer(pa.array([{"form": "forest", "labels": [], "trees": [[node]]}], FOREST)[0])


def networks(spark, width, folder):
    rng = np.random.default_rng(3)
    layer = lambda i, o, act: {"w": rng.normal(size=(o, i)).tolist(), "b": rng.normal(size=o).tolist(), "act": act}
    hidden = [layer(width, 9, "tanh"), layer(9, 6, "relu"), layer(6, 4, "softmax")]
    trees = [random_tree(random.Random(i), 5, width, 3) for i in range(4)]
    base = {"labels": None, "intercept": None, "coefs": None, "exponents": None, "link": None, "depth": None, "trees": None, "layers": None}
    rows = [
        ("net", {**base, "form": "network", "labels": ["1", "2", "3", "4"], "layers": hidden}),
        ("dense", {**base, "form": "dense", "layers": [layer(width, 5, "sigmoid")]}),
        ("forest", {**base, "form": "forest", "labels": ["7", "8", "9"], "depth": 9, "trees": trees}),
        ("tree", {**base, "form": "tree", "labels": ["7", "8", "9"], "depth": 9, "trees": trees[:1]}),
        ("linear", {**base, "form": "linear", "intercept": 0.5, "coefs": [0.25] * width}),
        ("glm", {**base, "form": "glm", "intercept": 0.5, "coefs": [0.01] * width, "exponents": [2.0] + [1.0] * (width - 1), "link": "logit"}),
        ("broken", None),
    ]
    spark.createDataFrame(rows, f"key string, params {PARAMS}").write.parquet(f"{folder}/models")
    return spark.read.schema(f"key string, params {PARAMS}").parquet(f"{folder}/models"), dict(rows)


def many(spark, params, width, n):
    """One version has most of the rows; some are unknown or null."""
    rng = random.Random(width)
    keys = [*params, "unknown", None]
    rows = [(i, rng.choice(keys) if i % 3 else "net", [round(rng.uniform(-2, 2), 3) if rng.random() > 0.02 else None for _ in range(width)])
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, key string, x array<double>").repartition(3)


def test_blocks_score_as_data_and_plan_do(spark, folder):
    models, params = networks(spark, 3, folder)
    rows, frame = many(spark, params, 3, 200)
    columns = [F.get("x", i) for i in range(3)]
    data = {r.id: r.s for r in frame.join(models, "key", "left").select("id", scoring.score(columns, F.col("params")).alias("s")).collect()}
    for limits in (Limits(), Limits(broadcast_rows=0)):
        got = {r.id: r for r in score_blocks(frame, models, "key", "x", spread=F.col("id"), limits=limits).collect()}
        assert len(got) == len(rows)
        for i, value in data.items():
            assert (got[i].result is None) == (value is None)
            assert value is None or got[i].result == pytest.approx(value, rel=1e-9, abs=1e-12)
        assert all(got[i].result is None and got[i].result_probs is None for i, k, _ in rows if k in ("broken", "unknown", None))
    for key in ("net", "dense", "forest", "tree"):
        planned = compiled.with_score(frame.filter(F.col("key") == key), [f"get(x, {i})" for i in range(3)], params[key])
        for r in planned.select("id", "result", "result_probs").collect():
            assert got[r.id].result == r.result
            assert got[r.id].result_probs == pytest.approx(r.result_probs, rel=1e-9)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0)])
def test_wide_networks(spark, folder, limits):
    models, params = networks(spark, 512, folder)
    rows, frame = many(spark, params, 512, 120)
    got = {r.id: r for r in score_blocks(frame, models, "key", "x", spread=F.col("id"), limits=limits).collect()}
    for i, key, x in rows:
        if key == "net":
            outputs = plain_network(params["net"]["layers"], x)
            assert got[i].result_probs == pytest.approx(outputs, rel=1e-9) and got[i].result == 1 + outputs.index(max(outputs))
        if key == "dense":
            single = [float(np.float32(v or 0.0)) for v in x]
            assert got[i].result_probs == pytest.approx(plain_network(params["dense"]["layers"], single), rel=1e-9)


def test_blocks_of_nothing(spark, folder):
    models, _ = networks(spark, 3, folder)
    empty = spark.createDataFrame([], "id int, key string, x array<double>")
    some = spark.createDataFrame([(1, "net", None)], "id int, key string, x array<double>")
    for limits in (Limits(), Limits(broadcast_rows=0)):
        assert score_blocks(empty, models, "key", "x", limits=limits).count() == 0
        assert score_blocks(some, models.limit(0), "key", "x", limits=limits).first().result is None
        assert score_blocks(some, models, "key", "x", limits=limits).first().result is not None


@pytest.mark.parametrize("policy", [Policy(), Policy(no_model="mark", bad_input="mark", on_bad_model="clear")])
def test_serving_by_blocks(spark, policy):
    models = spark.createDataFrame(
        [("m1", "a", 5, 1, 1.0), ("m2", "a", 9, 2, 2.0), ("m3", "b", 1, 3, None), ("m4", "b", 0, 4, 4.0)],
        "name string, data_type string, ts long, seq long, v double",
    ).withColumn("params", F.when(F.col("v").isNotNull(), linear_params(F.col("v"), [F.lit(1.0)]))).drop("v")
    records = spark.createDataFrame(
        [(i, d, t, [float(i)]) for i, (d, t) in enumerate([("a", 4), ("a", 5), ("a", 20), ("b", 0), ("b", 7), ("c", 1), (None, 3)])],
        "record_id int, data_type string, ts long, x array<double>",
    )
    plain = serve_asof(records, models, [F.get("x", 0)], policy, keep=["record_id"], forms=["linear"])
    found = serve_blocks(records, models, F.col("x"), policy, keep=["record_id"])
    assert sorted(found.collect()) == sorted(plain.collect())
