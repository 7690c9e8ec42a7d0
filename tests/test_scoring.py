"""Documents, the data-driven scorers and the compiled ones against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelstream.functions import compiled, remote, scoring
from modelstream.operators.external import batch_score
from modelstream.plans import fixtures as fx
from modelstream.plans.bindings import LINE_COLUMNS, LINE_NAMES
from modelstream.sources.documents import parse_document, parse_layers
from modelstream.sources.models import load_model

ROWS = [
    (10.0, 1000.0, 0.0, 0.0),
    (20.0, 30000.0, 0.05, 0.03),
    (20.5, 30000.5, 0.06, 0.04),
    (25.0, 20000.0, 0.1, 0.031),
    (26.0, 90000.0, 0.07, 0.08),
    (50.0, 90000.0, None, 0.01),
]


def lines(spark):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(ROWS)],
        "i int, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
    )


def expected_linear(q, p, d, t):
    return 3.25 + 0.5 * q - 12.5 * (d or 0) + 8 * t


def expected_glm(q, p, d, t):
    return math.exp(0.5 + 0.0004 * q * q + 0.003 * math.sqrt(p) - 1.5 * (d or 0))


def expected_tree(q, p, d, t):
    if p <= 30000:
        return 1.5 if q <= 20 else 2.25
    return 3.75 if (d or 0) <= 0.05 else (4.5 if t < 0.04 else 5.125)


def expected_class(q, p, d, t):
    if q <= 25:
        return 6.0 if p <= 20000 else 5.0
    return 7.0 if t > 0.03 else 6.0


CASES = [
    (fx.LINEAR, expected_linear),
    (fx.GLM_LOG, expected_glm),
    (fx.TREE_REGRESSION, expected_tree),
    (fx.TREE_CLASSES, expected_class),
]


@pytest.mark.parametrize("document,expected", CASES)
def test_lines(spark, document, expected):
    params = load_model(spark, document, LINE_NAMES)
    want = [expected(*r) for r in ROWS]
    fast = compiled.with_score(lines(spark), LINE_COLUMNS, params).orderBy("i").collect()
    assert [r.result for r in fast] == pytest.approx(want)
    one = spark.createDataFrame([(document,)], "text string")
    held = parse_document(one, "text", LINE_NAMES, "params").select("params")
    x = [F.col(c) for c in LINE_COLUMNS]
    slow = lines(spark).crossJoin(F.broadcast(held)).select("i", scoring.score(x, F.col("params")).alias("s"))
    assert [r.s for r in slow.repartition(3).orderBy("i").collect()] == pytest.approx(want)


def test_class_shares_and_tie(spark):
    params = load_model(spark, fx.TREE_CLASSES, LINE_NAMES)
    rows = compiled.with_score(lines(spark), LINE_COLUMNS, params).orderBy("i").collect()
    assert rows[0].result_probs == [0.5, 0.5, 0.0] and rows[0].result == 6.0


def test_forest(spark):
    params = load_model(spark, fx.FOREST, fx.PART_NAMES)
    assert params["form"] == "forest" and params["depth"] == 2
    rows = spark.createDataFrame([(0, 10.0, 900.0, 650.0, 20.0), (1, 30.0, 2000.0, 900.0, 30.0)], "i int, a double, b double, c double, d double")
    got = compiled.with_score(rows, ["a", "b", "c", "d"], params).orderBy("i").collect()
    first = np.mean([[0.75, 0.25, 0], [0.75, 0.25, 0], [0.25, 0.625, 0.125]], axis=0)
    second = np.mean([[0.125, 0.125, 0.75], [0, 0.5, 0.5], [0.8, 0, 0.2]], axis=0)
    assert got[0].result_probs == pytest.approx(list(first)) and got[0].result == 5.0
    assert got[1].result_probs == pytest.approx(list(second)) and got[1].result == 7.0
    held = parse_document(spark.createDataFrame([(fx.FOREST,)], "text string"), "text", fx.PART_NAMES, "p").select("p")
    x = [F.col(c) for c in "abcd"]
    both = rows.crossJoin(F.broadcast(held)).select(
        "i", scoring.score(x, F.col("p")).alias("s"), scoring.forest_probabilities(x, F.col("p")).alias("q")
    )
    slow = both.orderBy("i").collect()
    assert [r.s for r in slow] == [5.0, 7.0] and slow[1].q == pytest.approx(list(second))


def numpy_network(x, layers, softmax):
    h = np.array(x)
    for depth, (w, b) in enumerate(layers):
        z = np.array(w) @ h + np.array(b)
        last = depth == len(layers) - 1
        h = np.exp(z) / np.exp(z).sum() if last and softmax else 1 / (1 + np.exp(-z))
    return h


def test_network(spark):
    layers = [([[0.5, -1.0], [2.0, 0.25], [-0.75, 1.5]], [0.1, -0.2, 0.3]), ([[1.0, -1.0, 0.5], [-0.5, 1.0, 0.25]], [0.0, 0.2])]
    document = fx.network_document(layers, ["a", "b"], ["4", "9"])
    params = load_model(spark, document, ["a", "b"])
    points = [(0.0, 0.0), (1.0, -2.0), (-3.0, 0.5), (800.0, 2.0)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double")
    want = [numpy_network(p, layers, True) for p in points]
    fast = compiled.with_score(rows, ["a", "b"], params).orderBy("i").collect()
    held = parse_document(spark.createDataFrame([(document,)], "text string"), "text", ["a", "b"], "p").select("p")
    slow = rows.crossJoin(F.broadcast(held)).select(
        "i", scoring.score([F.col("a"), F.col("b")], F.col("p")).alias("s"),
        scoring.network_outputs([F.col("a"), F.col("b")], F.col("p")).alias("q"),
    ).orderBy("i").collect()
    for one, two, q in zip(fast, slow, want):
        assert one.result_probs == pytest.approx(list(q)) and two.q == pytest.approx(list(q))
        assert one.result == two.s == [4.0, 9.0][int(q.argmax())]


def test_dense_index(spark):
    layers = [([[1.0, 0.0], [0.0, 1.0], [0.0, 1.0]], [0.0, 0.0, 0.0])]
    params = load_model(spark, fx.layers_document([(*layers[0], "sigmoid")]), ["a", "b"])
    rows = spark.createDataFrame([(0, 1.0, 0.0), (1, 0.0, 1.0)], "i int, a double, b double")
    got = compiled.with_score(rows, ["a", "b"], params).orderBy("i").collect()
    assert [r.result for r in got] == [0.0, 1.0]


def deep_tree(levels):
    node = fx.leaf("1.0")
    for level in range(levels):
        node = fx.split("x", "lessOrEqual", float(level), node, fx.leaf("2.0"))
    return fx.tree_document(node, ["x"])


def test_documents_that_cannot_be_held_exactly_are_rejected(spark):
    def changed(document, old, new):
        assert old in document
        return document.replace(old, new, 1)

    predictor = '<NumericPredictor name="quantity"'
    neuron = '<Neuron id="2/1"'
    network = fx.network_document([([[1.0, 2.0]], [0.0]), ([[1.0], [2.0]], [0.0, 0.0])], ["quantity", "discount"], ["4", "9"])
    texts = [
        changed(fx.TREE_REGRESSION, 'operator="greaterThan" value="30000.0"', 'operator="greaterThan" value="31000.0"'),
        changed(fx.GLM_LOG, 'predictorName="discount" parameterName="p3"', 'predictorName="quantity" parameterName="p3"'),
        changed(fx.FOREST, "average", "majorityVote"),
        changed(fx.LINEAR, predictor, f'<PredictorTerm coefficient="2"><FieldRef field="tax"/></PredictorTerm>{predictor}'),
        changed(fx.LINEAR, predictor, f'<CategoricalPredictor name="colour" value="red" coefficient="2"/>{predictor}'),
        changed(fx.LINEAR, "<RegressionTable", '<Targets><Target field="grade" rescaleFactor="2"/></Targets><RegressionTable'),
        changed(fx.LINEAR, '<MiningField name="tax"', '<MiningField name="tax" missingValueReplacement="3"'),
        changed(fx.FOREST, "<True/><TreeModel", '<SimplePredicate field="size" operator="lessThan" value="3"/><TreeModel'),
        changed(network, '<FieldRef field="discount"/>', '<NormContinuous field="discount"><LinearNorm orig="0" norm="1"/></NormContinuous>'),
        changed(network, '<Con from="1/1"', '<Con from="0/1"'),
        changed(network, neuron, f'<Neuron id="2/0" bias="1"><Con from="1/1" weight="1"/></Neuron>{neuron}'),
        fx.LINEAR[:-5],
        "",
    ]
    good = [fx.LINEAR, fx.GLM_LOG, network, deep_tree(12), deep_tree(13), deep_tree(200)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts + good)], "i int, text string")
    rows = parse_document(frame, "text", ["x", "quantity", "extended price"], "p").orderBy("i").collect()
    assert [r.p is not None for r in rows] == [False] * len(texts) + [True] * len(good)
    assert [r.p.depth for r in rows[-3:]] == [12, 13, 200]


def test_layers_of_other_widths_are_rejected(spark):
    layer = lambda w: fx.layers_document([(w, [0.0] * len(w), "relu")])
    texts = [layer([[1.0, 2.0]]), layer([[1.0]]), layer([[1.0, 2.0, 3.0]]), layer([[1.0, 2.0], [1.0]])]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = parse_layers(frame, "text", ["a", "b"], "p").orderBy("i").collect()
    assert [r.p is not None for r in rows] == [True, False, False, False]


def test_a_deep_tree_scores_alike_both_ways(spark):
    document = deep_tree(20)
    rows = spark.createDataFrame([(i, i - 0.5) for i in range(24)], "i int, x double")
    want = [1.0 if x <= 0 else 2.0 for x in (i - 0.5 for i in range(24))]
    held = parse_document(spark.createDataFrame([(document,)], "text string"), "text", ["x"], "p").select("p")
    slow = rows.crossJoin(F.broadcast(held)).select("i", scoring.score([F.col("x")], F.col("p"), ["tree"]).alias("s")).orderBy("i").collect()
    fast = compiled.with_score(rows, ["x"], load_model(spark, document, ["x"])).orderBy("i").collect()
    assert [r.s for r in slow] == [r.result for r in fast] == want


def test_zero_coefficients_and_text_labels_score_alike_both_ways(spark):
    rows = spark.createDataFrame([(0, float("nan"), 1.0)], "i int, quantity double, x double")
    linear = {"form": "linear", "intercept": 1.0, "coefs": [0.0, 2.0]}
    assert math.isnan(compiled.with_score(rows, ["quantity", "x"], linear).first().result)
    classes = fx.tree_document(fx.split("x", "lessOrEqual", 0.0, fx.leaf("low", clow=1), fx.leaf("high", chigh=1)), ["x"], ["low", "high"])
    params = load_model(spark, classes, ["x"])
    assert params["labels"] is not None and compiled.with_score(rows, ["x"], params).first().result is None


def test_external_scorer(spark):
    rows = spark.createDataFrame([(i, [float(i), float(9 - i)]) for i in range(10)], "i long, features array<double>").coalesce(1)

    def scorer(matrix):
        if (matrix[:, 0] >= 8).any():
            raise RuntimeError("no answer")
        return matrix

    got = {r.i: r.result for r in batch_score(rows, "features", scorer, call_rows=4).collect()}
    assert got == {**{i: 1.0 for i in range(5)}, **{i: 0.0 for i in range(5, 8)}, 8: None, 9: None}


def test_request_and_response(spark):
    body = spark.range(1).select(remote.predict_request(F.array(F.lit(7.4), F.lit(0.7))).alias("b")).first().b
    assert body == '{"signature_name":"predict","instances":[{"inputs":[7.4,0.7]}]}'
    rows = spark.createDataFrame(
        [('{"predictions": [[1.14877e-09, 0.0618138, 0.689735, 0.304]]}',), ("{}",), ("no json",), ('{"predictions": [[]]}',)], "b string"
    )
    assert [r.c for r in rows.select(remote.predicted_class(F.col("b")).alias("c")).collect()] == [2.0, None, None, None]


@pytest.mark.parametrize("link,value", [("identity", 2.0), ("log", math.exp(2)), ("logit", 1 / (1 + math.exp(-2))), ("inverse", 0.5), ("probit", None)])
def test_links(spark, link, value):
    got = spark.range(1).select(scoring.inverse_link(F.lit(link), F.lit(2.0)).alias("v")).first().v
    assert got == (pytest.approx(value) if value is not None else None)
