"""Score expressions over model parameters held in columns.

Every scorer takes the inputs as a list of columns and the parameters as one struct column (a PARAMS value or a
narrower one with the fields the form needs), so records and the models in force for them score in one projection and
a new model is a new row. Linear forms stay inside generated code; trees and networks use higher-order functions. Where
one model scores a whole table, `modelstream.functions.compiled` writes it into the plan instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelstream.functions.features import argmax, label_number, let

Scorer = Callable[[list[Column], Column], Column]


def clean(value: Column) -> Column:
    """An input the record does not carry counts as 0.0."""
    return F.coalesce(value.cast("double"), F.lit(0.0))


def inverse_link(link: Column, eta: Column) -> Column:
    """The response for the linear predictor `eta`; null for an unknown link."""
    return (
        F.when(link.isNull() | (link == "identity"), eta)
        .when(link == "log", F.exp(eta))
        .when(link == "logit", 1.0 / (1.0 + F.exp(-eta)))
        .when((link == "inverse") & (eta != 0.0), 1.0 / eta)
    )


def linear(x: list[Column], p: Column) -> Column:
    """Intercept plus the sum of coefficient times input."""
    coefs = p.getField("coefs")
    terms = [F.coalesce(F.get(coefs, F.lit(i)), F.lit(0.0)) * clean(v) for i, v in enumerate(x)]
    return reduce(lambda a, b: a + b, terms, p.getField("intercept"))


def glm(x: list[Column], p: Column) -> Column:
    """Linear predictor over powers of the inputs, taken through the inverse of the link."""
    coefs, exponents = p.getField("coefs"), p.getField("exponents")
    eta = p.getField("intercept")
    for i, v in enumerate(x):
        power = F.coalesce(F.get(exponents, F.lit(i)), F.lit(1.0))
        value = F.when(power == 1.0, clean(v)).otherwise(F.pow(clean(v), power))
        eta = eta + F.coalesce(F.get(coefs, F.lit(i)), F.lit(0.0)) * value
    return inverse_link(p.getField("link"), eta)


def _leaf(nodes: Column, x: Column, depth: Column) -> Column:
    """The leaf of a node array that the inputs lead to."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        value = F.coalesce(F.get(x, node.getField("f")), F.lit(0.0))
        threshold = node.getField("thr")
        left = F.when(node.getField("strict"), value < threshold).otherwise(value <= threshold)
        return (
            F.when(node.getField("f") < 0, at)
            .when(left, node.getField("l"))
            .otherwise(node.getField("r"))
        )

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), F.lit(0), step))


def _inputs(x: list[Column]) -> Column:
    return F.array(*[clean(v) for v in x])


def tree_leaf(x: list[Column], p: Column) -> Column:
    """The leaf struct (score text, class probabilities) of a single tree."""
    return _leaf(F.get(p.getField("trees"), 0), _inputs(x), p.getField("depth"))


def tree(x: list[Column], p: Column) -> Column:
    """The score of the leaf as a number: a mean for regression, the label for classification."""
    return label_number(tree_leaf(x, p).getField("score"))


def forest_probabilities(x: list[Column], p: Column) -> Column:
    """Class probabilities averaged over the trees."""
    vector, depth, trees = _inputs(x), p.getField("depth"), p.getField("trees")
    probs = F.transform(trees, lambda nodes: _leaf(nodes, vector, depth).getField("probs"))
    zero = F.transform(p.getField("labels"), lambda _: F.lit(0.0))
    total = F.aggregate(probs, zero, lambda sums, one: F.zip_with(sums, one, lambda a, b: a + b))
    return F.transform(total, lambda s: s / F.size(trees))


def forest(x: list[Column], p: Column) -> Column:
    """Label of the best averaged probability; the mean of the leaves for a forest without labels."""
    vector, depth, trees = _inputs(x), p.getField("depth"), p.getField("trees")
    mean = F.aggregate(
        trees,
        F.lit(0.0),
        lambda s, nodes: s + _leaf(nodes, vector, depth).getField("score").try_cast("double"),
    ) / F.size(trees)
    best = F.get(p.getField("labels"), argmax(forest_probabilities(x, p)))
    return F.when(F.size(p.getField("labels")) > 0, label_number(best)).otherwise(mean)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _activate(act: Column, value: Column) -> Column:
    return (
        F.when(act == "identity", value)
        .when(act.isin("logistic", "sigmoid"), 1.0 / (1.0 + F.exp(-value)))
        .when(act == "tanh", F.tanh(value))
        .when(act.isin("rectifier", "relu"), F.greatest(value, F.lit(0.0)))
    )


def network_outputs(x: list[Column], p: Column, single: bool = False) -> Column:
    """Outputs of the last layer; `single` rounds the inputs to 32-bit floats first."""
    vector = F.array(*[clean(v).cast("float").cast("double") if single else clean(v) for v in x])

    def layer(h: Column, one: Column) -> Column:
        act = one.getField("act")
        raw = F.zip_with(
            one.getField("w"),
            one.getField("b"),
            lambda weights, bias: bias
            + _total(F.zip_with(weights, h, lambda w, v: w * v)),
        )

        def softmax(values: Column) -> Column:
            # Shifted by the largest value, so that exp stays finite.
            top = F.array_max(values)
            grown = F.transform(values, lambda v: F.exp(v - top))
            return let(grown, lambda g: F.transform(g, lambda v: v / _total(g)))

        return let(
            raw,
            lambda values: F.when(act == "softmax", softmax(values)).otherwise(
                F.transform(values, lambda v: _activate(act, v))
            ),
        )

    return F.aggregate(p.getField("layers"), vector, layer)


def network(x: list[Column], p: Column) -> Column:
    """Label of the best output; the index of the best output for a network without labels."""
    best = argmax(network_outputs(x, p))
    label = label_number(F.get(p.getField("labels"), best))
    return F.when(F.size(p.getField("labels")) > 0, label).otherwise(best.cast("double"))


def dense(x: list[Column], p: Column) -> Column:
    """Index of the best output for 32-bit inputs."""
    return argmax(network_outputs(x, p, single=True)).cast("double")


SCORERS: dict[str, Scorer] = {
    "linear": linear,
    "glm": glm,
    "tree": tree,
    "forest": forest,
    "network": network,
    "dense": dense,
}


# The fields of the parameters that each scorer reads.
NEEDS: dict[str, set[str]] = {
    "linear": {"intercept", "coefs"},
    "glm": {"intercept", "coefs", "exponents", "link"},
    "tree": {"trees", "depth"},
    "forest": {"trees", "depth", "labels"},
    "network": {"layers", "labels"},
    "dense": {"layers"},
}


def possible_forms(fields: list[str]) -> list[str]:
    """The forms that parameters with these fields can have."""
    return [form for form, needed in NEEDS.items() if needed <= set(fields)]


def score(x: list[Column], p: Column, forms: dict[str, Scorer] | list[str] | None = None) -> Column:
    """The score of a record under the parameters next to it, whatever their form.

    Name the `forms` that can occur where they are known: a plan with linear forms only stays in generated code.
    """
    table = SCORERS if forms is None else forms
    if not isinstance(table, dict):
        table = {name: SCORERS[name] for name in table}
    form = p.getField("form")
    chain = None
    for name, scorer in table.items():
        branch = scorer(x, p)
        chain = F.when(form == name, branch) if chain is None else chain.when(form == name, branch)
    return chain
