"""One known model written into the plan as plain arithmetic and CASE expressions.

The data-driven scorers carry the model with each row. When a whole table is scored with one model, its parameters are
literals instead: no array is copied or walked per row, and the scan, filters and score share one generated stage. The
expressions are SQL text, which Spark parses in one go.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Params = dict[str, Any]

# Levels of a tree that are written as nested CASE expressions; what is deeper is scored as data.
NESTED = 24
FORMS = ("linear", "glm", "tree", "forest", "network", "dense")


def writable(params: Params | None) -> bool:
    """Can this model be written into a plan? The answers are those of the scoring as data."""
    return params is None or params["form"] in FORMS and (params.get("depth") or 0) <= NESTED


def number(value: float) -> str:
    """A double literal."""
    if not math.isfinite(value):
        return f"CAST('{float(value)!r}' AS DOUBLE)"
    text = f"{float(value)!r}D"
    return f"({text})" if text.startswith("-") else text


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_of(values: list[Any]) -> str:
    """A constant array, folded once by the optimizer."""
    return "array(" + ", ".join("CAST(NULL AS DOUBLE)" if v is None else number(v) for v in values) + ")"


def best_of(columns: list[str]) -> str:
    """Index of the largest column, the first of equals."""
    top = f"greatest({', '.join(columns)})" if len(columns) > 1 else columns[0]
    return "CASE " + " ".join(f"WHEN {c} = {top} THEN {i}" for i, c in enumerate(columns)) + " END"


def label_of(labels: list[str], index: str) -> str:
    """The label at an index as a number; null for a label that spells none."""
    return f"try_cast(get(array({', '.join(text(label) for label in labels)}), {index}) AS DOUBLE)"


def linear(x: list[str], params: Params) -> str:
    terms = [f"{number(c)} * {v}" for c, v in zip(params["coefs"], x)]
    return " + ".join([number(params["intercept"]), *terms])


def glm(x: list[str], params: Params) -> str:
    powers = params.get("exponents") or [1.0] * len(params["coefs"])
    terms = [
        f"{number(c)} * {v if e == 1.0 else f'power({v}, {number(e)})'}"
        for c, e, v in zip(params["coefs"], powers, x)
    ]
    eta = " + ".join([number(params["intercept"]), *terms])
    return {
        "identity": eta,
        "log": f"exp({eta})",
        "logit": f"1D / (1D + exp(-({eta})))",
        "inverse": f"1D / nullif({eta}, 0D)",
    }[params.get("link") or "identity"]


def tree_leaf(x: list[str], nodes: list[Params], position: int = 0) -> str:
    """Position of the leaf the inputs lead to, as a nested CASE."""
    node = nodes[position]
    if node["f"] < 0:
        return str(position)
    value = x[node["f"]] if node["f"] < len(x) else "0D"
    test = f"{value} {'<' if node['strict'] else '<='} {number(node['thr'])}"
    return f"CASE WHEN {test} THEN {tree_leaf(x, nodes, node['l'])} ELSE {tree_leaf(x, nodes, node['r'])} END"


_ACTIVATIONS = {
    "identity": "{0}",
    "logistic": "1D / (1D + exp(-({0})))",
    "sigmoid": "1D / (1D + exp(-({0})))",
    "tanh": "tanh({0})",
    "rectifier": "greatest({0}, 0D)",
    "relu": "greatest({0}, 0D)",
}


def _stage(df: DataFrame, columns: dict[str, str], when: str | None = None) -> DataFrame:
    return df.withColumns({name: F.expr(_only(text, when)) for name, text in columns.items()})


def _only(text: str, when: str | None) -> str:
    return text if when is None else f"CASE WHEN {when} THEN {text} END"


def _tree_score(node: Params) -> float | None:
    """The score of a leaf; None for a label that spells no number."""
    try:
        return float(node["score"]) if node["f"] < 0 and node["score"] is not None else None
    except ValueError:
        return None


def with_score(
    df: DataFrame, inputs: list[str], params: Params, out: str = "result", when: str | None = None
) -> DataFrame:
    """`df` with the score of one model in column `out`, and class shares in `{out}_probs` where the model has them.

    `inputs` are SQL expressions over `df`, in the order of the model's features; null counts as 0.0. Leaf positions and
    layer outputs are columns of their own while they are needed, so no later expression repeats them. With `when`, a
    condition in SQL, only the rows it holds for are scored.
    """
    before = df.columns
    form = params["form"]
    single = form == "dense"
    clean = [
        f"CAST(CAST(coalesce({v}, 0D) AS FLOAT) AS DOUBLE)" if single else f"coalesce(CAST({v} AS DOUBLE), 0D)"
        for v in inputs
    ]
    if form == "linear":
        return _stage(df, {out: linear(clean, params)}, when)
    if form == "glm":
        return _stage(df, {out: glm(clean, params)}, when)
    if form in ("tree", "forest"):
        staged, results = _trees(df, clean, params, out, when)
    elif form in ("network", "dense"):
        staged, results = _layers(df, clean, params, out, when)
    else:
        raise ValueError(f"unknown model form {form!r}")
    kept = [F.col(f"`{c}`") for c in before if c not in results]
    return staged.select(*kept, *[F.expr(_only(text, when)).alias(name) for name, text in results.items()])


def _trees(
    df: DataFrame, x: list[str], params: Params, out: str, when: str | None
) -> tuple[DataFrame, dict[str, str]]:
    trees, labels = params["trees"], params.get("labels") or []
    leaves = [f"__{out}_leaf{i}" for i in range(len(trees))]
    staged = _stage(df, {c: tree_leaf(x, t) for c, t in zip(leaves, trees)}, when)

    def mean(value) -> str:
        each = [f"get({array_of([value(n) for n in t])}, {c})" for c, t in zip(leaves, trees)]
        return f"({' + '.join(each)}) / {number(len(trees))}"

    if not labels:
        return staged, {out: mean(_tree_score)}
    shares = [f"__{out}_share{i}" for i in range(len(labels))]
    staged = _stage(
        staged,
        {c: mean(lambda n, i=i: n["probs"][i] if n["f"] < 0 else None) for i, c in enumerate(shares)},
        when,
    )
    if params["form"] == "tree":
        # The label a node carries decides, also where two classes have the same count.
        best = f"get({array_of([_tree_score(n) for n in trees[0]])}, {leaves[0]})"
    else:
        best = label_of(labels, best_of(shares))
    return staged, {out: best, f"{out}_probs": f"array({', '.join(shares)})"}


def _layers(
    df: DataFrame, x: list[str], params: Params, out: str, when: str | None
) -> tuple[DataFrame, dict[str, str]]:
    values = [f"__{out}_x{i}" for i in range(len(x))]
    df = _stage(df, dict(zip(values, x)), when)
    for depth, layer in enumerate(params["layers"]):
        names = [f"__{out}_h{depth}_{i}" for i in range(len(layer["b"]))]
        raw = [
            f"{number(b)} + ({' + '.join(['0D', *[f'{number(w)} * {v}' for w, v in zip(row, values)]])})"
            for row, b in zip(layer["w"], layer["b"])
        ]
        if layer["act"] == "softmax":
            # Shifted by the largest value, so that exp stays finite.
            sums = [f"{n}_raw" for n in names]
            grown = [f"{n}_exp" for n in names]
            df = _stage(df, dict(zip(sums, raw)), when)
            top = f"greatest({', '.join(sums)})" if len(sums) > 1 else sums[0]
            df = _stage(df, {g: f"exp({s} - {top})" for g, s in zip(grown, sums)}, when)
            df = _stage(df, {n: f"{g} / ({' + '.join(grown)})" for n, g in zip(names, grown)}, when)
        else:
            df = _stage(df, {n: _ACTIVATIONS[layer["act"]].format(r) for n, r in zip(names, raw)}, when)
        values = names
    best = best_of(values)
    labels = params.get("labels") or []
    result = label_of(labels, best) if labels else f"CAST({best} AS DOUBLE)"
    return df, {out: result, f"{out}_probs": f"array({', '.join(values)})"}
