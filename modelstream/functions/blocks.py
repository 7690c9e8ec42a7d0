"""Scoring many rows of one model at once, on arrays.

`block_scorer` turns the parameters of a model, as Arrow hands them over, into a function of a matrix of inputs. Networks are one
matrix product per layer. Forests are not walked: the tests of a tree on one feature stand in the order of their
thresholds, each with the bits of the leaves that are still possible when the test and all before it fail, so the leaf of a row is
the first bit that is left of one AND per feature. Trees with more than `LEAVES` leaves, whose bits would take too much
memory, are followed from the root, all rows at once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The bits of a tree take leaves * leaves / 8 bytes: 128 KB for this many.
LEAVES = 1024

# A matrix of inputs to one result per row (NaN: none) and, of models with classes or outputs, a row of shares per row.
BlockScorer = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray | None]]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The lists as rows of `width` numbers: missing and null elements are 0.0, further ones are left out."""
    n = len(vectors)
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(vectors.flatten().cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
    if n and (lengths == lengths[0]).all() and lengths[0] >= width:
        return flat.reshape(n, lengths[0])[:, :width]
    row = np.repeat(np.arange(n), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((n, width))
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out


def _field(params: pa.StructScalar, name: str) -> Any:
    if params.type.get_field_index(name) < 0:
        return None
    value = params[name]
    return value if value.is_valid else None


def _numbers(params: pa.StructScalar, name: str) -> np.ndarray:
    value = _field(params, name)
    return np.zeros(0) if value is None else value.values.to_numpy(zero_copy_only=False).astype(float)


def _label(text: str | None) -> float:
    """The number a label spells; NaN for other text."""
    try:
        return float(text)
    except (TypeError, ValueError):
        return np.nan


def _labels(params: pa.StructScalar) -> np.ndarray:
    value = _field(params, "labels")
    return np.array([] if value is None else [_label(v) for v in value.as_py()])


def _linear(params: pa.StructScalar) -> tuple[int, BlockScorer]:
    coefs, start = np.nan_to_num(_numbers(params, "coefs")), params["intercept"].as_py()

    def run(x: np.ndarray) -> tuple[np.ndarray, None]:
        return sum((c * x[:, i] for i, c in enumerate(coefs)), np.full(len(x), start)), None

    return len(coefs), run


_LINKS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "identity": lambda eta: eta,
    "log": np.exp,
    "logit": lambda eta: 1.0 / (1.0 + np.exp(-eta)),
    "inverse": lambda eta: np.where(eta != 0.0, 1.0 / eta, np.nan),
}


def _glm(params: pa.StructScalar) -> tuple[int, BlockScorer]:
    coefs, start = np.nan_to_num(_numbers(params, "coefs")), params["intercept"].as_py()
    powers = np.ones(len(coefs))
    given = _numbers(params, "exponents")[: len(coefs)]
    powers[: len(given)] = np.where(np.isnan(given), 1.0, given)
    link = _field(params, "link")
    inverse = _LINKS["identity" if link is None else link.as_py()]

    def run(x: np.ndarray) -> tuple[np.ndarray, None]:
        eta = np.full(len(x), start)
        for i, c in enumerate(coefs):
            eta = eta + c * (x[:, i] if powers[i] == 1.0 else np.power(x[:, i], powers[i]))
        return inverse(eta), None

    return len(coefs), run


def _softmax(z: np.ndarray) -> np.ndarray:
    grown = np.exp(z - z.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-z))


def _relu(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0.0)


_ACTIVATIONS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "identity": lambda z: z,
    "logistic": _sigmoid,
    "sigmoid": _sigmoid,
    "tanh": np.tanh,
    "rectifier": _relu,
    "relu": _relu,
    "softmax": _softmax,
}


def _network(params: pa.StructScalar) -> tuple[int, BlockScorer]:
    layers = []
    for one in params["layers"].values:
        rows = one["w"].values
        weights = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        layers.append((weights.T.copy(), one["b"].values.to_numpy(zero_copy_only=False), _ACTIVATIONS[one["act"].as_py()]))
    single = params["form"].as_py() == "dense"
    labels = np.array([]) if single else _labels(params)

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = x.astype(np.float32).astype(float) if single else x
        for weights, bias, activate in layers:
            h = activate(h @ weights + bias)
        best = h.argmax(axis=1)
        return labels[best] if len(labels) else best.astype(float), h

    return layers[0][0].shape[0], run


class _Nodes:
    """The nodes of all trees of a forest in one set of arrays, with the leaves numbered from left to right."""

    def __init__(self, trees: pa.ListArray) -> None:
        nodes = trees.flatten()
        size = pc.list_value_length(trees).to_numpy(zero_copy_only=False).astype(np.int64)
        self.roots = np.cumsum(size) - size

        def column(name: str) -> np.ndarray:
            return nodes.field(name).to_numpy(zero_copy_only=False)

        first = np.repeat(self.roots, size)
        self.feature = column("f").astype(np.int64)
        inner = self.feature >= 0
        self.left, self.right = (first + np.where(inner, np.nan_to_num(column(c).astype(float)), 0).astype(np.int64) for c in "lr")
        self.strict = inner & (column("strict") == True)  # noqa: E712  (null is false)
        self.threshold = column("thr").astype(float)
        # What is below a strict threshold is at most the number before it.
        self.bound = np.where(self.strict, np.nextafter(self.threshold, -np.inf), self.threshold)
        self.bound[np.isnan(self.threshold)] = np.inf
        # Nothing is below minus infinity.
        self.never = self.strict & (self.threshold == -np.inf)
        self.scores = nodes.field("score").to_pylist()
        self.shares = nodes.field("probs")
        levels, level, met = [], self.roots, 0
        while len(level):
            met += len(level)
            if met > len(self.feature):
                raise ValueError("the nodes make no tree")
            levels.append(level)
            inside = level[inner[level]]
            level = np.concatenate([self.left[inside], self.right[inside]])
        self.leaves = np.ones(len(self.feature), np.int64)
        for level in reversed(levels):
            inside = level[inner[level]]
            self.leaves[inside] = self.leaves[self.left[inside]] + self.leaves[self.right[inside]]
        # The number of the first leaf below a node.
        self.low = np.zeros(len(self.feature), np.int64)
        for level in levels:
            inside = level[inner[level]]
            self.low[self.left[inside]] = self.low[inside]
            self.low[self.right[inside]] = self.low[inside] + self.leaves[self.left[inside]]
        self.reached = np.zeros(len(self.feature), bool)
        self.reached[np.concatenate(levels)] = True
        self.inner = inner & self.reached
        self.ends = np.append(self.roots[1:], len(self.feature))

    def leaf_values(self, classes: int) -> np.ndarray:
        """A row of class shares per node (zeros for inner ones), or its number where there are no classes."""
        at = np.flatnonzero(self.reached & ~self.inner)
        out = np.zeros((len(self.feature), max(1, classes)))
        if classes:
            out[at] = self.shares.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        else:
            out[at, 0] = [_label(self.scores[i]) for i in at]
        return out


def _not_between(low: np.ndarray, high: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words with all bits set but those from `low` to before `high`."""

    def below(place: np.ndarray) -> np.ndarray:
        inside = np.clip(place[:, None] - 64 * np.arange(words), 0, 64)
        part = (np.uint64(1) << (inside % 64).astype(np.uint64)) - np.uint64(1)
        return np.where(inside == 64, ~np.uint64(0), part)

    return ~(below(high) & ~below(low))


def _bit_tree(nodes: _Nodes, t: int) -> Callable[[np.ndarray, dict[int, tuple]], np.ndarray]:
    """The node of the leaf of each row by bit vectors, for tree `t`."""
    own = slice(nodes.roots[t], nodes.ends[t])
    inside = nodes.roots[t] + np.flatnonzero(nodes.inner[own])
    ends = nodes.roots[t] + np.flatnonzero((nodes.reached & ~nodes.inner)[own])
    leaf_node = np.empty(len(ends), np.int64)
    leaf_node[nodes.low[ends]] = ends
    words = -(-len(ends) // 64)
    inside = inside[np.lexsort((~nodes.never[inside], nodes.bound[inside], nodes.feature[inside]))]
    left = nodes.left[inside]
    masks = _not_between(nodes.low[left], nodes.low[left] + nodes.leaves[left], words)
    tables = []
    start = np.flatnonzero(np.diff(nodes.feature[inside], prepend=-1))
    for a, b in zip(start, [*start[1:], len(inside)]):
        left_over = np.full((b - a + 1, words), ~np.uint64(0))
        np.bitwise_and.accumulate(masks[a:b], axis=0, out=left_over[1:])
        tables.append((int(nodes.feature[inside[a]]), nodes.bound[inside[a:b]], nodes.never[inside[a:b]], left_over))

    def run(x: np.ndarray, ordered: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        n, bits = len(x), None
        for feature, bound, never, left_over in tables:
            values, place = ordered[feature]
            # Rows up to `pass_` of the ordered ones pass a test, so those beyond fail it and all tests before it.
            pass_ = np.searchsorted(values, bound, side="right")
            pass_[never] = 0
            failed = np.repeat(np.arange(len(bound) + 1), np.diff(pass_, prepend=0, append=n))
            rows = left_over[failed[place]]
            bits = rows if bits is None else np.bitwise_and(bits, rows, out=bits)
        if bits is None:
            return np.full(n, leaf_node[0])
        word = (bits != 0).argmax(axis=1)
        found = bits[np.arange(n), word]
        first = np.frexp((found & (~found + np.uint64(1))).astype(float))[1] - 1
        return leaf_node[64 * word + first]

    return run


def _walked(nodes: _Nodes, t: int) -> Callable[[np.ndarray, dict[int, tuple]], np.ndarray]:
    """The node of the leaf of each row, followed from the root."""

    def run(x: np.ndarray, ordered: dict[int, tuple]) -> np.ndarray:
        at, row = np.full(len(x), nodes.roots[t]), np.arange(len(x))
        while len(row):
            row = row[nodes.inner[at[row]]]
            node = at[row]
            value, threshold = x[row, nodes.feature[node]], nodes.threshold[node]
            left = np.where(nodes.strict[node], value < threshold, value <= threshold)
            at[row] = np.where(left | np.isnan(threshold), nodes.left[node], nodes.right[node])
        return at

    return run


def _forest(params: pa.StructScalar) -> tuple[int, BlockScorer]:
    trees, labels = params["trees"].values, _labels(params)
    nodes = _Nodes(trees)
    values = nodes.leaf_values(len(labels))
    width = int(nodes.feature.max(initial=-1)) + 1
    used = np.unique(nodes.feature[nodes.inner])
    each = [_bit_tree(nodes, t) if nodes.leaves[r] <= LEAVES else _walked(nodes, t) for t, r in enumerate(nodes.roots)]
    single = params["form"].as_py() == "tree"
    own = np.array([_label(s) for s in nodes.scores]) if single else None

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        ordered = {}
        for f in used:
            order = np.argsort(x[:, f], kind="stable")
            place = np.empty(len(x), np.int64)
            place[order] = np.arange(len(x))
            ordered[int(f)] = (x[order, f], place)
        total = np.zeros((len(x), values.shape[1]))
        for tree in each:
            leaf = tree(x, ordered)
            total += values[leaf]
        shares = total / len(each)
        if single:
            return own[leaf], shares if len(labels) else None
        return (labels[shares.argmax(axis=1)], shares) if len(labels) else (shares[:, 0], None)

    return width, run


_FORMS = {"linear": _linear, "glm": _glm, "tree": _forest, "forest": _forest, "network": _network, "dense": _network}


def block_scorer(params: pa.StructScalar) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray | None]]:
    """The scorer of a model over lists of inputs."""
    width, run = _FORMS[params["form"].as_py()](params)

    def score(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
        with np.errstate(all="ignore"):
            return run(matrix(vectors, width))

    return score
