"""Follow-the-regularised-leader for sparse examples, and the bounded samples it learns from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Example = tuple[np.ndarray, np.ndarray, int]


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: the crc32 of its id as text is 1 modulo 3. False without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(rows: DataFrame, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most `most` rows, those with the smallest hashes of their ids."""
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(most)


class Learner:
    """Multinomial logistic regression learned one example at a time; the last feature is the bias, always 1.

    Per coordinate, the weight is what minimises the past linearised losses plus the elastic-net penalty: zero while the sum of
    the adjusted gradients stays within `l1`. Memory is two numbers per feature that occurred and class, whatever the examples.
    """

    def __init__(
        self, features: int, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1
    ) -> None:
        self.features, self.alpha, self.beta, self.l1, self.l2 = features, alpha, beta, l1, l2
        self.z = np.zeros((features + 1, classes))
        self.squares = np.zeros((features + 1, classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The weights of the features `at`, a row each."""
        return self._weights(self.z[at], self.squares[at])

    def logits(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.append(value, 1.0) @ self.weights(np.append(index, self.features))

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        index, x = np.append(index, self.features), np.append(value, 1.0)
        zi, ni = self.z[index], self.squares[index]
        w = self._weights(zi, ni)
        logit = x @ w
        p = np.exp(logit - logit.max())
        p /= p.sum()
        p[label] -= 1.0
        g = x[:, None] * p[None, :]
        more = ni + g * g
        self.z[index] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / self.alpha * w
        self.squares[index] = more

    def _weights(self, zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        w = -(zi - np.sign(zi) * self.l1) / ((self.beta + np.sqrt(ni)) / self.alpha + self.l2)
        return np.where(np.abs(zi) > self.l1, w, 0.0)


def ftrl(examples: list[Example], features: int, classes: int, epochs: int) -> np.ndarray:
    """Weights (features + 1, classes) after some passes over the examples."""
    learner = Learner(features, classes)
    for _ in range(epochs):
        for example in examples:
            learner.learn(*example)
    return learner.weights().astype(np.float32)


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of `values` from each `first` to the next one; those of empty segments are 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
