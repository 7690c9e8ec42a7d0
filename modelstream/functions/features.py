"""Feature vectors, arg-max and labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_vector(columns: list[Column]) -> Column:
    """The inputs as one array of 32-bit floats."""
    return F.array(*[c.cast("float") for c in columns])


def vector_columns(vector: Column, width: int) -> list[Column]:
    """The first `width` elements of an array column as separate columns; a missing element is 0.0."""
    return [F.coalesce(F.get(vector, F.lit(i)), F.lit(0.0)) for i in range(width)]


def value_by_name(names: list[str], columns: list[Column], name: Column) -> Column:
    """The input called `name`, 0.0 for a name that no input has."""
    known = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*columns))
    return F.coalesce(F.try_element_at(known, name), F.lit(0.0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once however often `body` mentions it."""
    return F.get(F.transform(F.array(value), body), 0)


def argmax(scores: Column) -> Column:
    """Index of the largest score, the first of equals."""
    return let(scores, lambda s: F.array_position(s, F.array_max(s)) - F.lit(1)).cast("int")


def argmax_columns(scores: list[Column]) -> Column:
    """`argmax` over separate columns, all inside generated code."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    choice = F.when(scores[0] == best, F.lit(0))
    for i, score in enumerate(scores[1:], start=1):
        choice = choice.when(score == best, F.lit(i))
    return choice


def label_number(label: Column) -> Column:
    """A class label as the number it spells; null for other text."""
    return label.try_cast("double")
