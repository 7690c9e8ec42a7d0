"""One model, read into plain Python values for `modelstream.functions.compiled`."""

from __future__ import annotations

from functools import lru_cache
from typing import Any

from pyspark.sql import SparkSession

from modelstream.sources.documents import parse_document, parse_layers


@lru_cache(maxsize=64)
def _load(spark: SparkSession, text: str, names: tuple[str, ...]) -> dict[str, Any]:
    parser = parse_layers if text.lstrip().startswith("{") else parse_document
    one = spark.createDataFrame([(text,)], "text string")
    params = parser(one, "text", list(names), "params").first()["params"]
    if params is None:
        raise ValueError("the model document cannot be built")
    return params.asDict(recursive=True)


def load_model(spark: SparkSession, text: str, names: list[str]) -> dict[str, Any]:
    """The parameters of one document (XML, or JSON layers); `names` are the inputs in the order of the features."""
    return _load(spark, text, tuple(names))
