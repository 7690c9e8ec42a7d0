"""Scoring by a function outside Spark, many rows per call."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

log = logging.getLogger(__name__)

BatchScorer = Callable[[np.ndarray], np.ndarray]


def batch_score(
    records: DataFrame, features: str, scorer: BatchScorer, *, call_rows: int = 4096, out: str = "result"
) -> DataFrame:
    """`records` with the scorer's value per row in `out`.

    The scorer gets a matrix of up to `call_rows` rows and returns one value per row, or one row of class scores per row,
    of which the first best index counts. Rows of a failed call get null. Select only the columns to keep before: every
    column crosses to Python.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            # Spark writes NaN from Python as null.
            values = np.full(len(rows), np.nan)
            for start in range(0, len(rows), call_rows):
                part = slice(start, start + call_rows)
                try:
                    scores = np.asarray(scorer(np.stack(rows[features].iloc[part].to_list()).astype(float)))
                    values[part] = scores.argmax(axis=1) if scores.ndim == 2 else scores
                except Exception:
                    log.exception("a call to the external scorer failed")
            yield rows.assign(**{out: values})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
    return records.mapInPandas(run, schema=f"{fields}, `{out}` double")
