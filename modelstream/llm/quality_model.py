"""A quality classifier: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of signs. Features are the hashes of tokens and of pairs of neighbouring
tokens, and the same for the tokens' shapes (capitals and length), which speak for words that were never seen. A text is the
share of each feature among its own, so long and short texts are on one scale; its score is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common, linear

BITS = 18
# Labelled texts the model is fitted on, at most.
SAMPLE = 6000
EPOCHS = 4
SCALE = 6.0


def _tokens(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens and the first token of each row."""
    kind = np.full(256, 2, np.uint8)
    kind[0x30:0x3A] = kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0x80:] = 1
    kind[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    k = kind[body]
    edge = np.ones(len(body) + 1, bool)
    edge[1:-1] = k[1:] != k[:-1]
    edge[at[at < len(body)]] = True
    cut = np.flatnonzero(edge)
    start, end = cut[:-1], cut[1:]
    real = k[start] > 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    return start, end, np.searchsorted(start, at)


def features(body: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Four feature numbers of every token (itself, with its predecessor, and both for shapes) and each row's first token."""
    start, end, first = _tokens(body, at)
    words = common.span_hashes(common.prefix_sums(body, common.byte_codes()), start, end)
    capitals = np.zeros(len(body) + 1, np.int64)
    np.cumsum((body >= 65) & (body <= 90), out=capitals[1:])
    upper = capitals[end] - capitals[start]
    size = end - start
    sign = ~(((body[start] | 32) >= 97) & ((body[start] | 32) <= 122) | (body[start] >= 128) | ((body[start] >= 48) & (body[start] <= 57))) if len(start) else np.zeros(0, bool)
    shape = np.where(sign, words >> np.uint64(1), np.minimum(size, 12) // 2 * 4 + np.minimum(upper, 1) + (upper == size) + 2000).astype(np.uint64)
    shape = common.mixed(shape + np.uint64(99))
    begins = np.zeros(len(start), bool)
    begins[first[:-1][first[:-1] < len(start)]] = True
    out = []
    for salt, x in ((1, words), (2, shape)):
        before = np.zeros(len(x), np.uint64)
        before[1:] = x[:-1]
        before[begins] = 0
        for k, h in ((0, x), (1, before * np.uint64(common.RUN) + x)):
            out.append((common.mixed(h + np.uint64(10 * salt + k)) >> np.uint64(64 - BITS)).astype(np.int32))
    return out, first


def _examples(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 256):
        index, value = [], []
        for low, high, body, at in common.pieces(batch.column(2)):
            columns, first = features(body, at)
            for i in range(high - low):
                own = np.concatenate([c[first[i] : first[i + 1]] for c in columns])
                feature, count = np.unique(own, return_counts=True)
                index.append(feature.astype(np.int32))
                value.append((SCALE * count / max(1, len(own))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
            ["doc_id", "label", "index", "value"],
        )


def _fit(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    examples = [(np.asarray(i, np.int64), np.asarray(v, np.float64), int(y)) for part in source for i, v, y in zip(part["index"], part["value"], part["label"])]
    weights = linear.ftrl(examples, 1 << BITS, 2, EPOCHS)
    yield pd.DataFrame({"weights": [(weights[:, 1] - weights[:, 0]).astype(np.float32).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> np.ndarray:
    """Weights by feature, the last one the bias, from at most `most` labelled rows outside the held-out third."""
    ids = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("label"))
        .filter(~linear.held_out(F.col("doc_id")))
    )
    ids = linear.bounded_sample(ids, most)
    rows = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(ids), "doc_id")  # at most `most` rows of two numbers
        .select("doc_id", "label", "text")
    )
    examples = rows.mapInArrow(_examples, "doc_id bigint, label int, index array<int>, value array<float>")
    fitted = (
        examples.repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "doc_id", "index")
        .select("label", "index", "value")
        .mapInPandas(_fit, "weights binary")
        .first()
    )
    if fitted is None:
        return np.zeros((1 << BITS) + 1, np.float32)
    return np.frombuffer(fitted["weights"], np.float32)


def _score(weights):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in common.batches(source):
            scores = []
            for low, high, body, at in common.pieces(batch.column(1)):
                columns, first = features(body, at)
                sums = linear.segment_sums(sum(w[c] for c in columns), first)
                n = 4 * np.diff(first)
                scores.append(SCALE * sums / np.maximum(n, 1) + w[-1])
            logit = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(logit, -40, 40))), pa.float64())], ["doc_id", "score"]
            )

    return run


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Only texts are looked at for a score. A null or empty text has the score of the bias alone. Of several labels
    of one document the lowest counts, labels other than 0 and 1 do not; repeated rows of a labelled document are as many examples. Rows
    without an id are scored, not learned from. Without labels every score is 0.5. Empty input gives an empty result.
    """
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(train(docs, labels, id_col, text_col, most))
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = slim.mapInArrow(_score(weights), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        linear.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
