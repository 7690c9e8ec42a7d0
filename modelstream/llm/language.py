"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased, whatever is no letter is one blank. Runs of one to three of them are hashed into buckets. Document frequencies
come from all labelled rows outside the held-out third; the weights from a bounded sample of them by
follow-the-regularised-leader with an elastic-net penalty; a temperature fitted on a part of the sample that was not
learned from makes the probabilities honest. Examples pass the learner as rows in order, each epoch's after the other, so it
holds no more than its sums; the weights that are not zero are kept, sent and multiplied alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelstream.llm import common, linear

BITS = 16
# Texts of one language the model is fitted on, at most, and of all languages: more than 200 share them, with no fewer than
# `LEAST` each.
SAMPLE = 1500
EXAMPLES = 300_000
LEAST = 20
EPOCHS = 2
SCALE = 4.0
# Rows counted together in the pass for document frequencies.
COUNTED = 128
# Weights that a prediction looks at together, those of one n-gram at least.
CELLS = 1 << 22
# Divisors of the logits that are tried.
TEMPERATURES = np.geomspace(0.05, 20, 121)


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is a letter, and its lower case where that is one code point; else 32."""
    lower = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    return lower != 32, lower


def code_points(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and the offsets of the rows in them."""
    first = (body & 0xC0) != 0x80
    start = np.flatnonzero(first)
    lead = body[start].astype(np.uint32)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    point = np.where(size == 1, lead, np.where(size == 2, lead & 0x1F, np.where(size == 3, lead & 0x0F, lead & 0x07)))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        point[more] = (point[more] << 6) | (body[start[more] + k] & 0x3F)
    return point, np.searchsorted(start, at)


def grams(body: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams that begin at each character (n = 1, 2, 3; an n-gram over the end of its row counts with
    blanks), the offsets of the rows, and whether each row has a letter."""
    point, first = code_points(body, at)
    letter, lower = _letters()
    c = lower[point]
    has = np.zeros(len(first) - 1, bool)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    has[row[letter[point]]] = True
    second = np.full(len(c), 32, np.uint32)
    third = np.full(len(c), 32, np.uint32)
    second[:-1] = c[1:]
    third[:-2] = c[2:]
    last = first[1:][np.diff(first) > 0] - 1
    second[last] = 32
    third[last] = 32
    third[last[np.diff(first)[np.diff(first) > 0] > 1] - 1] = 32
    out = []
    h = np.zeros(len(c), np.uint32)
    for n, x in enumerate((c, second, third)):
        h = (h + x + np.uint32(n)) * np.uint32(0x9E3779B1)
        h = h ^ (h >> np.uint32(15))
        out.append(((h * np.uint32(0x85EBCA77)) >> np.uint32(32 - BITS)).astype(np.int32))
    return out, first, has


def _frequencies(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket and number of rows of this task with it; the number of rows as bucket -1."""
    counts, rows = np.zeros(1 << BITS, np.int64), 0
    for batch in common.batches(source, COUNTED):
        for low, high, body, at in common.pieces(batch.column(0)):
            columns, first, _ = grams(body, at)
            seen = np.zeros((high - low, 1 << BITS), bool)
            row = np.repeat(np.arange(high - low), np.diff(first))
            for c in columns:
                seen[row, c] = True
            counts += seen.sum(axis=0)
            rows += high - low
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(counts[used], rows), pa.int64())], ["bucket", "n"]
    )


def _examples(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 256):
        index, value = [], []
        for low, high, body, at in common.pieces(batch.column(2)):
            columns, first, _ = grams(body, at)
            for i in range(high - low):
                own = np.concatenate([c[first[i] : first[i + 1]] for c in columns])
                feature, count = np.unique(own, return_counts=True)
                index.append(feature.astype(np.int32))
                value.append((count / max(1, len(own))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
            ["doc_id", "lang", "index", "value"],
        )


def losses(logits: np.ndarray, label: int) -> np.ndarray:
    """The negative log-likelihood of a label at each temperature."""
    z = (logits - logits.max())[None, :] / TEMPERATURES[:, None]
    return np.log(np.exp(z).sum(axis=1)) - z[:, label]


@dataclass
class Model:
    """Weights that are not zero, in order of their buckets; `start` tells where a bucket's begin. Inverse document frequencies are
    folded in."""

    names: list[str]
    start: np.ndarray
    language: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float

    def sums(self, columns: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        """For each row the sum of the weights of its n-grams, by language."""
        classes = len(self.names)
        out = np.zeros((len(first) - 1) * classes)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for buckets in columns:
            size = self.start[buckets + 1] - self.start[buckets]
            total = np.append(0, np.cumsum(size))
            low = 0
            while low < len(buckets):
                high = max(low + 1, int(np.searchsorted(total, total[low] + CELLS, side="right")) - 1)
                n, stop = size[low:high], total[low + 1 : high + 1] - total[low]
                at = np.repeat(self.start[buckets[low:high]] - (stop - n), n) + np.arange(stop[-1])
                base = row[low] * classes
                cell = np.repeat(row[low:high] * classes - base, n) + self.language[at]
                found = np.bincount(cell, self.weight[at])
                out[base : base + len(found)] += found
                low = high
        return out.reshape(-1, classes)


def _fit(idf, classes: int):
    """Rows (bucket, language, weight) of the weights that are not zero; bucket 1 << BITS is the bias, -1 has the temperature."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, loss, scale = linear.Learner(1 << BITS, classes), np.zeros(len(TEMPERATURES)), SCALE * idf.value

        def rows(bucket: np.ndarray, language: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), pa.array(language, pa.int32()), pa.array(weight, pa.float64())],
                ["bucket", "language", "weight"],
            )

        for batch in source:
            epoch, label = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = np.append(0, np.cumsum(batch.column(2).value_lengths().to_numpy()))
            index, value = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            for k in range(batch.num_rows):
                own = index[at[k] : at[k + 1]].astype(np.int64)
                x = value[at[k] : at[k + 1]].astype(np.float64) * scale[own]
                if epoch[k] < EPOCHS:
                    learner.learn(own, x, label[k])
                else:
                    loss += losses(learner.logits(own, x), label[k])
        best = TEMPERATURES[int(np.argmin(loss))] if loss.any() else 1.0
        yield rows(np.array([-1]), np.array([0]), np.array([best]))
        folded = np.append(scale, 1.0)
        step = max(1, CELLS // classes)
        for low in range(0, len(folded), step):
            weights = learner.weights(slice(low, low + step)) * folded[low : low + step, None]
            bucket, language = np.nonzero(weights)
            yield rows(low + bucket, language, weights[bucket, language])

    return run


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> Model | None:
    """The model; None if nothing can be learned. A fifth of each language's sample, its fifth example and every fifth one
    after it, is kept for the temperature.

    One task learns. It holds two numbers for each bucket that occurs and language, and what comes to the driver and is broadcast are at
    most as many weights; the penalty leaves few of many languages'.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~linear.held_out(F.col("doc_id")))
    counted = rows.select("text").mapInArrow(_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total, df = 0, np.zeros(1 << BITS)
    for r in counted:
        if r.bucket < 0:
            total = r.n
        else:
            df[r.bucket] = r.n
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    per = common.stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")), "language-counts")
    # The rows of a language with the smallest hashes of their ids: `most` of them, or the language's share, up to the
    # evenness of the hash.
    share = min(most, max(LEAST, EXAMPLES // per.count()))
    bound = F.lit(float(1 << 40)) * share / F.col("n")
    sample = rows.join(F.broadcast(per), "lang").filter(place < bound).select("doc_id", "lang", "text")
    # Of a language whose few ids all have larger hashes one row is taken.
    missed = per.filter(F.col("least") >= bound)
    if not missed.isEmpty():
        one = rows.join(F.broadcast(missed), "lang").filter(place == F.col("least")).groupBy("lang")
        sample = sample.unionByName(one.agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")))
    names = sorted(r.lang for r in per.select("lang").collect())
    numbers = spark.createDataFrame(list(zip(names, range(len(names)))), "lang string, label int")
    order = [F.xxhash64("doc_id", F.lit(7)), "doc_id", "index", "value"]
    kept = F.row_number().over(Window.partitionBy("lang").orderBy(*order)) % 5 == 0
    epochs = F.when(F.col("kept"), F.array(F.lit(EPOCHS))).otherwise(F.sequence(F.lit(0), F.lit(EPOCHS - 1)))
    examples = sample.mapInArrow(_examples, "doc_id bigint, lang string, index array<int>, value array<float>")
    fitted = (
        examples.withColumn("kept", kept)
        .select("*", F.explode(epochs).alias("epoch"))
        .join(F.broadcast(numbers), "lang")  # a row per language
        .repartition(1)
        .sortWithinPartitions("epoch", order[0], "doc_id", "label", "index", "value")
        .select("epoch", "label", "index", "value")
        .mapInArrow(_fit(spark.sparkContext.broadcast(idf), len(names)), "bucket int, language int, weight double")
        .toArrow()
    )
    bucket, language, weight = (fitted[c].to_numpy() for c in ("bucket", "language", "weight"))
    bias = np.zeros(len(names))
    bias[language[bucket == 1 << BITS]] = weight[bucket == 1 << BITS]
    inner = np.flatnonzero((bucket >= 0) & (bucket < 1 << BITS))
    inner = inner[np.lexsort((language[inner], bucket[inner]))]
    start = np.searchsorted(bucket[inner], np.arange((1 << BITS) + 1))
    return Model(names, start, language[inner], weight[inner], bias, float(weight[bucket == -1][0]))


def _predict(shared):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in common.batches(source):
            best, score = [], []
            for low, high, body, at in common.pieces(batch.column(1), common.PIECE_BYTES // 2):
                columns, first, has = grams(body, at)
                if model is None:
                    best += ["und"] * (high - low)
                    score += [0.0] * (high - low)
                    continue
                z = (model.sums(columns, first) / np.maximum(3 * np.diff(first), 1)[:, None] + model.bias) / model.temperature
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                top = z.argmax(axis=1)
                best += [model.names[k] if ok else "und" for k, ok in zip(top, has)]
                score += [float(z[i, k]) if ok else 0.0 for i, (k, ok) in enumerate(zip(top, has))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return run


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    Only the text is looked at for a prediction. A null text or one without a letter is `und` with score 0, as is everything if
    nothing could be learned. Rows without a language or an id are predicted, not learned from. Every other language with
    a row that is not held out is learned, from `most` rows at most. Repeated rows are as many examples. Of equal probabilities the first language in order is taken. Empty input gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, most))
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = slim.mapInArrow(_predict(model), "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", linear.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
