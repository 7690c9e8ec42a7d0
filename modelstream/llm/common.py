"""What the text operators share: tables, stored intermediates, and words of many texts at once as arrays.

The array helpers treat the UTF-8 bytes of a piece of an Arrow batch as one buffer with the offsets of its rows. Words,
their hashes and the hashes of runs of words then cost a few array passes per byte, without an object per word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from modelstream.config import ship_package, work_folder
from modelstream.streaming.snapshots import Folder

# Bytes of text that array helpers look at together. A longer text is looked at whole, alone.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of the query that made them, not when the driver happens to collect its garbage. Only for
    queries whose result is written: nothing reads their shuffles again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back: computed once, and safe when an executor is lost.

    The folder stays until the owner of the shared folder clears it, because the frame that is returned reads from it.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    with tidy_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator in the shared folder, removed as soon as the next ones are written.

    A frame that `keep` returned may be read until its name is dropped.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark, self.root = spark, work_folder(spark, purpose)
        self.folder, self.there, self.count = Folder(spark, self.root), {}, 0

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """`df` written and read back."""
        self.count += 1
        path = f"{self.count:04d}-{name}"
        with tidy_shuffles(self.spark):
            df.write.parquet(f"{self.root}/{path}")
        self.there.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    def drop(self, *names: str, newest: int = 0) -> None:
        """Remove the tables of these names but the `newest` ones of each."""
        for name in names:
            paths = self.there.get(name, [])
            gone = paths[: len(paths) - newest]
            for path in gone:
                self.folder.remove(path)
            self.there[name] = paths[len(gone) :]


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]] if len(column) else body[:0], at - at[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most `limit` bytes, or one longer row: first row, end row, bytes, offsets."""
    if not len(column):
        return
    body, at = rows_of(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
        yield low, high, body[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def batches(source: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most `rows` rows, without empty ones."""
    for batch in source:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


# An odd multiplier of the byte polynomial, its inverse modulo 2**64, and the multiplier for runs of words.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
RUN = 0xD6E8FEB86659FD93


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    return _powers(base, 1 << max(20, int(size).bit_length()))[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit values spread over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii() -> np.ndarray:
    """Each byte, A to Z as a to z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def byte_codes(fold: np.ndarray | None = None, seed: int = 1) -> np.ndarray:
    """A 64-bit value for each byte, the same for bytes that `fold` makes equal."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(seed))
    return codes if fold is None else codes[fold]


def prefix_sums(body: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of `body`."""
    out = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(codes[body] * powers(BASE, max(1, len(body)))[: len(body)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, wherever it stands."""
    return mixed((sums[end] - sums[start]) * powers(INVERSE, max(1, len(sums)))[start] + (end - start).astype(np.uint64))


def word_bounds(body: np.ndarray, at: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with `in_word`, and the first word of each row (one more at the end)."""
    flag = in_word[body]
    opens = flag.copy()
    opens[1:] &= ~flag[:-1]
    closes = flag.copy()
    closes[:-1] &= ~flag[1:]
    first = at[:-1][at[:-1] < at[1:]]
    opens[first] = flag[first]
    closes[first[first > 0] - 1] = flag[first[first > 0] - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, at)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each `size` consecutive words; rows are not looked at."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(RUN) + words[i : i + n]
    return mixed(out)


def white_words() -> np.ndarray:
    """Whether a byte belongs to a word `[^\\x20\\x09-\\x0D]+`."""
    out = np.ones(256, bool)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return out
