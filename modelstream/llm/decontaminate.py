"""Benchmark decontamination by winnowing.

A fingerprint is the smallest of `WINDOW - GRAM + 1` consecutive hashes of `GRAM` words. Whatever run of `WINDOW` words a
document and a benchmark item share, both keep the same fingerprint inside it, so every shared run is found. Documents meet
the fingerprints of the benchmark; each meeting is extended to the windows around it, and a window counts if the benchmark
holds it, by two independent hashes of its words. Items with fewer words than a window are windows themselves and are looked up by
their whole length.

Tasks winnow the benchmark into a written table with a row per distinct window: equal items and repeated lines cost nothing
more, and a window names the set of its items, not each item. So the work for a document grows with its words, however often a
passage stands in it or in the benchmark. The table is broadcast in parts within `BLOCK_BYTES`, counted; one part is the usual
case, and then documents are read once and nothing is shuffled. With more, the results are written part by part, and put
together by id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common

WINDOW = 10
GRAM = 5
# Bytes of fingerprints and windows that are sent to the tasks at once: some 40 for each distinct window.
BLOCK_BYTES = 64 << 20

WINDOWS = "item bigint, size int, key bigint, check bigint, gram bigint"
HITS = "doc_id bigint, text_key bigint, n_words bigint, hits array<struct<start:int,end:int>>, items array<bigint>"
SEEN = np.uint64(0xC2B2AE3D27D4EB4F)


def _in_word() -> np.ndarray:
    """Bytes of words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z."""
    out = np.zeros(256, bool)
    out[0x30:0x3A] = out[0x41:0x5B] = out[0x61:0x7B] = out[0x80:] = True
    return out


def _words(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the first word of each row."""
    start, end, first = common.word_bounds(body, at, _in_word())
    return common.span_hashes(common.prefix_sums(body, common.byte_codes(common.lower_ascii())), start, end), first


def winnow(grams: np.ndarray, inside: np.ndarray, size: int) -> np.ndarray:
    """Positions of the smallest of each `size` consecutive grams, the last of equals; `inside` tells the windows that lie in
    one row."""
    n = len(grams) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, where = grams[:n].copy(), np.arange(n)
    for i in range(1, size):
        later = grams[i : i + n] <= best
        best = np.where(later, grams[i : i + n], best)
        where = np.where(later, np.arange(i, i + n), where)
    chosen = np.zeros(len(grams), bool)
    chosen[where[inside[:n]]] = True
    return np.flatnonzero(chosen)


def checks(words: np.ndarray, size: int) -> np.ndarray:
    """A second hash of each `size` consecutive words, of words hashed anew."""
    return common.run_hashes(common.mixed(words ^ SEEN), size)


def _windows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct windows of each item: size, hashes, and the fingerprint that winnowing keeps in it."""
    for batch in common.batches(source, 256):
        for low, high, body, at in common.pieces(batch.column(1)):
            words, first = _words(body, at)
            for i in range(high - low):
                own = words[first[i] : first[i + 1]]
                if not len(own):
                    continue
                size = min(len(own), WINDOW)
                keys = common.run_hashes(own, size)
                keys, where = np.unique(keys, return_index=True)
                if size == WINDOW:
                    grams = common.run_hashes(own, GRAM)
                    gram = np.min(np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1), axis=1)[where]
                else:
                    gram = np.zeros(len(keys), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[low + i].as_py()] * len(keys), pa.int64()),
                        pa.array(np.full(len(keys), size, np.int32)),
                        *[pa.array(x.view(np.int64)) for x in (keys, checks(own, size)[where], gram)],
                    ],
                    ["item", "size", "key", "check", "gram"],
                )


class Fingerprints:
    """A part of the benchmark's windows: by size sorted keys with the check and the set of items of each, and the sorted
    fingerprints of the windows of full size; the items of each set, which may be none."""

    def __init__(self, size: np.ndarray, key: np.ndarray, check: np.ndarray, gram: np.ndarray, of: np.ndarray, items: list[np.ndarray]) -> None:
        self.items, self.sizes = items, {}
        for n in np.unique(size):
            own = np.flatnonzero(size == n)
            own = own[np.argsort(key[own], kind="stable")]
            self.sizes[int(n)] = (key[own], check[own], of[own])
        self.grams = np.unique(gram[size == WINDOW])


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (size, key, check, gram, of) and the sets of items (of, items) that hold them, both written.

    An item without an id has windows like any other, which are in no item's name: its set may be empty.
    """
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = items.filter("text is not null").distinct().mapInArrow(_windows, WINDOWS)
    # The sorted ids of a window: as long as the list that a document with it has to name.
    by_window = found.groupBy("size", "key", "check").agg(F.first("gram").alias("gram"), F.sort_array(F.collect_set("item")).alias("items"))
    by_window = common.stored(by_window.withColumn("of", F.xxhash64("items", F.size("items"))), "benchmark-windows")
    sets = common.stored(by_window.groupBy("of").agg(F.first("items").alias("items")), "benchmark-sets")
    return by_window.drop("items"), sets


def benchmark_parts(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[Fingerprints]:
    """The windows in parts of at most about `limit` bytes, each with the sets of items that it needs, made one after the other."""
    windows, sets = benchmark_windows(benchmark, id_col, text_col)
    size = windows.count() * 40 + (sets.agg(F.sum(F.size("items") * 8 + 64)).first()[0] or 0)
    parts = max(1, -(-int(size) // limit))
    for part in range(parts):
        rows = windows if parts == 1 else windows.filter(F.pmod("of", F.lit(parts)) == part)
        own = sets if parts == 1 else sets.filter(F.pmod("of", F.lit(parts)) == part)
        lists, found = own.toArrow(), rows.toArrow()
        number = {of: i for i, of in enumerate(lists.column("of").to_pylist())}
        columns = [found.column(c).to_numpy() for c in ("size", "key", "check", "gram")]
        yield Fingerprints(
            columns[0],
            *[c.astype(np.int64).view(np.uint64) for c in columns[1:]],
            np.array([number[of] for of in found.column("of").to_pylist()], np.int64),
            [np.array(x, np.int64) for x in lists.column("items").to_pylist()],
        )


def _among(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the values are in a sorted array, and their place there."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def find_windows(words: np.ndarray, row: np.ndarray, bench: Fingerprints) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the benchmark: the first word in the documents, the number of words, the set of items. `row` is the row of
    each word."""
    starts, sizes, sets = [], [], []
    for size, (keys, check, of) in bench.sizes.items():
        n = max(0, len(words) - size + 1)
        inside = row[:n] == row[size - 1 : size - 1 + n]
        if size == WINDOW:
            grams = common.run_hashes(words, GRAM)
            chosen = winnow(grams, inside, WINDOW - GRAM + 1)
            met, _ = _among(grams[chosen], bench.grams)
            # The windows that hold a fingerprint both have.
            around = np.zeros(n + WINDOW, bool)
            for back in range(WINDOW - GRAM + 1):
                a = chosen[met] - back
                around[a[a >= 0]] = True
            start = np.flatnonzero(around[:n] & inside)
        else:
            start = np.flatnonzero(inside)
        if not len(start):
            continue
        met, at = _among(common.run_hashes(words, size)[start], keys)
        met &= checks(words, size)[start] == check[at]
        starts.append(start[met])
        sizes.append(np.full(int(met.sum()), size))
        sets.append(of[at[met]])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(sets)


def covered(start: np.ndarray, size: np.ndarray, words: int) -> list[tuple[int, int]]:
    """The words in any of the runs as disjoint spans in order."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + size, -1)
    inside = np.concatenate([[False], np.cumsum(change) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _search(bench: Fingerprints):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.batches(source):
            n_words, hits, items = [], [], []
            for low, high, body, at in common.pieces(batch.column(2)):
                words, first = _words(body, at)
                row = np.repeat(np.arange(high - low), np.diff(first))
                start, size, of = find_windows(words, row, bench)
                by_row = np.argsort(row[start], kind="stable") if len(start) else start
                cut = np.searchsorted(row[start][by_row], np.arange(high - low + 1)) if len(start) else np.zeros(high - low + 1, int)
                for i in range(high - low):
                    own = by_row[cut[i] : cut[i + 1]]
                    count = int(first[i + 1] - first[i])
                    n_words.append(count)
                    hits.append(covered(start[own] - first[i], size[own], count) if len(own) else [])
                    sets = [bench.items[x] for x in np.unique(of[own])]
                    items.append(np.unique(np.concatenate(sets)).tolist() if sets else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(
                        [[{"start": s, "end": e} for s, e in h] for h in hits],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_words", "hits", "items"],
            )

    return run


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(start.tolist(), end.tolist())):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        hits = [merged(np.array([x["start"] for x in h or []]), np.array([x["end"] for x in h or []])) for h in batch.column(2).to_pylist()]
        names = [sorted(map(str, set(i or []))) for i in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([sum(e - s for s, e in h) for h in hits], pa.int64()),
                pa.array([len(n) for n in names], pa.int64()),
                pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names]),
                pa.array([bool(h) for h in hits]),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, hits (spans of words), items (their ids) of every row of `docs`.

    Other columns are not looked at. A null or wordless text has no words and no hits; a null or wordless item is in no
    document. Items without an id hit words, and have no id to list. Repeated rows get equal answers, equal items all count.
    Empty tables give no rows or no hits.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    parts, last = [], None
    for bench in benchmark_parts(benchmark, item_col, item_text_col, block_bytes):
        if last is not None:
            # Written before the next part is sent, so that one part is in the tasks' memory at a time.
            parts.append(common.stored(docs.mapInArrow(_broadcast_search(last), HITS), "benchmark-hits"))
            last.unpersist()
        last = spark.sparkContext.broadcast(bench)
    parts.append(docs.mapInArrow(_broadcast_search(last), HITS))
    if len(parts) == 1:
        return parts[0].drop("text_key")
    # Each part holds all rows; rows of one id and text are equal, and their number is kept.
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return (
        found.groupBy("doc_id", "text_key")
        .agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_set("hits")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("doc_id", "n_words", "hits", "items", F.explode(F.sequence(F.lit(1), (F.col("n") / len(parts)).cast("int"))))
        .drop("col")
    )


def _broadcast_search(bench):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(bench.value)(source)

    return run


def contamination_digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the items of each row of `contamination`."""
    return found.select("doc_id", "n_words", "hits", "items").mapInArrow(
        _digest,
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no window of the benchmark occurs.

    Null and wordless texts are kept, repeated rows are judged alike; an empty benchmark keeps everything. Parts of a large
    benchmark follow one another, each over what the ones before have kept.
    """
    spark, place, names = docs.sparkSession, docs.columns.index(text_col), docs.columns
    # Arrow functions take columns by name, and a name may hold a dot.
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])
    for part in benchmark_parts(benchmark, item_col, item_text_col, block_bytes):
        bench = spark.sparkContext.broadcast(part)

        def run(source: Iterator[pa.RecordBatch], bench=bench) -> Iterator[pa.RecordBatch]:
            for batch in common.batches(source):
                clean = np.ones(batch.num_rows, bool)
                for low, high, body, at in common.pieces(batch.column(place)):
                    words, first = _words(body, at)
                    row = np.repeat(np.arange(high - low), np.diff(first))
                    start, _, _ = find_windows(words, row, bench.value)
                    clean[low + row[start]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs.toDF(*names)
