"""Removal of long repeated substrings by suffix arrays of bounded blocks.

Two equal strings of `LENGTH` bytes have the same anchor: the hash of `GRAM` bytes that is smallest among all those inside,
the first of equals. Consecutive strings with one anchor make a *stretch* (as super-k-mers do), so equal strings always lie in stretches of one
anchor.

1. Every text is cut into stretches: place, anchor and digest, without its bytes. Counting digests settles a stretch that
   occurs twice as a whole, and with it most copies and passages, before any bytes move.
2. An anchor with one distinct stretch needs no more. For the others, one occurrence of each distinct stretch is fetched.
3. Equal strings of two stretches lie alike around their anchor, so one side of it, half of what a string has beyond the anchor,
   is equal in full. Stretches that share neither side with another one of their anchor hold no repeated string and are left out.
   Tasks lay the others of whole anchors side by side in blocks, build the suffix array of the block, and find
   the strings that occur twice by breadth-first backward extension on its Burrows-Wheeler transform: the boundaries between
   suffixes with common prefixes of length v give those of length v + 1 through the last-to-first mapping, and what has
   no boundary when `LENGTH` is reached is a repeated string.
   An anchor with more distinct stretches than a block holds is cut by the digest of its strings instead, in the same two
   aggregations for all of it, so no task has to hold it. Its stretches stay where their documents are until then: they
   carry a flag, and are never gathered by anchor.
4. The repeated strings of the distinct stretches are joined with all their occurrences and united per document.

Joins on an anchor, a string or a stretch deal the rows of heavy keys (a common passage, say) over many tasks by a salt.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common
from modelstream.plans.sizes import salted_sides

LENGTH = 400
GRAM = 32
# Bytes of distinct stretches that a block holds, and that an anchor may have to go into a block.
BLOCK_BYTES = 1 << 20

STRETCHES = "row_key bigint, n_bytes bigint, start int, strings int, place int, anchor bigint, digest bigint"


def window_minima(keys: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each `size` consecutive keys: minima of prefixes and suffixes of blocks of that size."""
    n = len(keys) - size + 1
    padded = np.full(-(-len(keys) // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])


def stretches(body: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, first string (from the start of the row), number of strings, anchor, digest and the place of the anchor (from the
    start of the stretch) of every stretch."""
    none = np.zeros(0, np.int64)
    if len(body) < length:
        return none, none, none, none, none, none
    sums = common.prefix_sums(body, common.byte_codes(seed=7))
    begin = np.arange(len(body) - gram + 1)
    hashes = common.span_hashes(sums, begin, begin + gram)
    # A place takes the low bits of the key, so the first of equals is the smallest.
    low = np.uint64((1 << max(27, int(len(body)).bit_length())) - 1)
    best = (window_minima((hashes & ~low) | begin.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
    row = np.searchsorted(at, np.arange(len(best)), side="right") - 1
    valid = np.arange(len(best)) + length <= at[row + 1]
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new & valid)
    if not len(first):
        return none, none, none, none, none, none
    ids = np.cumsum(new) - 1
    strings = np.bincount(ids, weights=valid)[ids[first]].astype(np.int64)
    end = first + strings + length - 1
    digest = common.mixed(common.span_hashes(sums, first, end) + (best[first] - first).astype(np.uint64))
    anchor = hashes[best[first]].view(np.int64)
    return row[first], first - at[row[first]], strings, anchor, digest.view(np.int64), best[first] - first


def _stretches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row_key", "n_bytes", "start", "strings", "place", "anchor", "digest"]
    for batch in common.batches(source):
        keys = batch.column(0).to_numpy()
        for low, high, body, at in common.pieces(batch.column(1)):
            row, start, strings, anchor, digest, place = stretches(body, at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[low:high][row], pa.int64()),
                    pa.array(np.diff(at)[row], pa.int64()),
                    pa.array(start, pa.int32()),
                    pa.array(strings, pa.int32()),
                    pa.array(place, pa.int32()),
                    pa.array(anchor, pa.int64()),
                    pa.array(digest, pa.int64()),
                ],
                names,
            )


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The suffixes of `text` in the order of their first `depth` symbols, and their ranks by prefixes of 1, 2, 4, ..."""
    n = len(text)
    ranks, size = {1: np.unique(text, return_inverse=True)[1].astype(np.int64)}, 1
    while True:
        rank = ranks[size]
        step = min(size, depth - size)
        other = np.full(n, -1, np.int64)
        other[: n - step] = rank[step:]
        key = rank * (n + 1) + other + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        size += step
        ranks[size] = rank
        if size >= depth or new.all():
            return order, ranks


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the `length` symbols from each place on occur more than once. Symbols that must not be matched occur once.

    Common prefixes come in increasing value: `bound[i]` is set once the suffixes before and at rank i are known to differ
    within the value reached. The first values come from the ranks of the sort, further ones by backward extension.
    """
    n = len(text)
    if n < 2:
        return np.zeros(n, bool)
    order, ranks = suffix_array(text, length)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    # Last-to-first: the rank of the suffix that is one symbol longer, and the reverse.
    longer = place[order - 1]
    longer[order == 0] = -1
    shorter = np.full(n, -1, np.int64)
    inner = order < n - 1
    shorter[inner] = place[order[inner] + 1]
    value = min(16, length, max(ranks))
    half = ranks[value // 2] if value > 1 else None

    def differ(by: np.ndarray) -> np.ndarray:
        out = np.ones(n + 1, bool)
        out[1:n] = by[1:] != by[:-1]
        return out

    bound = differ(ranks[value][order])
    if value < length and value > 1:
        tail = np.full(n, -1, np.int64)
        tail[: n - (value // 2 - 1)] = half[value // 2 - 1 :]
        before = differ((half * (n + 1) + tail + 1)[order])
        fresh = np.flatnonzero(bound[:n] & ~before[:n])
    else:
        fresh = np.flatnonzero(bound[:n])
    # Neighbours whose suffixes without the first symbol are no neighbours wait for any boundary between those.
    open_ = np.flatnonzero(~bound[:n])
    wide = open_[shorter[open_] != shorter[open_ - 1] + 1]
    if value < length:
        known = np.cumsum(bound[:n])
        ready = known[shorter[wide]] > known[shorter[wide - 1]]
        at_once, wide = wide[ready], wide[~ready]
    while value < length:
        # What follows one value further: directly through the mapping, or inside a wide gap.
        back = longer[fresh]
        last = longer[fresh - 1]
        direct = back[(back > 0) & (last == back - 1) & (fresh > 0)]
        direct = direct[~bound[direct]]
        if len(wide):
            sorted_fresh = np.sort(fresh)
            inside = np.searchsorted(sorted_fresh, shorter[wide], side="right") > np.searchsorted(sorted_fresh, shorter[wide - 1], side="right")
            found, wide = wide[inside], wide[~inside]
            fresh = np.concatenate([direct, found])
        else:
            fresh = direct
        if len(at_once):
            fresh, at_once = np.concatenate([fresh, at_once]), at_once[:0]
        fresh = fresh[~bound[fresh]]
        fresh = np.unique(fresh)
        bound[fresh] = True
        value += 1
        if not len(fresh):
            break
    same = ~bound[1:n]
    out = np.zeros(n, bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _block_results(anchors: list[int], digests: list[int], bodies: list[bytes]) -> pa.RecordBatch:
    """The repeated strings of each stretch of a block."""
    sizes = np.array([len(b) for b in bodies])
    text = np.zeros(int(sizes.sum()) + len(bodies), np.int64)
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    text[:] = joined
    text[at[1:] - 1] = 256 + np.arange(len(bodies))
    flags = repeated_starts(text, LENGTH)
    spans = []
    for i in range(len(bodies)):
        start, end = runs_of(flags[at[i] : at[i + 1]])
        spans.append([{"start": int(s), "end": int(e) + LENGTH - 1} for s, e in zip(start, end)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchors, pa.int64()),
            pa.array(digests, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ],
        ["anchor", "digest", "spans"],
    )


def alike(bodies: list[bytes], places: list[int], length: int = LENGTH, gram: int = GRAM) -> list[int]:
    """Which of the distinct stretches of one anchor may share a string with another: those with a full side in common."""
    side = -(-(length - gram) // 2)
    before = [body[p - side : p] if p >= side else None for body, p in zip(bodies, places)]
    after = [body[p + gram : p + gram + side] if len(body) >= p + gram + side else None for body, p in zip(bodies, places)]
    first, second = Counter(before), Counter(after)
    return [
        i
        for i, (x, y) in enumerate(zip(before, after))
        if (x is not None and first[x] > 1) or (y is not None and second[y] > 1)
    ]


def _blocks(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, digest, place, body) in the order of anchors: whole anchors side by side in blocks."""
    held: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    size = 0
    rows = (row for batch in source for row in zip(*(column.to_pylist() for column in batch.columns)))
    for anchor, group in groupby(rows, key=itemgetter(0)):
        _, digests, places, bodies = zip(*group)
        for i in alike(bodies, places):
            held[0].append(anchor)
            held[1].append(digests[i])
            held[2].append(bodies[i])
            size += len(bodies[i])
        if size >= BLOCK_BYTES:
            yield _block_results(*held)
            held, size = ([], [], []), 0
    if held[0]:
        yield _block_results(*held)


def _bodies(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, list of stretches): the bytes of each stretch, and whether its anchor is larger than a block."""
    for batch in common.batches(source, 512):
        body, at = common.rows_of(batch.column(0))
        anchors, digests, places, large, bodies = [], [], [], [], []
        for i, wanted in enumerate(batch.column(1).to_pylist()):
            for w in wanted:
                low = int(at[i]) + w["start"]
                anchors.append(w["anchor"])
                digests.append(w["digest"])
                places.append(w["place"])
                large.append(w["large"])
                bodies.append(body[low : low + w["strings"] + LENGTH - 1].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchors, pa.int64()),
                pa.array(digests, pa.int64()),
                pa.array(places, pa.int32()),
                pa.array(large, pa.bool_()),
                pa.array(bodies, pa.binary()),
            ],
            ["anchor", "digest", "place", "large", "body"],
        )


def _strings(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, digest, body): a digest of every string of each stretch."""
    for batch in common.batches(source, 2048):
        for i in range(batch.num_rows):
            body = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint8)
            begin = np.arange(len(body) - LENGTH + 1)
            one = common.span_hashes(common.prefix_sums(body, common.byte_codes(seed=11)), begin, begin + LENGTH)
            n = len(begin)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch.column(0)[i].as_py()), pa.int64()),
                    pa.array(np.full(n, batch.column(1)[i].as_py()), pa.int64()),
                    pa.array(begin, pa.int32()),
                    pa.array(one.view(np.int64), pa.int64()),
                ],
                ["anchor", "digest", "start", "string"],
            )


def _joined_spans(starts: list[int]) -> list[dict[str, int]]:
    flags = np.zeros(max(starts) + 1, bool)
    flags[starts] = True
    start, end = runs_of(flags)
    return [{"start": int(s), "end": int(e) + LENGTH - 1} for s, e in zip(start, end)]


def _span_lists(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        spans = [_joined_spans(s) for s in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            ["anchor", "digest", "spans"],
        )


def dealt_join(rows: DataFrame, small: DataFrame, keys: list[str], *spread: str) -> DataFrame:
    """Join on `keys` with a side of one row per key; rows of heavy keys go to many tasks, by the columns of `spread`."""
    key = F.xxhash64(*keys)
    dealt, copies = salted_sides(rows.withColumn("__key", key), small.withColumn("__key", key), "__key", F.struct(*spread))
    return dealt.drop("__key").join(copies.drop("__key").hint("merge"), [*keys, "__salt"]).drop("__salt")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, n_bytes, spans: the byte spans (start, end) of `LENGTH` bytes or more that are made of repeated strings,
    for every row with any. `row_key` is the hash of id and text that `keyed` gives."""
    docs = keyed(docs, id_col, text_col)
    places = common.stored(docs.select("row_key", "text").mapInArrow(_stretches, STRETCHES), "stretches")
    distinct = places.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row_key", "start", "strings", "place")).alias("at")
    )
    distinct = common.stored(distinct, "stretches-distinct")
    crowd = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("at.strings") + LENGTH).alias("bytes"))
    crowd = crowd.filter("kinds > 1")
    wanted = dealt_join(distinct, crowd, ["anchor"], "digest").select("anchor", "digest", "at.*", (F.col("bytes") > BLOCK_BYTES).alias("large"))
    asked = wanted.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "digest", "start", "strings", "place", "large")).alias("wanted"))
    bodies = common.stored(
        docs.select("row_key", "text").join(asked, "row_key").select("text", "wanted")
        .mapInArrow(_bodies, "anchor bigint, digest bigint, place int, large boolean, body binary"),
        "stretches-bodies",
    )
    span = "array<struct<start:int,end:int>>"
    small = bodies.filter(~F.col("large")).select("anchor", "digest", "place", "body")
    by_block = (
        small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_blocks, f"anchor bigint, digest bigint, spans {span}")
    )
    strings = common.stored(
        bodies.filter("large").select("anchor", "digest", "body").mapInArrow(_strings, "anchor bigint, digest bigint, start int, string bigint"), "strings"
    )
    twice = strings.groupBy("anchor", "string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    by_string = (
        dealt_join(strings, twice, ["anchor", "string"], "digest", "start")
        .groupBy("anchor", "digest")
        .agg(F.collect_list("start").alias("starts"))
        .mapInArrow(_span_lists, f"anchor bigint, digest bigint, spans {span}")
    )
    partial = by_block.filter(F.size("spans") > 0).unionByName(by_string)
    whole = distinct.filter("n > 1").select(
        "anchor", "digest", F.array(F.struct(F.lit(0).alias("start"), (F.col("at.strings") + LENGTH - 1).alias("end"))).cast(span).alias("spans")
    )
    once = distinct.filter("n = 1").select("anchor", "digest")
    found = common.stored(whole.unionByName(partial.join(once, ["anchor", "digest"])), "stretches-found")
    return (
        dealt_join(places, found, ["anchor", "digest"], "row_key", "start")
        .select(
            "row_key",
            "n_bytes",
            F.transform("spans", lambda s: F.struct((s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end"))).alias("spans"),
        )
        .groupBy("row_key", "n_bytes")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def _united(spans: list[dict[str, int]] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans or []):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _removed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 512):
        body, at = common.rows_of(batch.column(1))
        spans = [_united(s) for s in batch.column(2).to_pylist()]
        kept = []
        for i, own in enumerate(spans):
            text, last, parts = body[at[i] : at[i + 1]].tobytes(), 0, []
            for s, e in own:
                parts.append(text[last:s])
                last = e
            kept.append(b"".join([*parts, text[last:]]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(at), pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in own] for own in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "removed", "kept"],
        )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (byte spans), kept (the bytes that are left) of every row.

    Other columns are not looked at. A null or empty text has no bytes, one of fewer than `LENGTH` bytes loses none.
    Repeated rows are two documents: their texts repeat, so all of them goes if it is long enough. A null id is an id like
    others. Ties do not occur: every repeated string is removed wherever it stands. Empty input gives an empty result.
    """
    spans = repeated_spans(docs, id_col, text_col).select("row_key", "spans")
    return (
        keyed(docs, id_col, text_col)
        .join(spans, "row_key", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(_removed, "doc_id bigint, n_bytes bigint, removed array<struct<start:int,end:int>>, kept binary")
    )


def removal_digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of what is left of each row of `without_repeats`."""
    length = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + (x["end"] - x["start"]).cast("bigint"))
    return found.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
