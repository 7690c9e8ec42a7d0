"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Every text becomes its set of distinct five-word shingles (hashes), once: size, digest and the k smallest hashes, its
   sketch. Documents with equal sets are one class; only classes are compared.
2. Inverted lists of the retained hashes give overlaps. Two sets at the threshold share three quarters of their sketches,
   less a few standard deviations where a sketch is not the whole set (`least_overlap`), so they share one of the rarest
   retained hashes of either, and only these are listed, rarest first by their counts over all classes. A passage that many
   documents share therefore makes no long list, unless it is most of the document. The place of a hash in that order bounds
   the overlap of two whole sets that meet there first (`may_reach`): copies that differ too much to link leave the long
   lists of their common text before anything is compared.
3. Within a long list nothing is paired with everything. Rounds compare each class with the few hubs of its list; what is
   linked is contracted, the hubs leave the list, and a list ends when its classes are one component. Short lists are compared
   class by class. A group of n near copies costs about n comparisons; later rounds take more hubs, for lists whose classes share
   much and are no copies, and compare a pair in one of its lists only.
4. A pair is kept if the union of the two sketches estimates a similarity near the threshold, and linked only if the full
   sets reach it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelstream.llm import common
from modelstream.plans.sizes import lookup_join

SHINGLE = 5
SKETCH = 160
# Standard deviations that overlaps and estimates may lie below their means at the threshold: 3 in a million do.
SURE = 4.5
MARGIN = SURE * (0.75 * 0.25 / SKETCH) ** 0.5
# Places of the bitmap of a set.
BITS = 512
# Ids that are sent to all tasks to fetch texts by; more are joined by a shuffle of the texts.
BROADCAST_IDS = 500_000
# Classes of a list that are compared one by one; longer lists go by hubs: one in the first round, then about `HUBS` times
# a power of `GROWTH`, so the rounds grow with the logarithm of the longest list.
SHORT_LIST = 16
HUBS = 2
GROWTH = 8


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row, A-Z lower-cased; empty without words."""
    codes, white = common.byte_codes(common.lower_ascii()), common.white_words()
    for low, high, body, at in common.pieces(column):
        start, end, first = common.word_bounds(body, at, white)
        words = common.span_hashes(common.prefix_sums(body, codes), start, end)
        runs = common.run_hashes(words, SHINGLE)
        for i in range(high - low):
            a, b = first[i], first[i + 1]
            if b - a >= SHINGLE:
                yield np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                yield common.run_hashes(words[a:b], int(b - a))
            else:
                yield np.zeros(0, np.uint64)


def _digest(shingles: np.ndarray) -> bytes | None:
    """What names a set: equal for equal sets, null for an empty one."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sets(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 512):
        sets = list(shingle_sets(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
            ],
            ["doc_id", "text_key", "key", "n_shingles"],
        )


def _sketches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 512):
        sets = list(shingle_sets(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64())),
                pa.array([_bits(s) for s in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "key", "n_shingles", "sketch", "bits"],
        )


def _bits(shingles: np.ndarray) -> list[int]:
    """A bitmap of `BITS` places with those of the set's hashes: a place of one set that another lacks is an element it lacks."""
    out = np.zeros(BITS // 64, np.uint64)
    place = shingles % np.uint64(BITS)
    np.bitwise_or.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out.view(np.int64).tolist()


def _full(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.batches(source, 512):
        sets = list(shingle_sets(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["key", "shingles"],
        )


def missing(one: str, other: str) -> Column:
    """Places of a bitmap that another lacks."""
    return sum(F.bit_count(F.col(one)[i].bitwiseAND(F.bitwise_not(F.col(other)[i]))) for i in range(BITS // 64))


def least_overlap(n: Column) -> Column:
    """Retained hashes that a set of `n` shares with any set at the threshold.

    Sets that fit into their sketches share three quarters at least. Otherwise the hashes retained from the union are drawn
    without replacement from it, and three quarters less `SURE` standard deviations are shared.
    """
    kept = F.least(n, F.lit(SKETCH))
    spread = F.sqrt(kept * 0.1875 * F.greatest(F.lit(0.0), 1 - 0.75 * SKETCH / n))
    return F.greatest(F.lit(1), F.ceil(0.75 * kept - SURE * spread - 1e-9)).cast("int")


def may_reach(n: Column, rest: Column, other: Column) -> Column:
    """Whether a set of `n`, of which `rest` are left from its first hash in common on, can be linked with a set of `other`.

    Everything before that hash is in one of the sets only, so at most `rest` are common. A pair that meets at several hashes
    is judged rightly at the first.
    """
    return 7 * rest >= 3 * (n + other)


def in_reach(lists: DataFrame) -> DataFrame:
    """The rows of the lists (value, n_shingles, rest) without those that no size in their list lets reach the threshold.

    Sets beyond a sketch have places in their sketch only, which bound nothing; they stay, and so does what may link with them.
    """
    whole = F.col("n_shingles") <= SKETCH
    sizes = lists.groupBy("value").agg(
        F.min(F.when(whole, F.col("n_shingles"))).alias("least_whole"),
        F.min(F.when(~whole, F.col("n_shingles"))).alias("least_cut"),
    )
    stays = (
        ~whole
        | may_reach(F.col("n_shingles"), F.col("rest"), F.col("least_whole"))
        | F.coalesce(4 * F.col("n_shingles") >= 3 * F.col("least_cut"), F.lit(False))
    )
    return lists.join(sizes, "value").filter(stays).drop("least_whole", "least_cut")


def link_pairs(pairs: DataFrame, sketches: DataFrame, full: DataFrame) -> DataFrame:
    """Of the pairs of keys (a, b), those whose full sets are at least 0.75 similar."""
    one = sketches.select(F.col("key").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    two = sketches.select(F.col("key").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    # Sketches hold the smallest hashes as unsigned numbers, so their union is put in that order too.
    order = F.transform("both", lambda x: x.bitwiseXOR(F.lit(-(2**63))))
    near = (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(100 * F.least("na", "nb") >= 75 * F.greatest("na", "nb"))
        .select("a", "b", "na", "nb", F.array_union("sa", "sb").alias("both"), F.array_intersect("sa", "sb").alias("common"))
        .select("a", "b", "na", "nb", F.slice(F.sort_array(order), 1, SKETCH).alias("union"),
                F.transform("common", lambda x: x.bitwiseXOR(F.lit(-(2**63)))).alias("common"))
        .filter(F.size(F.array_intersect("union", "common")) >= (0.75 - MARGIN) * F.size("union"))
        .select("a", "b", "na", "nb")
    )
    exact = near.join(full.select(F.col("key").alias("a"), F.col("shingles").alias("xa")), "a").join(
        full.select(F.col("key").alias("b"), F.col("shingles").alias("xb")), "b"
    )
    inter = F.size(F.array_intersect("xa", "xb"))
    return exact.select("a", "b", "na", "nb", inter.alias("inter")).filter(
        100 * F.col("inter") >= 75 * (F.col("na") + F.col("nb") - F.col("inter"))
    ).select("a", "b")


def components(edges: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(id, label) of every id in the edges (a, b): the smallest id that can be reached.

    Each round hands every node the smallest label among its neighbours and then the label of that label, so the rounds
    grow with the logarithm of the longest chain.
    """
    both = scratch.keep(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        seen = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = scratch.keep(step, "labels")
        scratch.drop("labels", newest=1)
        labels = step.select("id", "label")
        if step.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def merged(label: DataFrame, links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """The labels (key, label) after the links of keys (a, b): only the groups that the links join are looked at."""
    one = label.select(F.col("key").alias("a"), F.col("label").alias("la"))
    two = label.select(F.col("key").alias("b"), F.col("label").alias("lb"))
    joined = links.join(one, "a").join(two, "b").filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = scratch.keep(joined.distinct(), "joined")
    if joined.isEmpty():
        return label
    group = components(joined, scratch).select(F.col("id").alias("label"), F.col("label").alias("to"))
    # A group may hold many classes: its rows are dealt over tasks where the groups are too many for a broadcast.
    named = lookup_join(label, group, "label", "left", spread=F.col("key"))
    label = scratch.keep(named.select("key", F.coalesce("to", "label").alias("label")), "label")
    scratch.drop("joined", "edges", "labels")
    scratch.drop("label", newest=1)
    return label


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (hash of the text), key (digest of its set, null without words), n_shingles, component_id, kept of
    every row of `docs`.

    Other columns are not looked at. A null or wordless text has 0 shingles, is linked with nothing and is its own
    component. A null id takes part but is never the smallest: component_id is the smallest id of the group, and null if
    there is none; a row with a null id is kept only then. Repeated rows are equal sets and get equal answers; the same id with
    different texts are different documents. Empty input gives an empty result.
    """
    return labelled_classes(docs, id_col, text_col).drop("label")


def labelled_classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`near_classes` with the label of each row's group, one of its keys; null without words."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scratch = common.Scratch(docs.sparkSession, "near")
    rows = scratch.keep(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
            _sets, "doc_id bigint, text_key bigint, key binary, n_shingles bigint"
        ),
        "sets",
    )
    # One row of each class carries its sketch, which is made in a second pass: sketches of all rows are not kept.
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    made = docs.mapInArrow(_sketches, "doc_id bigint, key binary, n_shingles bigint, sketch array<bigint>, bits array<bigint>")
    sketches = scratch.keep(
        made.alias("r")
        .join(classes.alias("c"), (F.col("r.key") == F.col("c.key")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")))
        .select("r.key", "r.doc_id", "r.n_shingles", "r.sketch", "r.bits")
        .dropDuplicates(["key"]),
        "sketches",
    )
    values = sketches.select("key", F.explode("sketch").alias("value"))
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    kept = F.least(F.col("n_shingles"), F.lit(SKETCH))
    # Hashes of one class alone are the rarest and make no list; of the others the rarest fill up the prefix.
    prefix = kept - least_overlap(F.col("n_shingles")) + 1 - (kept - F.size("shared"))
    listed = (
        values.join(counts, "value")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
        .join(sketches.select("key", "n_shingles", "bits"), "key")
        .filter(prefix > 0)
        .select("key", "n_shingles", "bits", F.size("shared").alias("n_shared"), F.posexplode(F.slice("shared", F.lit(1), prefix.cast("int"))).alias("at", "x"))
        .select("key", F.col("x.value").alias("value"), "n_shingles", "n_shared", (F.col("n_shared") - F.col("at")).alias("rest"), "bits")
    )
    lists = scratch.keep(in_reach(scratch.keep(listed, "listed")), "lists")
    scratch.drop("listed")
    wanted = sketches.join(lists.select("key").distinct(), "key", "left_semi")
    first = scratch.keep(wanted.select("doc_id").distinct(), "first")
    if first.count() <= BROADCAST_IDS:
        first = F.broadcast(first)
    full = scratch.keep(
        docs.join(first, docs.doc_id.eqNullSafe(first.doc_id), "left_semi")
        .select("doc_id", "text")
        .mapInArrow(_full, "key binary, shingles array<bigint>")
        .join(wanted.select("key"), "key", "left_semi")
        .dropDuplicates(["key"]),
        "full",
    )
    wanted = scratch.keep(wanted.select("key", "n_shingles", "sketch"), "wanted")
    scratch.drop("sketches", "first")
    label = scratch.keep(wanted.select("key", F.col("key").alias("label")), "label")
    turn = 0
    while True:
        named = lists.join(label, "key")
        live = (
            named.groupBy("value")
            .agg(
                F.min("label").alias("low"),
                F.max("label").alias("high"),
                F.count(F.lit(1)).alias("n"),
                F.max_by("key", F.struct(F.col("n_shared") / F.col("n_shingles"), "key")).alias("first"),
            )
            .filter("low <> high")
            .drop("low", "high")
        )
        named = named.join(live, "value")
        if turn:
            # What is left are classes that share much and do not link, in many lists: each pair is looked at in the first list
            # that both are still in. As long as they meet in none with one of them as hub, both stay in that one.
            before = Window.partitionBy("key").orderBy(F.desc("rest")).rowsBetween(Window.unboundedPreceding, -1)
            named = named.withColumn("earlier", F.collect_list("value").over(before))
        else:
            named = named.withColumn("earlier", F.array().cast("array<bigint>"))
        named = scratch.keep(named, "live")
        # The lists were read from the round before; from here on only this round's are.
        scratch.drop("lists")
        scratch.drop("live", newest=1)
        if named.isEmpty():
            break
        # Hubs: every class of a short list; of a longer one the class with the largest share of hashes that others have, the
        # centre of a group of copies, and from the second round on about as many more as the round compares with.
        share = F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(1 << 30)) / (1 << 30)
        is_hub = (F.col("n") <= SHORT_LIST) | (F.col("key") == F.col("first")) | (share < F.lit(float(HUBS * GROWTH**turn if turn else 0)) / F.col("n"))
        named = named.withColumn("is_hub", is_hub)
        hubs = named.filter("is_hub").select(
            "value", F.col("key").alias("hub"), F.col("label").alias("hub_label"), F.col("n_shingles").alias("hub_size"), F.col("rest").alias("hub_rest"), F.col("bits").alias("hub_bits"),
            F.col("earlier").alias("hub_earlier"),
        )
        near_size = 100 * F.least("n_shingles", "hub_size") >= 75 * F.greatest("n_shingles", "hub_size")
        # Bounds of the intersection: without what comes before the hash (of whole sets), without what the bitmaps tell apart.
        cut = F.greatest("n_shingles", "hub_size") > SKETCH
        meet = cut | may_reach(F.col("n_shingles"), F.least("rest", "hub_rest"), F.col("hub_size"))
        apart = F.least(F.col("n_shingles") - missing("bits", "hub_bits"), F.col("hub_size") - missing("hub_bits", "bits"))
        possible = meet & ~F.arrays_overlap("earlier", "hub_earlier") & may_reach(F.col("n_shingles"), apart, F.col("hub_size"))
        pairs = (
            named.join(hubs, "value")
            .filter((F.col("label") != F.col("hub_label")) & near_size & possible & (~F.col("is_hub") | (F.col("key") < F.col("hub"))))
            .select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"))
            .distinct()
        )
        found = scratch.keep(link_pairs(pairs, wanted, full), "links")
        lists = named.filter("not is_hub").select("key", "value", "n_shingles", "n_shared", "rest", "bits")
        label = merged(label, found, scratch)
        scratch.drop("links")
        turn += 1
    scratch.drop("live", "lists", "full", "wanted")
    named = classes.join(label, "key", "left").select("key", "doc_id", F.coalesce("label", "key").alias("label"))
    lowest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    final = lookup_join(named, lowest, "label", spread=F.col("key")).select("key", "label", "component_id", F.lit(True).alias("in_class"))
    component = F.when(F.col("in_class"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_key", "key", "n_shingles").join(final, "key", "left").select(
        "doc_id", "text_key", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "label"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of `near_classes`, with all its columns.

    It is one with the smallest id; of several with it, or of a group without ids, that with the smallest key and text
    hash. Texts without words are in no group: of those with the same id, or without one, one row stays.
    """
    kept = labelled_classes(docs, id_col, text_col).filter("kept")
    # The rows of a group that are kept have one id, or none.
    keep = (
        kept.groupBy("label", F.when(F.col("label").isNull(), F.col("doc_id")).alias("alone"))
        .agg(F.min(F.struct("doc_id", "key", "text_key")).alias("first"))
        .select("first.doc_id", "first.text_key")
    )
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("hash"),
    )
    same = row["id"].eqNullSafe(keep["doc_id"]) & (row["hash"] == keep["text_key"])
    return row.join(keep, same).dropDuplicates(["id", "hash"]).select("row.*")
