"""What each order of five document filters removes, from one sum of wide integers per part.

Every document has a mask: the filters that it fails. A mask decides what happens to the document at each of the 600 steps
(120 orders of five filters), so it is mapped to one big integer with a field for every outcome of every step, 1 where the
outcome holds. The integers of all documents of a part are summed, and the fields of the sum are the counts. A field has
64 bits, so no count of rows carries into the next one.

Rows with the same text have the same mask but for the filter on copies, so documents are first counted by text, part and
label: a text that a third of all rows share costs one row per task, and no task ever holds its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelstream.llm.common import stored

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
STEPS = [("".join(order), step) for order in permutations(FILTERS) for step in range(1, len(FILTERS) + 1)]
OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
# One field per step and outcome, then one per filter for documents that fail it alone.
FIELDS = len(STEPS) * len(OUTCOMES) + len(FILTERS)
FIELD_BYTES = 8
# Groups in which the tasks' sums of a part are added before they meet, and the sums that a task holds before it sends them on.
MERGERS = 32
HELD_PARTS = 2000

SUM = "part string, packed binary"
REPORT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def failed_filters(text: Column) -> Column:
    """The mask of the filters A to D that a text fails; null is an empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    conditions = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum(F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters that they fail and by their labels, several rows for a key.

    A document is a copy (E) if a smaller id has its text anywhere in the table. A row without an id is no copy and makes none;
    repeated rows with one id make no copy of each other. Several labels of an id count as one that has each mark any of them has.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("hash"),
            failed_filters(F.col("text")).alias("mask"),
        )
        .groupBy("doc_id", "part", "hash", "mask")
        .agg(F.count(F.lit(1)).alias("n")),
        "audit-rows",
    )
    marks = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
        .groupBy("doc_id")
        .agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
        .filter("good or toxic")
    )
    # Rows without an id have no label; they keep out of the join, where all of them would meet in one task.
    plain = rows.filter("doc_id is null").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    marked = rows.filter("doc_id is not null").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"]).unionByName(plain)
    alike = marked.groupBy("hash", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("low"),
        F.min_by("n", "doc_id").alias("n_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    # A text has as many rows here as it has parts and labels, not as it has copies.
    alike = stored(alike, "audit-alike")
    lowest = alike.groupBy("hash").agg(F.min("low").alias("lowest"))
    first = F.when(F.col("low") == F.col("lowest"), F.col("n_low")).otherwise(0) + F.col("n_null")
    both = F.array(
        F.struct(F.col("mask").alias("mask"), first.alias("n")),
        F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - first).alias("n")),
    )
    return (
        alike.join(lowest, "hash")
        .select("part", "good", "toxic", F.explode(both).alias("x"))
        .select("part", "x.mask", "good", "toxic", "x.n")
        .filter("n > 0")
    )


def packed_outcomes(mask: int, good: bool, toxic: bool) -> int:
    """The big integer of one document: each field 1 if its outcome holds at its step."""
    fields = np.zeros(FIELDS, np.uint64)
    for i, (order, step) in enumerate(STEPS):
        fails = [mask >> FILTERS.index(f) & 1 for f in order[:step]]
        here, before = fails[-1], any(fails[:-1])
        outcomes = (not any(fails), here and not before, here and before, here and not before and good, here and not before and toxic)
        fields[i * len(OUTCOMES) : (i + 1) * len(OUTCOMES)] = [bool(x) for x in outcomes]
    for i in range(len(FILTERS)):
        fields[len(STEPS) * len(OUTCOMES) + i] = mask == 1 << i
    return int.from_bytes(fields.astype("<u8").tobytes(), "little")


def _batch(sums: dict[str, int]) -> pa.RecordBatch:
    packed = [x.to_bytes(FIELDS * FIELD_BYTES, "little") for x in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(packed, pa.binary())], ["part", "packed"])


def _sum_masks(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and part the sum of the integers of its documents."""
    wide: dict[tuple, int] = {}
    sums: dict[str, int] = {}
    for batch in source:
        for part, mask, good, toxic, n in zip(*(c.to_pylist() for c in batch.columns)):
            key = (mask, good, toxic)
            if key not in wide:
                wide[key] = packed_outcomes(*key)
            sums[part] = sums.get(part, 0) + n * wide[key]
        if len(sums) > HELD_PARTS:
            yield _batch(sums)
            sums = {}
    if sums:
        yield _batch(sums)


def _sum_packed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sums; the rows of a part come one after the other."""
    part, total = None, 0
    for batch in source:
        for name, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            if part is not None and name != part:
                yield _batch({part: total})
                total = 0
            part, total = name, total + int.from_bytes(packed.as_buffer(), "little")
    if part is not None:
        yield _batch({part: total})


def _unpack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fields = np.frombuffer(packed, "<u8").astype(np.int64)
            steps = fields[: len(STEPS) * len(OUTCOMES)].reshape(len(STEPS), len(OUTCOMES))
            at = np.array([FILTERS.index(order[step - 1]) for order, step in STEPS])
            alone = fields[len(STEPS) * len(OUTCOMES) :][at]
            by_filter = np.array([steps[at == i, 1].sum() for i in range(len(FILTERS))], np.int64)[at]
            kept, removed, redundant, good, toxic = steps.T
            numbers = [kept, removed, redundant, alone, good, toxic, by_filter]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(STEPS), pa.string()),
                    pa.array([order for order, _ in STEPS], pa.string()),
                    pa.array([step for _, step in STEPS], pa.int32()),
                    *[pa.array(x, pa.int64()) for x in numbers],
                ],
                [c.split()[0] for c in REPORT.split(", ")],
            )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang, null as empty), order of the filters and step: what is kept, removed and removed already.

    `docs` needs doc_id, text and lang, `labels` doc_id, quality and toxic; other columns are not looked at. Null or empty
    texts have no words and are copies of each other. Counts of rows: repeated rows count as often as they stand there. An
    empty table has no parts, so the result is empty; without labels good_lost and toxic_lost are 0.
    """
    spark = docs.sparkSession
    sums = mask_counts(docs, labels).mapInArrow(_sum_masks, SUM)
    some = sums.withColumn("merger", F.spark_partition_id() % MERGERS)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = some.repartition(tasks, "part", "merger").sortWithinPartitions("part").select("part", "packed").mapInArrow(_sum_packed, SUM)
    whole = some.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_sum_packed, SUM)
    return whole.mapInArrow(_unpack, REPORT)


ORACLE = r"""
WITH filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM filters a JOIN filters b ON b.f <> a.f JOIN filters c ON c.f NOT IN (a.f, b.f)
  JOIN filters d ON d.f NOT IN (a.f, b.f, c.f) JOIN filters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
),
texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
lowest AS (SELECT t, min(doc_id) AS low FROM texts GROUP BY t),
words AS (SELECT x.*, regexp_extract_all(x.t, '[^\x20\x09-\x0D]+') AS w, l.low FROM texts x JOIN lowest l ON l.t = x.t),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN words.doc_id > low THEN 'E' ELSE '' END) AS mask
  FROM words LEFT JOIN marks ON marks.doc_id = words.doc_id
),
masks AS (SELECT part, mask, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
outcomes AS (
  SELECT m.part, s.filter_order, s.step, s.f, m.n, m.mask, m.good, m.toxic,
    contains(m.mask, s.f) AS here,
    len(translate(m.mask, s.before, '')) < len(m.mask) AS earlier
  FROM masks m, steps s
),
counted AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT here AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN here AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN here AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN here AND NOT earlier AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN here AND NOT earlier AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM outcomes GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
