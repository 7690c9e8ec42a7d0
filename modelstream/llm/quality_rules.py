"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Four statistics of a text tell junk: symbols, repeated lines, repeated words and exclamation marks, each per hundred words.
A statistic is compared with a cutoff of the text's stratum (its length band). Cutoffs are chosen on labelled good
texts: from the most lenient on, a cutoff is accepted while the exact binomial bound shows, with the error probability of
its test, that it rejects at most `RISK / rules` of the good texts of the stratum; the first that fails ends the sequence, so the
cutoffs of one rule need no further correction. The error probability `ERROR` is divided over all rules and
strata, so all accepted cutoffs hold together, and a good text is rejected by any rule with at most probability `RISK`.
A stratum with too few good texts accepts no cutoff, and its texts are rejected by the base rules alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common

RISK = 0.06
ERROR = 0.05
# Upper ends of the length bands, in words; longer texts make the last stratum.
BANDS = (150, 600)
# Cutoffs per hundred words, the most lenient first.
CUTOFFS = {
    "symbols": (300, 250, 200, 150, 120, 100, 80, 60, 45, 30, 20, 12, 8, 5),
    "dup_lines": (40, 30, 20, 15, 10, 8, 6, 5, 4, 3, 2, 1),
    "repeat_words": (48, 45, 40, 36, 32, 28, 25, 22, 20, 18, 16, 14, 12, 10),
    "marks": (200, 150, 100, 80, 60, 45, 30, 20, 12, 8, 5),
}
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(hashes: Column) -> Column:
    """The words in three-word windows that occur twice or more, from the hashes of the windows in order."""

    def covered(placed: Column) -> Column:
        twice = F.filter(
            placed, lambda x, i: (x["h"] == F.get(placed, i - 1)["h"]) | (x["h"] == F.get(placed, i + 1)["h"])
        )
        return let(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p)),
                F.lit(0),
                lambda s, x: s + x,
            ),
        )

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, covered)).cast("bigint")


def text_stats(docs: DataFrame, text: Column, name: str = "stats") -> DataFrame:
    """`docs` with a struct of the counts of `text` and its verdict by the base rules. Null is no word."""
    # One step a frame: a column that is used more than once stays computed once.
    body = F.coalesce(text.cast("string"), F.lit(""))
    out = docs.withColumn("__t", body)
    out = out.withColumn("__w", F.array_remove(F.split("__t", "[\\x20\\x09-\\x0D]+"), ""))
    n = F.size("__w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.slice("__w", F.lit(1), F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("__t", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    out = out.withColumn("__h", windows).withColumn("__l", lines)
    size = F.length("__t").cast("bigint")
    out = out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            n.cast("bigint").alias("n_words"),
            F.length(F.translate("__t", WHITE, "")).cast("bigint").alias("word_chars"),
            (size - F.length(F.translate("__t", SYMBOLS, ""))).alias("n_symbols"),
            (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
            repeated_words(F.col("__h")).alias("n_repeat_words"),
            (size - F.length(F.translate("__t", "!", ""))).alias("n_marks"),
        ).alias(name),
    )
    failed = (F.col(f"{name}.n_words") < 50) | (100 * F.col(f"{name}.n_repeat_words") > 50 * F.col(f"{name}.n_words"))
    return out.withColumn(name, F.col(name).withField("base_failed", failed).withField("stratum", stratum(F.col(f"{name}.n_words"))))


def stratum(words: Column) -> Column:
    out = F.lit(len(BANDS))
    for i, end in reversed(list(enumerate(BANDS))):
        out = F.when(words < end, F.lit(i)).otherwise(out)
    return out


def statistic(rule: str, stats: str) -> Column:
    """The count behind a rule."""
    return F.col(f"{stats}.n_{rule}")


def binomial_tail(x: Column, n: Column, rate: float) -> Column:
    """P(at most `x` of `n`) at `rate`: the error probability of accepting that the true rate is at most `rate`."""
    first = n * F.log1p(F.lit(-rate))
    terms = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.greatest(x, F.lit(1))),
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda s, i: F.when(i > x, s).otherwise(
            let(
                s["log"] + F.log((n - i + 1) / i) + F.log(F.lit(rate / (1 - rate))),
                lambda log: F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum")),
            )
        ),
    )
    return terms["sum"]


def choose_cutoffs(good: DataFrame, stats: str = "stats", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum, then for each rule its cutoff or null, from good texts with their `text_stats`.

    One row per stratum, whatever the size of `good`.
    """
    strata = len(BANDS) + 1
    rate, level = risk / len(CUTOFFS), error / (len(CUTOFFS) * strata)
    words = F.col(f"{stats}.n_words")
    sums = [F.count(F.lit(1)).alias("n")]
    for rule, cuts in CUTOFFS.items():
        for k, cut in enumerate(cuts):
            sums.append(F.sum((100 * statistic(rule, stats) > cut * words).cast("bigint")).alias(f"{rule}_{k}"))
    counted = good.groupBy(F.col(f"{stats}.stratum").alias("stratum")).agg(*sums)
    chosen = []
    for rule, cuts in CUTOFFS.items():
        cells = F.array(
            *[F.struct(F.col(f"{rule}_{k}").alias("x"), F.lit(cut).alias("cut")) for k, cut in enumerate(cuts)]
        )
        ok = lambda c: F.when(c["x"] <= rate * F.col("n"), binomial_tail(c["x"], F.col("n"), rate) <= level).otherwise(False)
        walk = F.aggregate(
            cells,
            F.struct(F.lit(True).alias("open"), F.lit(None).cast("int").alias("cut")),
            lambda s, c: F.when(s["open"] & ok(c), F.struct(F.lit(True).alias("open"), c["cut"].alias("cut"))).otherwise(
                F.struct(F.lit(False).alias("open"), s["cut"].alias("cut"))
            ),
        )
        chosen.append(walk["cut"].alias(rule))
    return counted.select("stratum", *chosen)


def verdict(measured: DataFrame, cutoffs: DataFrame, stats: str = "stats", name: str = "kept") -> DataFrame:
    """`measured` with a boolean: passed the base rules and exceeds no cutoff of its stratum."""
    limits = F.broadcast(cutoffs.select(F.struct(*cutoffs.columns).alias("__c")))  # at most one row per length band
    out = measured.join(limits, F.col(f"{stats}.stratum") == F.col("__c.stratum"), "left")
    over = F.lit(False)
    for rule in CUTOFFS:
        over = over | F.coalesce(100 * statistic(rule, stats) > F.col(f"__c.{rule}") * F.col(f"{stats}.n_words"), F.lit(False))
    return out.withColumn(name, ~F.col(f"{stats}.base_failed") & ~over).drop("__c")


def _good(measured: DataFrame, labels: DataFrame, id_col: str, stats: str) -> DataFrame:
    """The `stats` of each distinct text that is labelled and all of whose labels are good: copies are no independent trials."""
    quality = (
        labels.select(F.col("doc_id").cast("bigint").alias("__id"), "quality")
        .filter("__id is not null and quality is not null")
        .groupBy("__id")
        .agg(F.min("quality").alias("quality"))
    )
    slim = measured.select(F.col(f"`{id_col}`").cast("bigint").alias("__id"), "text_key", F.col(stats))
    return (
        slim.filter(~F.col(f"{stats}.base_failed"))
        .join(quality, "__id")
        .groupBy("text_key")
        .agg(F.min("quality").alias("quality"), F.first(stats).alias(stats))
        .filter("quality = 1")
        .select(stats)
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of `docs`, with cutoffs from the good ones of `labels`.

    Other columns are not looked at. A null or empty text has no words and fails the base rules. Repeated rows are judged
    alike; copies of a text count once in the calibration, as good if all their labels are. Rows without an id are judged
    but never calibrate. Without labels only the base rules reject. Empty input gives an empty result.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("__text"))
    key = F.sha2(F.coalesce(F.col("__text").cast("string"), F.lit("")), 256).alias("text_key")
    measured = common.stored(text_stats(slim, F.col("__text")).select("doc_id", key, "stats"), "quality-stats")
    cutoffs = choose_cutoffs(_good(measured, labels, "doc_id", "stats"))
    return verdict(measured, cutoffs).select(
        "doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], "kept"
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass, with all their columns, by the rules of `quality_verdicts`."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    measured = common.stored(
        text_stats(row, F.col(f"row.`{text_col}`")).withColumns(
            {"id": F.col(f"row.`{id_col}`"), "text_key": F.sha2(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")), 256)}
        ),
        "quality-stats",
    )
    cutoffs = choose_cutoffs(_good(measured, labels, "id", "stats"))
    return verdict(measured, cutoffs).filter("kept").select("row.*")
