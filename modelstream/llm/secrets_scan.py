"""Secrets in texts, in DataFrame functions only.

Base kinds are patterns. Further spans are tokens that a battery of randomness tests cannot tell from uniform
characters. Each token's encoding is inferred (decimal, hex, base 32, letters and digits, base 64) and gives the alphabet. The null
hypothesis of every test is that the token is *not* random, so short tokens, on which a test has little power, are not found:

* chi-squared: the counts are as uneven as those of words (`UNEVEN` times the evenness of the alphabet),
* runs: characters change between classes (upper, lower, digit, other) at most `STEADY` times as often as at random,
* serial correlation: neighbours correlate by `SERIAL` or more.

All must be rejected, so the largest p-value counts. The tokens of a text are one family: Benjamini and Hochberg's step-up at
`FALSE_SHARE`, with weights in proportion to the tokens' lengths, bounds the expected share of false finds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelstream.llm.quality_rules import let

FALSE_SHARE = 0.1
UNEVEN = 1.6
STEADY = 0.55
SERIAL = 0.6
KINDS = ("assign", "access", "hex", "random")

# The patterns of the base kinds.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"

SPAN = "array<struct<start:int,end:int>>"
# A text may have two to the power of this many finds of a kind, more than a string can hold.
DOUBLINGS = 28


def running(values: Column, combine: Callable[[Column, Column], Column], neutral: int = 0) -> Column:
    """The array of `combine` over all values up to each one, by doubling: step k adds what stands 2**k places before, so an array of
    n values takes log n passes and no list is copied for each value."""

    def step(x: Column, far: Column) -> Column:
        moved = F.concat(F.array_repeat(F.lit(neutral), far), F.slice(x, F.lit(1), F.size(x) - far))
        return F.when(F.size(x) > far, F.zip_with(x, moved, combine)).otherwise(x)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(DOUBLINGS)]), values, step)


def match_spans(text: Column, pattern: str) -> Column:
    """Code-point spans (start, end) of the leftmost non-overlapping matches, in order: the gaps between matches and the
    matches add up to the text."""

    def placed(found: Column) -> Column:
        sizes = F.transform(found, lambda match: F.length(match))
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda gap: F.length(gap))
        ends = let(sizes, lambda n: running(F.zip_with(gaps, n, lambda g, x: g + x), lambda x, y: x + y))
        return F.zip_with(ends, sizes, lambda end, size: F.struct((end - size).alias("start"), end.alias("end")))

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(F.array().cast(SPAN)),
    )


def apart(spans: Column, others: Column) -> Column:
    """The spans that meet none of the others.

    Both are sorted together, a span by its end and another by its start; the farthest end among the others before it tells
    whether one reaches into the span. The order of the spans stays.
    """
    none = F.lit(None).cast("struct<start:int,end:int>")
    events = F.concat(
        F.transform(spans, lambda s: F.struct((2 * s["end"]).alias("at"), F.lit(-1).alias("reach"), s.alias("span"))),
        F.transform(others, lambda s: F.struct((2 * s["start"] + 1).alias("at"), s["end"].alias("reach"), none.alias("span"))),
    )

    def judged(ordered: Column) -> Column:
        reach = running(F.transform(ordered, lambda e: e["reach"]), lambda x, y: F.greatest(x, y), -1)
        both = F.zip_with(ordered, reach, lambda e, r: F.struct(e["span"].alias("span"), r.alias("reach")))
        free = F.filter(both, lambda x: x["span"].isNotNull() & (x["reach"] <= x["span"]["start"]))
        return F.sort_array(F.transform(free, lambda x: x["span"]))

    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(let(F.sort_array(events), judged))


def joined(spans: Column) -> Column:
    """Spans in order of their starts with those that overlap made one."""

    def heads(reach: Column) -> Column:
        first = F.filter(
            F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), F.coalesce(F.get(reach, i - 1), F.lit(-1)).alias("before"))),
            lambda s: s["start"] >= s["before"],
        )
        end = lambda h, i: F.coalesce(F.get(h, i + 1)["before"], F.element_at(reach, -1))
        return let(first, lambda h: F.transform(h, lambda s, i: F.struct(s["start"].alias("start"), end(h, i).alias("end"))))

    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, let(running(ends, lambda x, y: F.greatest(x, y), -1), heads)).otherwise(F.array().cast(SPAN))


def assignments(text: Column) -> Column:
    """Spans of assignments whose value has eight characters or more."""
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v))
    return let(
        match_spans(text, ASSIGN),
        lambda spans: F.when(
            F.size(spans) > 0, let(values, lambda n: F.filter(spans, lambda s, i: F.get(n, i) >= 8))
        ).otherwise(spans),
    )


def normal_cdf(z: Column) -> Column:
    """Phi, by a rational approximation with an error below 1e-7."""
    def upper(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return 0.3989422804014327 * F.exp(-x * x / 2) * poly

    return let(F.abs(z), lambda x: F.when(z > 0, 1 - upper(x)).otherwise(upper(x)))


def alphabet(token: Column) -> Column:
    """Size of the inferred alphabet and how often classes change in it at random."""
    def kind(size: int, *classes: int) -> Column:
        change = 1 - sum((c / size) ** 2 for c in classes)
        return F.struct(F.lit(float(size)).alias("size"), F.lit(change).alias("change"))

    return (
        F.when(token.rlike("^[0-9]+$"), kind(10, 5, 5))
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), kind(16, 10, 6))
        .when(token.rlike("^[A-Z2-7]+$"), kind(32, 26, 6))
        .when(token.rlike("^[A-Za-z0-9]+$"), kind(62, 26, 26, 10))
        .otherwise(kind(64, 26, 26, 10, 2))
    )


def char_class(code: Column, decimal: Column) -> Column:
    return (
        F.when(decimal, code % 2)
        .when((code >= 48) & (code <= 57), F.lit(2))
        .when((code >= 65) & (code <= 90), F.lit(3))
        .when((code >= 97) & (code <= 122), F.lit(4))
        .otherwise(F.lit(5))
    )


def p_value(token: Column) -> Column:
    """The largest p-value of the battery: small for a token that looks random."""
    body = F.regexp_replace(token, "=+$", "")

    def tests(codes: Column, a: Column) -> Column:
        n = F.size(codes).cast("double")
        counts = F.transform(F.array_distinct(codes), lambda c: F.size(F.filter(codes, lambda x: x == c)).cast("double"))
        square = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x * x)
        chi = square * a["size"] / n - n
        shift = n * (UNEVEN - 1) * F.when(a["size"] > 40, F.lit(3.0)).otherwise(F.lit(1.0))
        free = a["size"] - 1
        p_chi = normal_cdf((chi - free - shift) / F.sqrt(2 * (free + 2 * shift)))
        pairs = F.zip_with(
            F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        )
        decimal = a["size"] == 10
        changes = F.size(F.filter(pairs, lambda p: char_class(p["x"], decimal) != char_class(p["y"], decimal))).cast("double")
        rate = STEADY * a["change"]
        p_runs = 1 - normal_cdf((changes - (n - 1) * rate) / F.sqrt((n - 1) * rate * (1 - rate)))
        total = F.aggregate(codes, F.lit(0.0), lambda s, x: s + x)
        mean = total / n

        def serial(mean: Column) -> Column:
            spread = F.aggregate(codes, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
            cross = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["x"] - mean) * (p["y"] - mean))
            r = F.when(spread > 0, F.abs(cross / spread)).otherwise(F.lit(1.0))
            return normal_cdf((r - SERIAL) * F.sqrt(n - 1))

        return F.greatest(p_chi, p_runs, let(mean, serial))

    codes = F.transform(F.split(body, ""), lambda c: F.ascii(c))
    codes = F.filter(codes, lambda c: c > 0)
    return let(codes, lambda c: let(alphabet(body), lambda a: tests(c, a)))


def random_spans(text: Column) -> Column:
    """Spans of the tokens of a text that the battery and the step-up declare random."""

    def declared(tested: Column) -> Column:
        m = F.size(tested)
        ordered = F.array_sort(F.transform(tested, lambda t: t["p"]))
        limit = F.aggregate(
            F.transform(ordered, lambda p, i: F.when(p <= FALSE_SHARE * (i + 1) / m, p).otherwise(F.lit(-1.0))),
            F.lit(-1.0),
            lambda s, x: F.greatest(s, x),
        )
        return let(limit, lambda l: F.transform(F.filter(tested, lambda t: t["p"] <= l), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))))

    def tested(spans: Column, tokens: Column) -> Column:
        mean = F.aggregate(tokens, F.lit(0.0), lambda s, t: s + F.length(t)) / F.size(tokens)
        return let(
            mean,
            lambda mean: F.zip_with(
                spans,
                tokens,
                lambda s, t: F.struct(
                    (p_value(t) * mean / F.length(t)).alias("p"), s["start"].alias("start"), s["end"].alias("end")
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)),
        lambda tokens: F.when(
            F.size(tokens) > 0, let(tested(match_spans(text, TOKEN), tokens), declared)
        ).otherwise(F.array().cast(SPAN)),
    )


def with_secrets(docs: DataFrame, text: Column, name: str = "secrets") -> DataFrame:
    """`docs` with a struct of spans by kind: assign, access, hex, and random where it overlaps none of the others."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.withColumn("__t", F.coalesce(text.cast("string"), F.lit("")))
    out = out.select(
        *columns,
        "__t",
        assignments(F.col("__t")).alias("__a"),
        F.when(F.contains("__t", F.lit("AKIA")), match_spans(F.col("__t"), ACCESS)).otherwise(F.array().cast(SPAN)).alias("__k"),
        match_spans(F.col("__t"), HEX).alias("__h"),
        random_spans(F.col("__t")).alias("__r"),
    )
    free = apart(F.col("__r"), F.concat("__a", "__k", "__h"))
    return out.select(
        *columns, F.struct(F.col("__a").alias("assign"), F.col("__k").alias("access"), F.col("__h").alias("hex"), free.alias("random")).alias(name)
    )


def ordered_spans(secrets: str, kinds: tuple[str, ...]) -> Column:
    """All spans by start, then kind."""
    def tagged(kind: str) -> Column:
        return F.transform(
            F.col(f"{secrets}.{kind}"),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    return F.sort_array(F.concat(*[tagged(kind) for kind in kinds]))


def span_text(secrets: str, kinds: tuple[str, ...]) -> Column:
    return F.array_join(
        F.transform(ordered_spans(secrets, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the spans by kind of every row.

    Other columns are not looked at. A null or empty text has no spans. Repeated rows get equal answers, rows without an id
    are scanned too. Spans of different base kinds may overlap; of one kind they never do. Empty input gives an empty result.
    """
    slim = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("__text"))
    return with_secrets(slim, F.col("__text")).select("doc_id", "secrets")


def secrets_digest(found: DataFrame) -> DataFrame:
    base = KINDS[:3]
    return found.select(
        "doc_id",
        *[F.size(f"secrets.{kind}").cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(span_text("secrets", base), 256).alias("base_sha256"),
        span_text("secrets", KINDS).alias("spans"),
    )


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """`docs` with every span replaced by `mask`; overlapping spans make one. Other columns stay as they are, whatever their names.

    Null stays null, a text without secrets stays as it is; repeated rows are masked alike, an empty table stays empty.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = with_secrets(row, F.col(f"row.`{text_col}`")).withColumn("__s", joined(ordered_spans("secrets", KINDS)))
    text = F.col(f"row.`{text_col}`").cast("string")

    def cut(chars: Column) -> Column:
        """The characters up to each span and the mask in its place, then what is left."""
        end = lambda i: F.coalesce(F.get(F.col("__s"), i - 1)["end"], F.lit(0))
        part = lambda low, high: F.array_join(F.slice(chars, low + 1, high - low), "")
        pieces = F.transform("__s", lambda s, i: F.concat(part(end(i), s["start"]), F.lit(mask)))
        return F.concat(F.array_join(pieces, ""), part(end(F.size("__s")), F.size(chars)))

    masked = F.when(F.size("__s") > 0, let(F.split(text, ""), cut)).otherwise(F.col(f"row.`{text_col}`"))
    return found.select(*[masked.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
