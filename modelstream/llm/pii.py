"""Personal data in texts, also in disguise, with spans of the source.

A transducer rewrites a text and keeps, for every character it writes, the source span it stands for: look-alike characters become
plain ones, invisible ones vanish, spelled digits become digits, and disguised `at` and `dot` become signs. The same patterns then run
over the source and over what was written; a find in the latter is mapped back and added unless it overlaps a find
of its kind in the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

# The patterns of the base kinds, each begun where a run of its characters begins and without a way back into
# a run, so that a text is read a few times whatever stands in it. The finds are those of the plain patterns: where one fails
# at the beginning of a run, it fails inside it too. The part of an address before the @ is taken backwards from it.
LOCAL = "".join(map(chr, (*range(48, 58), *range(65, 91), *range(97, 123)))) + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
ALIKE = str.maketrans(
    "АВЕЅІЈКМНОРСТХУаеіјорсухѕһԁԛԝαοερνικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "ABESIJKMHOPCTXYaeijopcyxshdqwaoepvikuABEZHIKMNOPTYX",
)
HIDDEN = "­​‌‍⁠﻿"
DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
# Letters in either case, but no others that Unicode folds to them.
_DIGIT = "(?a:" + "|".join(DIGITS) + ")"

# What is rewritten: characters of the listed kinds, and signs and digits in words (`TOKEN`).
SUSPECT = re.compile(
    "[" + "".join(map(chr, ALIKE)) + HIDDEN + "²³¹⁰-⁹₀-₉①-⑨！-～\U0001d400-\U0001d7ff]"
)
# Every find of `TOKEN` holds one of these, the second in lower case; both are searched much faster.
SIGNS = re.compile(r"[\[({<]\s*(?:at|arroba|dot|punto|point|punkt)|\s(?:at|dot)\s", re.I)
SPELLED = re.compile("|".join(DIGITS))

# White space before a bracket is taken from its beginning on, so a long run of it is read once.
_OPEN, _CLOSE = r"(?:(?<!\s)\s+)?[\[({<]\s*", r"\s*[\])}>]\s*"
# Words that follow "dot" in prose and end no address.
_NO_DOMAIN = r"(?:a|an|and|for|from|of|on|or|that|the|with)\b"
TOKEN = re.compile(
    r"(?=[\s\[({<]|\b[zotfsenp])(?:"
    rf"(?P<at>{_OPEN}(?:at|arroba){_CLOSE}|(?<=[A-Za-z0-9_%+-])\s+at\s+(?=[A-Za-z0-9-]+(?:\s+dot\s+|{_OPEN}(?:dot|punto|point|punkt){_CLOSE}|\.)(?!{_NO_DOMAIN})[A-Za-z0-9]))"
    rf"|(?P<dot>{_OPEN}(?:dot|punto|point|punkt){_CLOSE}|(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9]))"
    rf"|(?P<digits>\b(?:plus\s+)?{_DIGIT}(?:[\s,-]+{_DIGIT})*\b))",
    re.I,
)
_ONE = re.compile(_DIGIT, re.I)


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        if i % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`: each @ with the run before it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        # What stands before this sign belongs to no later one.
        end = m.end() if m else at + 1
        at = text.find("@", end)


def find(text: str) -> list[tuple[str, int, int]]:
    """The finds of the base patterns: by kind, then start."""
    out = [("email", *span) for span in addresses(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def plain_characters(text: str) -> tuple[str, Sequence[int], Sequence[int]]:
    """Look-alikes replaced and hidden characters dropped; the source start and end of each character written."""
    if text.isascii() or not SUSPECT.search(text):
        return text, range(len(text)), range(1, len(text) + 1)
    out, start, end = [], [], []
    for i, c in enumerate(text):
        if c < "\u0080":
            plain = c
        elif c in HIDDEN:
            continue
        elif SUSPECT.match(c):
            plain = c.translate(ALIKE)
            plain = unicodedata.normalize("NFKC", c) if plain == c else plain
        else:
            plain = c
        for p in plain:
            out.append(p)
            start.append(i)
            end.append(i + 1)
    return "".join(out), start, end


def rewrite(text: str) -> tuple[str, Sequence[int], Sequence[int]]:
    """`text` without disguises, and the source start and end of every character of it."""
    text, start, end = plain_characters(text)
    out, low, high, at = [], [], [], 0

    def write(piece: str, a: int, b: int) -> None:
        # One source span for all of a rewritten piece.
        out.append(piece)
        low.extend([start[a]] * len(piece))
        high.extend([end[b - 1]] * len(piece))

    def copy(a: int, b: int) -> None:
        out.append(text[a:b])
        low.extend(start[a:b])
        high.extend(end[a:b])

    for m in TOKEN.finditer(text) if SIGNS.search(text) or SPELLED.search(text.lower()) else ():
        words, plus = [], False
        if m["digits"] is not None:
            words = list(_ONE.finditer(text, m.start(), m.end()))
            plus = m.group()[:4].lower() == "plus"
            if len(words) < 2 and not plus and not _beside_digit(text, m.start(), m.end()):
                continue
        copy(at, m.start())
        at = m.end()
        if m["at"] is not None:
            write("@", m.start(), m.end())
        elif m["dot"] is not None:
            write(".", m.start(), m.end())
        else:
            if plus:
                write("+", m.start(), m.start() + 4)
            for w in words:
                write(DIGITS[w.group().lower()], w.start(), w.end())
    if not at:
        return text, start, end
    copy(at, len(text))
    return "".join(out), low, high


def _beside_digit(text: str, start: int, end: int) -> bool:
    """Whether a spelled digit stands next to a digit or a sign between numbers."""
    near = text[max(0, start - 5) : start].lower() + "|" + text[end : end + 5].lower()
    return "dot" in near or any(c.isdigit() for c in near)


def scan(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in code points: by kind, then start."""
    base = find(text)
    out = [(*b, True) for b in base]
    plain, low, high = rewrite(text)
    # What is rewritten becomes shorter or another character, so equal texts have no disguise.
    if plain != text:
        known = {k: [b for b in base if b[0] == k] for k in KINDS}
        starts = {k: [b[1] for b in known[k]] for k in KINDS}
        for kind, a, b in find(plain):
            s, e = low[a], high[b - 1]
            # Of the disjoint spans of a kind only the last that begins before this one's end can meet it.
            before = bisect_left(starts[kind], e)
            if not before or known[kind][before - 1][2] <= s:
                out.append((kind, s, e, False))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def _spans(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    for batch in common.batches(source, 1024):
        found = [[dict(zip(("kind", "start", "end", "base"), s)) for s in scan(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, whether found by the base patterns) of every row.

    Other columns are not looked at. A null or empty text has no spans. Spans of one kind do not overlap in the source patterns;
    of different kinds they may (a card number inside an address). Repeated rows get equal answers, rows without an
    id are scanned too. Empty input gives an empty result.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_spans, f"doc_id bigint, spans {SPANS}")


def _digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        rows = batch.column(1).to_pylist()
        base = [[s for s in row if s["base"]] for row in rows]
        line = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array([sum(s["kind"] == k for s in row) for row in base], pa.int64()) for k in KINDS],
                pa.array([hashlib.sha256(line(row).encode()).hexdigest() for row in base], pa.string()),
                pa.array([line(row) for row in rows], pa.string()),
            ],
            ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
        )


def personal_digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text, of each row of `personal_data`."""
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return found.select("doc_id", "spans").mapInArrow(_digest, f"doc_id bigint, {counts}, base_sha256 string, spans string")
