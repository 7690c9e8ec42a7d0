"""What each contract says, word by word, over lists of rows: slow and without Spark."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text: str | None) -> dict:
    text = text or ""
    words = WHITE.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            hit |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WHITE.search(line):
            again += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": again,
        "n_repeat_words": len(hit),
        "base_failed": len(words) < 50 or 100 * len(hit) > 50 * len(words),
    }


def shingle_set(text: str | None) -> frozenset:
    words = WHITE.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_classes(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, bool]]:
    sets = {d: shingle_set(t) for d, t in rows}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, s in sets.items():
        shared = Counter(o for x in s for o in where[x] if o < d)
        for o, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
    low = {}
    for d in sorted(sets):
        low.setdefault(root(d), d)
    return {d: (len(s), low[root(d)], d == low[root(d)]) for d, s in sets.items()}


def contamination(rows, items) -> dict:
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall((text or "").translate(LOWER))
        if words and len(words) < 10:
            windows[tuple(words)].add(item)
        for i in range(len(words) - 9):
            windows[tuple(words[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for d, text in rows:
        words = PLAIN.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                w = tuple(words[i : i + size])
                if w in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[w]
        out[d] = (len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def without_repeats(rows, length: int = 400) -> dict:
    often = Counter()
    texts = {d: (t or "").encode() for d, t in rows}
    for b in texts.values():
        for i in range(len(b) - length + 1):
            often[hash(b[i : i + length])] += 1
    out = {}
    for d, b in texts.items():
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if often[hash(b[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


ASSIGN = re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secrets(text: str | None) -> tuple:
    text = text or ""
    found = {
        "assign": [(m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8],
        "access": [(m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16],
        "hex": [(m.start(), m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32],
    }
    order = {k: i for i, k in enumerate(found)}
    spans = sorted(((s, order[k], e, k) for k, v in found.items() for s, e in v))
    return (*[len(found[k]) for k in order], sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)))


def luhn(d: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def personal(text: str | None) -> tuple:
    text = text or ""
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p[-4:]) <= 255 and int(p) <= 255 if len(p) < 4000 else False for p in m[0].split("."))]
    card = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]
    phone = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    kinds = {"email": email, "ip": ip, "card": card, "phone": phone}
    return (*[len(v) for v in kinds.values()], sha(",".join(f"{k}:{s}:{e}" for k, v in kinds.items() for s, e in v)))


def conversation(turns: list[tuple[str | None, str | None]]) -> tuple:
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
