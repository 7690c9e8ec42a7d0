"""The learned and the statistical operators against plain versions, a number at a time."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from modelstream.llm import common, language, quality_model, quality_rules, secrets_scan

MASK = (1 << 64) - 1


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def single(x):
    """`x` as a number of 32 bits."""
    return struct.unpack("f", struct.pack("f", x))[0]


def learning_order(frame):
    """The ids in the order in which they are learned from."""
    rows = frame.filter("doc_id is not null").select("doc_id", F.xxhash64("doc_id", F.lit(7)).alias("place")).collect()
    return [r.doc_id for r in sorted(rows, key=lambda r: (r.place, r.doc_id))]


class PlainLearner:
    """Follow-the-regularised-leader with a dictionary entry for each feature and class."""

    def __init__(self, classes, bias):
        self.classes, self.bias = classes, bias
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, f, k):
        z, n = self.z[f, k], self.n[f, k]
        return 0.0 if abs(z) <= 0.02 else -(z - math.copysign(0.02, z)) / (1.0 + math.sqrt(n) + 0.1)

    def logits(self, x):
        return [sum(v * self.weight(f, k) for f, v in [*x.items(), (self.bias, 1.0)]) for k in range(self.classes)]

    def learn(self, x, label):
        logits = self.logits(x)
        shares = [math.exp(v - max(logits)) for v in logits]
        for k in range(self.classes):
            error = shares[k] / sum(shares) - (k == label)
            for f, v in [*x.items(), (self.bias, 1.0)]:
                g = error * v
                w = self.weight(f, k)
                self.z[f, k] += g - (math.sqrt(self.n[f, k] + g * g) - math.sqrt(self.n[f, k])) * w
                self.n[f, k] += g * g


# --- language -------------------------------------------------------------------------------------------------------


def gram_counts(text):
    chars = [c if not c.isalpha() else c.lower() if len(c.lower()) == 1 else c for c in text]
    codes = [ord(c) if c.isalpha() else 32 for c in chars] + [32, 32]
    out = Counter()
    for i in range(len(text)):
        h = 0
        for n in range(3):
            h = (h + codes[i + n] + n) * 0x9E3779B1 & 0xFFFFFFFF
            h ^= h >> 15
            out[(h * 0x85EBCA77 & 0xFFFFFFFF) >> 16] += 1
    return out


def plain_languages(frame, rows):
    """lang_pred and score by id, for tables that the sample covers whole."""
    learned = {i: (t, l) for i, t, l in rows if i is not None and t is not None and l is not None and not held_out(i)}
    names = sorted({l for _, l in learned.values()})
    df = Counter(b for t, _ in learned.values() for b in gram_counts(t))
    idf = lambda b: math.log((1 + len(learned)) / (1 + df[b])) + 1

    def example(text):
        counts = gram_counts(text)
        total = max(1, sum(counts.values()))
        return {b: 4.0 * single(n / total) * idf(b) for b, n in counts.items()}

    seen, train, kept = Counter(), [], []
    for i in learning_order(frame):
        if i in learned:
            text, lang = learned[i]
            seen[lang] += 1
            (train if seen[lang] % 5 else kept).append((example(text), names.index(lang)))
    learner = PlainLearner(len(names), "bias")
    for _ in range(2):
        for x, label in train:
            learner.learn(x, label)

    def loss(t):
        total = 0.0
        for x, label in kept:
            z = [v / t for v in learner.logits(x)]
            total += max(z) + math.log(sum(math.exp(v - max(z)) for v in z)) - z[label]
        return total

    best = min(np.geomspace(0.05, 20, 121), key=loss) if kept else 1.0
    out = {}
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            out[i] = ("und", 0.0)
            continue
        counts = gram_counts(text)
        total = sum(counts.values())
        x = {b: 4.0 * n / total * idf(b) for b, n in counts.items()}
        z = [v / best for v in learner.logits(x)]
        p = [math.exp(v - max(z)) for v in z]
        out[i] = (names[p.index(max(p))], max(p) / sum(p))
    return out


def test_language_equals_the_plain_version(spark):
    rng = random.Random(8)
    syllables = {"a": ["ka", "lo", "mi"], "b": ["the", "ing", "lo"], "c": ["ß", "ÜN", "ka", "İs", "漢字"]}
    rows = []
    for i in range(70):
        lang = "abc"[i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(rng.randint(1, 6))), lang if i % 10 else None))
    rows += [(100, None, "a"), (101, "", "b"), (102, "12 !", "c"), (103, "x", None), (104, "ka lo " * 400, "a"), (105, "the", "once")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = {r.doc_id: r for r in language.languages(frame).collect()}
    wanted = plain_languages(frame, rows)
    assert {i: r.lang_pred for i, r in found.items()} == {i: lang for i, (lang, _) in wanted.items()}
    assert max(abs(found[i].score - s) for i, (_, s) in wanted.items()) < 1e-6


def test_only_text_tells_the_language(spark):
    rows = [(i, "ka lo mi" if i % 2 else "the ing on", "x" if i % 2 else "y", "s") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.languages(frame).collect()}
    # Other values of columns that are no input, and clashing names; those of the rows that are not learned from change nothing.
    other = frame.select(
        "doc_id", "text", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "z").otherwise(F.col("lang")).alias("lang"),
        F.lit(None).alias("source"), F.lit("a").alias("bucket"), F.lit("b").alias("label"), F.lit("c").alias("epoch"), F.lit(1).alias("n"),
    )
    assert {r.doc_id: (r.lang_pred, r.score) for r in language.languages(other).collect()} == found
    # Texts without any language to learn.
    nothing = language.languages(frame.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == 40 and {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


@pytest.mark.parametrize("cells", [1, 7, 1 << 22])
def test_sparse_sums_do_not_depend_on_the_cut(monkeypatch, cells):
    rng = np.random.default_rng(3)
    dense = rng.normal(size=((1 << language.BITS), 5)) * (rng.random(((1 << language.BITS), 5)) < 0.3)
    bucket, lang = np.nonzero(dense)
    start = np.searchsorted(bucket, np.arange((1 << language.BITS) + 1))
    model = language.Model(list("abcde"), start, lang, dense[bucket, lang], np.zeros(5), 1.0)
    texts = ["", "the cat", "", "ünï 漢", "x" * 50, ""]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    at = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    columns, first, _ = language.grams(body, at)
    monkeypatch.setattr(language, "CELLS", cells)
    wanted = [sum((n * dense[b] for b, n in gram_counts(t).items()), np.zeros(5)) for t in texts]
    assert np.allclose(model.sums(columns, first), wanted)


# --- quality model --------------------------------------------------------------------------------------------------


def mixed(x):
    x &= MASK
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def feature_counts(text):
    out = Counter()
    before = {1: 0, 2: 0}
    for token in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", text.encode()):
        h = sum(mixed((b + 1) * 0xA24BAED4963EE407 + 1) * pow(common.BASE, j, 1 << 64) for j, b in enumerate(token))
        word = mixed(h + len(token))
        upper = sum(65 <= b <= 90 for b in token)
        if re.match(rb"[0-9A-Za-z\x80-\xff]", token):
            shape = min(len(token), 12) // 2 * 4 + min(upper, 1) + (upper == len(token)) + 2000
        else:
            shape = word >> 1
        for salt, x in ((1, word), (2, mixed(shape + 99))):
            for k, h in ((0, x), (1, before[salt] * common.RUN + x)):
                out[mixed(h + 10 * salt + k) >> 46] += 1
            before[salt] = x
    return out


def test_quality_model_equals_the_plain_version(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(80):
        bad = rng.random() < 0.4
        rows.append((i, " ".join(rng.choice(["word", "Über", "TEN", "a1", "x", "$$$" if bad else "fine."]) for _ in range(rng.randint(0, 12)))))
        if i % 4:
            labels.append((i, int(not bad), 0))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "word " * 3000), (204, "漢字 #x")]
    labels += [(203, 0, 0), (204, 7, 0), (None, 1, 0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in quality_model.quality_scores(frame, marks).collect()}

    texts, quality = dict(rows), {i: q for i, q, _ in labels if i is not None and q in (0, 1) and not held_out(i)}
    share = lambda text: {f: 6.0 * n for f, n in feature_counts(text).items()}
    learner = PlainLearner(2, "bias")
    for _ in range(4):
        for i in learning_order(frame):
            if i in quality:
                x = share(texts[i] or "")
                total = max(1, sum(feature_counts(texts[i] or "").values()))
                learner.learn({f: single(v / total) for f, v in x.items()}, quality[i])
    for i, text in rows:
        x = share(text or "")
        total = max(1, sum(feature_counts(text or "").values()))
        low, high = learner.logits({f: v / total for f, v in x.items()})
        score = 1 / (1 + math.exp(low - high))
        assert abs(found[i].score - score) < 1e-5 and found[i].predicted == (found[i].score >= 0.5) and found[i].held_out == held_out(i)


# --- quality rules --------------------------------------------------------------------------------------------------


def test_cutoffs_and_verdicts_equal_the_plain_version(spark):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(1800):
        size = 60 if i % 3 else 160
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(size)]
        junk = i % 5 == 0
        # Good texts have few marks and signs, a handful of them many; junk has many.
        for k in range(rng.choice([0, 1, 2, 20]) if junk else rng.choice([0, 0, 1, 2]) + 30 * (i % 250 == 1)):
            words[k] += "!"
        for k in range(rng.randrange(40) if junk else rng.randrange(3)):
            words[k] += "#"
        rows.append((i, " ".join(words)))
        if i % 10 != 7:
            labels.append((i, int(not junk), 0))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(frame, marks).collect()}

    def measure(text):
        counts = brute.quality_counts(text)
        return {
            "n_words": counts["n_words"], "base_failed": counts["base_failed"], "symbols": counts["n_symbols"],
            "dup_lines": counts["n_dup_lines"], "repeat_words": counts["n_repeat_words"], "marks": text.count("!"),
        }

    stats = {i: measure(t) for i, t in rows}
    band = lambda s: sum(s["n_words"] >= end for end in quality_rules.BANDS)
    good = [stats[i] for i, q, _ in labels if q == 1 and not stats[i]["base_failed"]]
    rate, level = 0.06 / 4, 0.05 / 12
    cutoffs = {}
    for stratum in range(3):
        own = [s for s in good if band(s) == stratum]
        for rule, cuts in quality_rules.CUTOFFS.items():
            for cut in cuts:
                x = sum(100 * s[rule] > cut * s["n_words"] for s in own)
                tail = sum(math.comb(len(own), k) * rate**k * (1 - rate) ** (len(own) - k) for k in range(x + 1))
                if not own or x > rate * len(own) or tail > level:
                    break
                cutoffs[stratum, rule] = cut
    kept = {
        i: not s["base_failed"] and not any(100 * s[r] > cutoffs.get((band(s), r), math.inf) * s["n_words"] for r in quality_rules.CUTOFFS)
        for i, s in stats.items()
    }
    assert found == kept
    # The case is one where the method decides: cutoffs are accepted, and they reject what the base rules pass.
    assert {s for s, _ in cutoffs} == {0, 1} and any(not kept[i] and not s["base_failed"] for i, s in stats.items())


# --- secrets --------------------------------------------------------------------------------------------------------


def phi(z):
    return 0.5 * math.erfc(-z / math.sqrt(2))


def battery(token):
    """The largest p-value of a token."""
    body = token.rstrip("=")
    kinds = [
        ("[0-9]+", 10, (5, 5)), ("[0-9a-f]+|[0-9A-F]+", 16, (10, 6)), ("[A-Z2-7]+", 32, (26, 6)), ("[A-Za-z0-9]+", 62, (26, 26, 10)),
        (".*", 64, (26, 26, 10, 2)),
    ]
    size, classes = next((size, classes) for pattern, size, classes in kinds if re.fullmatch(pattern, body))

    def char_class(c):
        if size == 10:
            return int(c) % 2
        return "digit" if c in "0123456789" else "upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "sign"

    n, codes = len(body), [ord(c) for c in body]
    chi = sum(x * x for x in Counter(body).values()) * size / n - n
    shift = n * 0.6 * (3 if size > 40 else 1)
    p_chi = phi((chi - (size - 1) - shift) / math.sqrt(2 * (size - 1 + 2 * shift)))
    changes = sum(char_class(a) != char_class(b) for a, b in zip(body, body[1:]))
    rate = 0.55 * (1 - sum((c / size) ** 2 for c in classes))
    p_runs = 1 - phi((changes - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate)))
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    r = abs(sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / spread) if spread else 1.0
    return max(p_chi, p_runs, phi((r - 0.6) * math.sqrt(n - 1)))


def plain_random(text):
    """The tokens of a text that the step-up declares random, but those that meet a base span."""
    tokens = list(re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", text))
    mean = sum(len(t[0]) for t in tokens) / max(1, len(tokens))
    p = [battery(t[0]) * mean / len(t[0]) for t in tokens]
    passed = [x for k, x in enumerate(sorted(p), 1) if x <= 0.1 * k / len(p)]
    base = [
        m.span()
        for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text)
        if len(m[1]) >= 8
    ]
    base += [m.span() for pattern in ("AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}") for m in re.finditer(pattern, text)]
    chosen = [t.span() for t, x in zip(tokens, p) if passed and x <= max(passed)]
    return [(a, b) for a, b in chosen if not any(a < d and c < b for c, d in base)]


def test_random_tokens_equal_the_plain_version(spark):
    rng = random.Random(11)
    alphabets = ["0123456789", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]
    alphabets += ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + s for s in ("", "+/")]

    def token():
        kind = rng.randrange(4)
        if kind == 0:
            return "".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 90))) + "=" * rng.randrange(3)
        if kind == 1:
            return "_".join(rng.choice(["value", "Index", "table", "row", "name"]) for _ in range(rng.randint(4, 9)))
        if kind == 2:
            return rng.choice("aZ9-") * rng.randint(20, 60)
        return rng.choice(["0123456789" * 3, "abcdefghijklmnopqrstuvwxyz", "token=" + "q7" * 12, "AKIA" + "B3" * 9, "0f" * 20])

    rows = [(i, " ".join(rng.choice([token, lambda: "word", lambda: "Ünï"])() for _ in range(rng.randrange(14)))) for i in range(250)]
    frame = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id bigint, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.secrets.random] for r in secrets_scan.scan_secrets(frame).collect()}
    assert found == {i: plain_random(t) for i, t in rows} | {900: [], 901: []}
    assert sum(map(len, found.values())) > 50
    tokens = [token() for _ in range(200)]
    single_tokens = spark.createDataFrame([(t,) for t in tokens if re.fullmatch("[A-Za-z0-9+/_-]{20,}={0,2}", t)], "t string")
    for r in single_tokens.select("t", secrets_scan.p_value(F.col("t")).alias("p")).collect():
        assert abs(r.p - battery(r.t)) < 1e-6


# --- pipeline -------------------------------------------------------------------------------------------------------


def written(folder, **frames):
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_of_clashing_columns_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    text = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    secret = "password = hunter2hunter2"
    good = text(80)
    rows = [(1, good), (2, good), (3, None), (4, ""), (5, text(20)), (6, f"{text(70)} {secret}"), (None, text(90)), (8, text(4000)), (8, text(60))]
    clashing = ["stats", "row", "kept", "component_id", "key", "label", "value", "spans", "secrets", "ids", "part", "__t", "a.b"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(clashing)])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([], "item_id string, text string")
    source = written(tmp_path / "some", documents=docs, labels=labels, benchmark=items)
    stages = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, source)
        assert stages.columns == docs.columns
    left = {(r.doc_id, r.text) for r in stages.collect()}
    assert left == {(i, t.replace(secret, "[secret]")) for i, t in rows if t and len(t.split()) >= 50 and i != 2}
    found = corpus_pipeline.run(spark, source).collect()
    assert sorted(r.doc_id for r in found if r.doc_id) == [1, 6, 8, 8] and len(found) == 5
    source = written(tmp_path / "none", documents=docs.limit(0), labels=labels, benchmark=items)
    assert corpus_pipeline.run(spark, source).collect() == []
