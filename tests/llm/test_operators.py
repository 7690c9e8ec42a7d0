"""The operators against brute force on a small table, and their edge cases."""

import itertools
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from modelstream.llm import (
    chat_tree,
    decontaminate,
    language,
    near_dedup,
    pii,
    quality_model,
    quality_rules,
    secrets_scan,
    sentencepiece_nbest,
    substring_dedup,
)


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_nbest_is_what_enumeration_finds():
    pieces = sentencepiece_nbest.pieces_of(sentencepiece_nbest.VOCABULARY)

    def all_paths(word):
        ends = pieces.edges(word)

        def back(j):
            if j == 0:
                yield 0.0, ()
            for i, score, ids in ends[j]:
                for s, own in back(i):
                    yield s + score, own + ids

        return list(back(len(word)))

    for text in ["the cat", "a b", "  x", "é1\n▁z", "hello"]:
        words = sentencepiece_nbest.WORDS.findall(text)
        assert "".join(words) == text
        whole = [(sum(p[0] for p in ps), tuple(i for p in ps for i in p[1])) for ps in itertools.product(*map(all_paths, words))]
        best = sorted((s for s, _ in whole), reverse=True)
        for most in (1, 2, 5, 40):
            found = pieces.encode(text, most)
            assert [s for s, _ in found] == best[:most]
            assert len({ids for _, ids in found}) == len(found) and set(found) <= set(whole)
            assert all(pieces.decode(ids) == text for _, ids in found)


def test_encode_and_decode(spark, docs):
    frame, rows = docs
    found = sentencepiece_nbest.encode_nbest(frame)
    texts = sentencepiece_nbest.decode(found.selectExpr("doc_id", "segmentations[0].ids as ids"))
    assert by_id(texts, "text") == {i: (t or "",) for i, t in rows}
    assert sentencepiece_nbest.nbest_digest(empty(spark)).count() == 0


def test_quality_counts(spark, docs):
    frame, rows = docs
    keys = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    labels = labels_of(spark, [(i, 1, 0) for i, _ in rows] + [(1, 0, 0), (None, 1, 0), (2, None, None)])
    found = quality_rules.quality_verdicts(frame, labels)
    assert by_id(found, *keys) == {i: tuple(brute.quality_counts(t)[k] for k in keys) for i, t in rows}
    # Too few good texts: only the base rules reject.
    assert all(r.kept == (not r.base_failed) for r in found.collect())
    assert quality_rules.quality_verdicts(empty(spark), labels_of(spark, [])).count() == 0


def test_cutoffs_hold_their_risk(spark):
    from math import comb

    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(0, 400), (3, 900), (20, 900), (5, 5)], "x bigint, n bigint")
    for r in frame.select("x", "n", quality_rules.binomial_tail(F.col("x"), F.col("n"), 0.015).alias("p")).collect():
        assert r.p == pytest.approx(sum(comb(r.n, i) * 0.015**i * 0.985 ** (r.n - i) for i in range(r.x + 1)), rel=1e-9)
    stats = "struct<n_words:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,n_marks:bigint,stratum:int>"
    good = spark.createDataFrame([((200, i % 40, 0, 0, 0, 1),) for i in range(2000)], f"stats {stats}")
    cut = quality_rules.choose_cutoffs(good).first()
    assert cut.symbols == 20 and cut.dup_lines == 1  # 39 symbols in 200 words are the most that good texts have


def test_keep_good_keeps_all_columns(spark, docs):
    frame, rows = docs
    kept = quality_rules.keep_good(frame, labels_of(spark, []))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in rows if not brute.quality_counts(t)["base_failed"])


def test_near_classes(spark, docs):
    frame, rows = docs
    found = near_dedup.near_classes(frame)
    assert by_id(found, "n_shingles", "component_id", "kept") == brute.near_classes(rows)
    assert near_dedup.near_classes(empty(spark)).count() == 0


def test_near_copies_in_a_large_group(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(words)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(120)] = f"x{i}{rng.randrange(9)}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert by_id(near_dedup.near_classes(frame), "n_shingles", "component_id", "kept") == brute.near_classes(rows)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(5, text), (5, text), (None, text), (None, "alone"), (5, "other text here")], "doc_id bigint, text string")
    found = near_dedup.near_classes(frame).collect()
    wanted = [(5, 26, 5, True), (5, 26, 5, True), (None, 26, 5, False), (None, 1, None, True), (5, 1, 5, True)]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in found)
    assert near_dedup.one_of_each(frame).count() == 3


def test_one_of_each_near_copy_without_or_with_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    rows = [(None, f"{one} a"), (None, f"{one} b"), (None, f"{one} c"), (None, f"{one} c")]
    rows += [(7, f"{two} a"), (7, f"{two} b"), (9, f"{two} c"), (None, f"{two} d"), (7, f"{three} a"), (None, f"{three} b")]
    rows += [(None, "alone"), (3, ""), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [(r.doc_id, r.text) for r in near_dedup.one_of_each(frame).collect()]
    assert set(found) <= set(rows)
    groups = sorted((str(i), t[:2] if t else t or "") for i, t in found)
    assert groups == sorted([("None", "x0"), ("7", "y0"), ("7", "z0"), ("None", "al"), ("3", ""), ("4", "")])


def test_quality_model_learns_and_holds_out(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        rows.append((i, " ".join(f"w{rng.randrange(50)}" + ("$$$" if bad else "") for _ in range(40))))
        labels.append((i, 1 - bad, 0))
    rows += [(1000, None), (1001, ""), (None, "w1 w2")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = quality_model.quality_scores(frame, labels_of(spark, labels)).collect()
    tested = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(found) == len(rows) and sum(r.predicted == 1 - r.doc_id % 2 for r in tested) >= 0.95 * len(tested)
    assert {r.score for r in quality_model.quality_scores(frame, labels_of(spark, [])).collect()} == {0.5}


def test_chats(spark):
    marks = r"\### Assistant: </turn> ok"
    chats = {
        1: [("user", "hi"), ("assistant", "hello"), ("user", "a")],
        2: [("user", "hi"), ("assistant", "hello"), ("user", "b"), ("assistant", "")],
        3: [("user", "hi"), ("assistant", "hello")],
        4: [("user", "hi"), ("assistant", "hello")],
        5: [(None, None), ("assistant", marks), ("a:b\\", "### x\\\n</turn>\n### ")],
        6: [("assistant", "####</turn></turn>\\\\")],
    }
    rows = [(c, n, r, t, "z") for c, turns in chats.items() for n, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, path string")
    for limit in (1, 1 << 15):
        found = chat_tree.chat_digest(frame, limit).collect()
        assert {r.conv_id: tuple(r)[1:5] for r in found} == {c: brute.conversation(t) for c, t in chats.items()}
    packs, members = chat_tree.format_chats(frame)
    texts = "".join(r.text for r in packs.collect())
    assert texts.count("hello") == 1 and members.count() == 6
    assert chat_tree.chat_digest(frame.limit(0)).count() == 0


def test_personal_data(spark, docs):
    frame, rows = docs
    found = pii.personal_digest(pii.personal_data(frame))
    assert by_id(found, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == {i: brute.personal(t) for i, t in rows}
    assert pii.personal_data(empty(spark)).count() == 0


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("write to jo [at] mail [dot] example.com now", "email", "jo [at] mail [dot] example.com"),
        ("write jo at example dot org", "email", "jo at example dot org"),
        ("jо@examplе.com", "email", "jо@examplе.com"),
        ("call plus four four two zero seven nine four six", "phone", "plus four four two zero seven nine four six"),
        ("４１１１１１１１１１１１１１１１", "card", "４１１１１１１１１１１１１１１１"),
        ("host one dot two dot three dot four", "ip", "one dot two dot three dot four"),
    ],
)
def test_disguises(text, kind, source):
    found = [(k, text[s:e]) for k, s, e, base in pii.scan(text) if not base or k == kind]
    assert (kind, source) in found


@pytest.mark.parametrize("other", ["", "jo [at] mail [dot] example.com or ", "４２ "])
@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("write john at example.com now", "email", "john at example.com"),
        ("call +44 20 seven nine 46 0958 today", "phone", "+44 20 seven nine 46 0958"),
        ("call +44 20 seven 946 0958 today", "phone", "+44 20 seven 946 0958"),
    ],
)
def test_disguises_do_not_depend_on_other_text(other, text, kind, source):
    found = [(k, (other + text)[s:e]) for k, s, e, _ in pii.scan(other + text)]
    assert (kind, source) in found


def test_letters_that_fold_to_others():
    assert pii.scan("ſix 5 ſeven FIVE fıve 5 ſix seven eight nine") == []


def test_long_white_space_is_read_once():
    assert pii.scan("a" + " " * 300_000 + "b" + "\n" * 300_000 + "jo at x.org")[0][0] == "email"


def test_plain_prose_has_no_personal_data():
    assert pii.scan("We met at noon, one of two at the dot. Zero risk at all, über café.") == []


def test_contamination(spark, docs):
    frame, rows = docs
    words = rows[28][1].split()
    items = [(1, " ".join(words[-40:])), (2, "nothing of the kind is in any document of this small table"), (3, None), (4, "x"), (5, rows[3][1]), (None, "x"), (6, "x")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    wanted = brute.contamination(rows, [i for i in items if i[0] is not None])
    for block in (1 << 25, 200):
        found = decontaminate.contamination_digest(decontaminate.contamination(frame, bench, block_bytes=block))
        assert by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == wanted
        clean = decontaminate.drop_contaminated(frame, bench, block_bytes=block)
        assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {i for i, v in wanted.items() if not v[4]}
    assert not any(r.contaminated for r in decontaminate.contamination_digest(decontaminate.contamination(frame, bench.limit(0))).collect())


def test_without_repeats(spark, docs):
    frame, rows = docs
    found = substring_dedup.removal_digest(substring_dedup.without_repeats(frame))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.without_repeats(rows)
    assert substring_dedup.without_repeats(empty(spark)).count() == 0


def test_large_anchors_take_the_other_way(spark, docs, monkeypatch):
    frame, rows = docs
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 600)
    found = substring_dedup.removal_digest(substring_dedup.without_repeats(frame))
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.without_repeats(rows)


def test_common_passages_go_to_many_tasks(spark, monkeypatch):
    """A passage in every document, each time between other words: one anchor with many stretches, one stretch with many places."""
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    passage, copy = text(70), text(60)[:400]
    rows = [(i, f"{text(60)} {passage} {text(60)}") for i in range(60)] + [(100 + i, copy) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    tasks, stored, dealt = {}, substring_dedup.common.stored, substring_dedup.dealt_join

    def spread(df, *keys):
        counts = df.groupBy(*keys, F.spark_partition_id().alias("task")).count().groupBy(*keys).agg(F.sum("count").alias("n"), F.count("task").alias("tasks"))
        return counts.orderBy(F.desc("n")).first()

    def seen(df, purpose):
        if purpose == "strings":
            tasks[purpose] = spread(df, "anchor")
        return stored(df, purpose)

    def joined(rows, small, keys, *columns):
        out = dealt(rows, small, keys, *columns)
        tasks[tuple(keys)] = spread(out, *keys)
        return out

    monkeypatch.setattr(substring_dedup.common, "stored", seen)
    monkeypatch.setattr(substring_dedup, "dealt_join", joined)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 600)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = by_id(substring_dedup.removal_digest(substring_dedup.without_repeats(frame)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == brute.without_repeats(rows)
    assert all(tasks[x].n >= 60 and tasks[x].tasks > 1 for x in ("strings", ("anchor",), ("anchor", "digest"))), tasks


def test_stretches_that_share_no_side_meet_no_transform():
    """A filter by the sides of the anchor: it keeps every stretch with a repeated string, and drops those that share a phrase."""
    rng = random.Random(5)
    length, gram = 40, 8
    for _ in range(200):
        core = bytes(rng.choices(b"ab", k=gram))
        shared = bytes(rng.choices(b"cd", k=length)), bytes(rng.choices(b"cd", k=length))
        bodies, places = [], []
        for _ in range(rng.randint(2, 6)):
            left, right = rng.randint(0, length - gram), rng.randint(0, length - gram)
            own = bytes(rng.choices(b"xyz", k=length - gram)), bytes(rng.choices(b"xyz", k=length - gram))
            before = own[0] + shared[0][len(shared[0]) - left :] if left else own[0]
            body = before + core + shared[1][:right] + own[1]
            bodies.append(body)
            places.append(len(before))
        wanted = set()
        for i, (x, p) in enumerate(zip(bodies, places)):
            for j, (y, q) in enumerate(zip(bodies, places)):
                for low in range(gram - length, 1):
                    a, b = x[max(p + low, 0) : p + low + length], y[max(q + low, 0) : q + low + length]
                    if i != j and p + low >= 0 and q + low >= 0 and len(a) == length and a == b:
                        wanted.add(i)
        kept = substring_dedup.alike(bodies, places, length, gram)
        assert wanted <= set(kept)
    apart = [bytes([i]) * 16 + core + bytes([100 + i]) * 16 for i in range(5)]
    assert substring_dedup.alike(apart, [16] * 5, length, gram) == []


def test_backward_extension():
    rng = random.Random(2)
    for length in (3, 16, 20, 40):
        for _ in range(20):
            text = "".join(rng.choices("ab", k=rng.randint(2, 300)))
            text += text[: rng.randint(0, 80)]
            starts = [text[i : i + length] for i in range(len(text))]
            wanted = [len(s) == length and starts.count(s) > 1 for s in starts]
            symbols = np.array([ord(c) for c in text] + [1000])
            assert substring_dedup.repeated_starts(symbols, length)[:-1].tolist() == wanted


def test_secrets(spark, docs):
    frame, rows = docs
    found = secrets_scan.secrets_digest(secrets_scan.scan_secrets(frame))
    assert by_id(found, "n_assign", "n_access", "n_hex", "base_sha256") == {i: brute.secrets(t) for i, t in rows}
    masked = {r.doc_id: r.text for r in secrets_scan.mask_secrets(frame).collect()}
    assert masked[50] == '[secret]" [secret] token=short [secret]' and masked[40] is None and masked[30] == rows[24][1]
    assert secrets_scan.scan_secrets(empty(spark)).count() == 0


def test_random_tokens(spark):
    rng = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(alphabet, k=48)) for _ in range(40)]
    words = ["internationalisierungsbeauftragte", "path/to/some/longer/folder/name", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyz0123456789"]
    frame = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(keys + words)], "doc_id bigint, text string")
    found = {r.doc_id: len(r.secrets.random) for r in secrets_scan.scan_secrets(frame).collect()}
    assert sum(found[i] for i in range(40)) >= 36 and not any(found[40 + i] for i in range(len(words)))


def test_language(spark):
    rng = random.Random(6)
    syllables = {"xx": ["ka", "lo", "mi", "zu"], "yy": ["the", "ing", "er", "on"]}
    rows = []
    for i in range(300):
        lang = "xx" if i % 2 else "yy"
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(20)), lang))
    rows += [(900, None, "xx"), (901, "123 !", "xx"), (902, "kalo", None), (None, "the", "yy")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language.languages(frame).collect()}
    tested = [found[i].lang_pred == l for i, _, l in rows[:300] if found[i].held_out]
    assert sum(tested) >= 0.98 * len(tested)
    assert found[900].lang_pred == found[901].lang_pred == "und" and found[902].lang_pred == "xx"
    assert {r.lang_pred for r in language.languages(frame.withColumn("lang", frame.lang.substr(9, 1)).filter("false")).collect()} == set()


def test_more_languages_than_200(spark):
    rng = random.Random(7)
    rows = [(i, "".join(chr(0x4E00 + 3 * (i % 230) + rng.randrange(3)) for _ in range(20)), f"l{i % 230:03}") for i in range(1380)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language.languages(frame).collect()
    learned = {rows[r.doc_id][2] for r in found if not r.held_out}
    assert len(learned) > 220 and {r.lang_pred for r in found} == learned
    tested = [r.lang_pred == rows[r.doc_id][2] for r in found if rows[r.doc_id][2] in learned]
    assert sum(tested) >= 0.98 * len(tested)


def test_languages_of_few_ids_are_learned(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:12]
    rows = [(d, chr(0x4E00 + 9 * k) * 3 + chr(0x4E01 + 9 * k) * 3, f"l{k}") for k, d in enumerate(ids) for _ in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {(r.doc_id, r.lang_pred) for r in language.languages(frame, most=1).collect()} == {(d, f"l{k}") for k, d in enumerate(ids)}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    found = {r.doc_id for r in corpus_pipeline.run(spark, source).collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{source}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{source}/benchmark.parquet").collect()]
    # So few labels accept no cutoff, so the first stage is the base rules.
    good = [(i, t) for i, t in docs if not brute.quality_counts(t)["base_failed"]]
    classes = brute.near_classes(good)
    one = [(i, t) for i, t in good if classes[i][2]]
    dirty = brute.contamination(one, items)
    assert found == {i for i, _ in one if not dirty[i][4]}
