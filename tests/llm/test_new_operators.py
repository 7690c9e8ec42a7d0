"""Filter audit, archives and whitening against brute force on small tables, and their edge cases."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

from modelstream.llm import filter_audit, warc, whitening

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def audit_brute(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    low = {}
    for d, t, _ in rows:
        if d is not None:
            low[t or ""] = min(low.get(t or "", d), d)
    docs = []
    for d, t, lang in rows:
        t = t or ""
        words = WHITE.findall(t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and d > low[t],
        }
        docs.append((lang or "", d, {f for f in fails if fails[f]}))
    out = {}
    for part in {p for p, _, _ in docs}:
        shapley = dict.fromkeys("ABCDE", 0)
        own = {}
        for order in itertools.permutations("ABCDE"):
            left = [(d, f) for p, d, f in docs if p == part]
            gone = []
            for step, name in enumerate(order, 1):
                hit = [(d, f) for d, f in left if name in f]
                redundant = sum(name in f for _, f in gone)
                left = [(d, f) for d, f in left if name not in f]
                gone += hit
                alone = sum(f == {name} for p, _, f in docs if p == part)
                own["".join(order), step] = [len(left), len(hit), redundant, alone, sum(d in good for d, _ in hit), sum(d in toxic for d, _ in hit)]
                shapley[name] += len(hit)
        for (order, step), numbers in own.items():
            out[part, order, step] = (*numbers, shapley[order[step - 1]])
    return out


def test_filter_audit(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(230))
    texts = [None, "", "few words", long, long + " X", long.upper(), "same " * 300, "same " * 300 + "#", long + " 100%", "ABC $ " * 150, "A" * 5000]
    rows = [(i if rng.random() < 0.9 else None, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(80)]
    rows += rows[:5] + [(200, long, "xx")] * 3 + [(2, long, "en"), (2, "few words", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(60)] + [(3, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, mask string, part int").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id int, quality int, toxic int")
    found = filter_audit.filter_interactions(docs, marks).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    expected = audit_brute(rows, labels)
    assert len(found) == len(expected) == 4 * 600
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in names) for r in found} == expected


def test_filter_audit_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_interactions(docs, marks).count() == 0
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    found = filter_audit.filter_interactions(one, marks).collect()
    assert len(found) == 600 and {r.part for r in found} == {""}
    assert all(r.unique_fails == (r.filter_order[r.step - 1] == "A") for r in found)


def test_packed_fields_do_not_carry():
    wide = filter_audit.packed_outcomes(0b10101, True, True)
    many = 2**63 - 1
    fields = np.frombuffer((many * wide).to_bytes(filter_audit.FIELDS * 8, "little"), "<u8")
    assert set(fields.tolist()) == {0, many}


PAGES = "page_id bigint, url string, html string, payload string, shard int"


def page_rows():
    big, other = "<p>" + "x" * 1200, "<p>" + "é" * 500
    rows = [(i, f"http://h/{i}", big if i % 3 == 0 else f"<p>{i}" * (i * 13 % 700)) for i in range(60)]
    rows += [(60, None, None), (61, "", ""), (None, "http://no/id", big), (62, "http://a b/\r\nX-Header: 1/ü", other), (63, "u", other), (64, "u", "s" * 999)]
    rows += [(65, "u", "s" * 999), (66, "u", "t" * 1000), (67, "u", "t" * 1000), (67, "u", "t" * 1000), (68, "u", "long " * 400_000)]
    rows += [(None, "n", "z" * 2000), (None, "m", "z" * 2000), (-5, "http://minus", "\r\n\r\n" + "\0" * 1500)]
    return rows


def expected_records(rows):
    largest = {}
    for page, _, html in rows:
        html = html or ""
        if len(html.encode()) >= 1000:
            largest[html] = max(largest.get(html, -(10**9)), -(10**9) if page is None else page)
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        top = largest.get(html or "")
        again = top is not None and top > -(10**9) and top != page
        out.append((page, url, "revisit" if again else "response", top if again else None, None if again else data, len(data), hashlib.sha1(data).hexdigest()))
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], PAGES)


def key(t):
    return repr(t)


def test_archives_read_back(spark, folder):
    rows = page_rows()
    manifest = warc.write_warc(frame_of(spark, rows).repartition(7), f"{folder}/w", file_bytes=2000)
    found = warc.read_warc(spark, f"{folder}/w").collect()
    got = [(r.page_id, r.url, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload), r.payload_bytes, r.payload_digest) for r in found]
    assert sorted(got, key=key) == sorted(expected_records(rows), key=key)
    said = manifest.collect()
    assert sum(r.n_records for r in said) == len(rows)
    for r in said:
        data = open(f"{folder}/w/{r.name}", "rb").read()
        assert len(data) == r.n_bytes and hashlib.sha256(data).hexdigest() == r.sha256
        # Rolled at the record that reaches the limit.
        parts = [warc.gzip_member(m) for m in warc.members(data)]
        assert sum(map(len, parts[:-1])) < 2000
    assert not os.path.exists(f"{folder}/w/_temporary")


def test_archives_are_the_same_however_rows_are_dealt(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_ROWS", 9)
    rows = page_rows()
    digests = []
    for i, frame in enumerate([frame_of(spark, rows).repartition(3), frame_of(spark, rows[::-1]).repartition(8)]):
        manifest = warc.write_warc(frame, f"{folder}/{i}", file_bytes=3000)
        digests.append(sorted((r.name, r.n_records, r.sha256) for r in manifest.collect()))
    assert digests[0] == digests[1]
    assert len({name.split("-")[0] for name, _, _ in digests[0]}) > 3


def test_archives_commit(spark, folder):
    rows = page_rows()[:20]
    warc.write_warc(frame_of(spark, rows), f"{folder}/w")
    # A second commit finds the final files; what an attempt left behind is never read.
    os.makedirs(f"{folder}/w/_temporary")
    open(f"{folder}/w/_temporary/0000000-00000-lost", "wb").write(b"half a file")
    warc.commit(spark, f"{folder}/w")
    assert warc.read_warc(spark, f"{folder}/w").count() == 20
    name = sorted(os.listdir(f"{folder}/w/archive"))[0] if not sorted(os.listdir(f"{folder}/w/archive"))[0].startswith(".") else sorted(os.listdir(f"{folder}/w/archive"))[-1]
    with open(f"{folder}/w/archive/{name}", "ab") as out:
        out.write(b"x")
    with pytest.raises(ValueError, match="manifest"):
        warc.read_warc(spark, f"{folder}/w")


def test_damaged_record_is_an_error():
    record = warc.record_bytes(1, "http://x", b"payload" * 200, 1400, None, None)
    assert warc.parsed_record(record)[4] == b"payload" * 200
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed_record(record.replace(b"payloadpayload", b"payloadPayload", 1))
    member = warc.gzip_member(record)
    assert list(warc.members(member + member)) == [record, record]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.members(member[:-5]))


def test_archives_of_nothing(spark, folder):
    assert warc.write_warc(frame_of(spark, []), f"{folder}/w").count() == 0
    assert warc.read_warc(spark, f"{folder}/w").count() == 0


VECTORS = "vec_id bigint, embedding array<float>, label int, x string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], VECTORS)


def whitening_brute(rows, wanted=8):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.stack([v for _, v in good])).astype(int) + 100_000
    n, sums = len(x), x.sum(0)
    d = n * x - sums
    c = d / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1][:wanted], basis[:, ::-1][:, :wanted]
    holds = values > 1e-9 * values[0]
    return [i for i, _ in good], (d * d).sum(1), c @ basis[:, holds] / np.sqrt(values[holds]), values[holds] / np.trace(c.T @ c / n)


@pytest.mark.parametrize("dimensions, rank", [(40, 40), (40, 5), (6, 6), (1, 1)])
def test_whitening(spark, dimensions, rank):
    rng = np.random.default_rng(dimensions + rank)
    spread = rng.standard_normal((300, rank)) * np.linspace(3, 1, rank) @ rng.standard_normal((rank, dimensions))
    if rank < dimensions:
        spread = np.round(spread * 4) / 4  # few values: integers after scaling, but the rank grows
        spread = np.tile(np.round(rng.standard_normal((300, rank)) * 8), (1, dimensions // rank))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(spread)]
    rows += [(500, None), (501, [None] * dimensions), (502, [float("nan")] * dimensions), (503, [float("inf")] + [0.0] * (dimensions - 1)), (504, [])]
    rows += rows[:3] + [(None, rows[7][1])]
    found = whitening.whitened(vectors_of(spark, rows).repartition(3)).collect()
    ids, deviation, white, explained = whitening_brute(rows)
    count = white.shape[1]
    assert count == min(8, rank) and len(found) == len(ids) * count
    assert {r.n for r in found} == {len(ids)}
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, r.whitened)
        assert abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
    assert set(by_row) == {(i, int(x)) for i, x in zip(ids, deviation)}
    if rank == dimensions:
        mine = np.array([[by_row[i, int(x)][k + 1] for k in range(count)] for i, x in zip(ids, deviation)])
        sign = np.sign((mine * white).sum(0))
        assert np.abs(mine - white * sign).max() < 1e-8


def test_whitening_needs_several_rounds(spark):
    rng = np.random.default_rng(1)
    basis, _ = np.linalg.qr(rng.standard_normal((80, 80)))
    spread = rng.standard_normal((2000, 80)) * np.concatenate([np.linspace(1.3, 1.2, 10), np.full(70, 1.0)]) @ basis
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(spread)]
    found = whitening.whitened(vectors_of(spark, rows)).collect()
    ids, _, white, _ = whitening_brute(rows)
    mine = np.zeros_like(white)
    for r in found:
        mine[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(mine - white * np.sign((mine * white).sum(0))).max() < 1e-7


def test_whitening_of_little(spark):
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    assert whitening.whitened(vectors_of(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(vectors_of(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    # Another length than most have is left out; entries that only Python's integers hold do not overflow.
    rows = [(i, [float(i), -float(i * i), 3e30 if i == 4 else 1.0]) for i in range(5)] + [(9, [1.0])]
    found = whitening.whitened(vectors_of(spark, rows)).collect()
    assert {r.vec_id for r in found} == set(range(5)) and {r.n for r in found} == {5}
    assert {r.deviation for r in found} == {None}
