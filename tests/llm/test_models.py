"""Importance resampling and personal data: against plain Python, by gradients and by held-out accuracy."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import personal, resampling
from tesserae.llm.text import documents, labels

from .brute import CLASHES, table


def test_kth_largest(spark):
    rnd = random.Random(1)
    for values in ([rnd.gauss(0, 1) for _ in range(3000)], [1.0] * 50 + [2.0] * 50, [0.5], [-1e9, 0.0, 1e9] + [rnd.random() for _ in range(200)]):
        keys = spark.createDataFrame([(float(v),) for v in values], "key double")
        for share in (0.1, 0.5, 0.87, 1.0):
            k = math.ceil(share * len(values))
            got = resampling.kth_largest(keys, share)
            assert sum(v >= got for v in values) >= k and sum(v > got for v in values) <= k
            if share < 1 and k < len(values):
                assert got == sorted(values, reverse=True)[k - 1]


def corpus():
    rnd = random.Random(4)
    good = [(i, " ".join(rnd.choice(["the", "of", "house", "tree", "walks", "slowly", "green"]) for _ in range(rnd.randint(20, 90))), "a") for i in range(300)]
    bad = [(1000 + i, " ".join(rnd.choice(["BUY!!", "cheap!!", "$$$", "now", "now"]) for _ in range(rnd.randint(20, 90))), "a") for i in range(40)]
    labels = [(i, 1, 0) for i in range(0, 300, 2)] + [(1000 + i, 0, 0) for i in range(0, 40, 2)] + [(7, None, None), (None, 1, 0), (4, 1, 1)]
    return good, bad, labels


def test_resampling(spark):
    good, bad, labels = corpus()
    rows = good + bad + [(None, None, None), (5000, "", "b"), good[3], (6000, "the of " * 20000, "a")]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = resampling.resampled(table(spark, rows, CLASHES), marks).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _, _ in good} <= kept and len({i for i, _, _ in bad} - kept) >= 15  # the margin is wide with so few labels
    # weights from plain counts
    def grams(t):
        w = re.findall(r"\w+|[^\w\s]+", (t or "").lower())
        code = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=4).digest(), "little") for x in w]
        pair = [0 if a == b else 1 + ((a * 0x9E3779B1 + b * 0x85EBCA6B) % 2**64 - (2**64 if (a * 0x9E3779B1 + b * 0x85EBCA6B) % 2**64 >= 2**63 else 0) >> 7) % (resampling.BUCKETS - 1) for a, b in zip(code, code[1:])]
        return [1 + c % (resampling.BUCKETS - 1) for c in code] + pair

    clean = {i for i, q, x in labels if i is not None and q == 1 and not x} - {4}
    raw, target = np.ones(resampling.BUCKETS), np.ones(resampling.BUCKETS)
    for i, t, _ in rows:
        for g in grams(t):
            raw[g] += 1
            target[g] += i in clean
    ratio = np.round((np.log(target / target.sum()) - np.log(raw / raw.sum())) * resampling.SCALE)
    weights = {i: sum(int(ratio[g]) for g in grams(t)) / resampling.SCALE for i, t, _ in rows}
    assert all(r.log_weight == weights[r.doc_id] for r in got)
    stay = resampling.selected(table(spark, rows, CLASHES), marks).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in stay))) == sorted(repr((i, t)) for i, t, _ in rows if i in kept)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in resampling.resampled(table(spark, rows), none).collect())
    assert resampling.resampled(table(spark, []), marks).count() == 0


def test_verdicts_on_held_out_labels(spark):
    folder, half = "/root/testdata/sf0.1", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(2))
    marks = labels(spark, folder)
    got = resampling.resampled(documents(spark, folder), marks.filter(half == 0)).select("doc_id", "kept")
    held = marks.filter(half == 1).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    kept = {r.quality: r.kept for r in got.join(held, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] >= 0.99 and kept[0] <= 0.2


def test_gradients():
    tagger, rnd = personal.Tagger(1), np.random.default_rng(1)
    x, _ = personal.training_set(3, 9)
    x, y = x[:, :7], rnd.integers(0, len(personal.TAGS), (3, 7))
    _, g = tagger.gradients(x, y)
    for name, value in tagger.p.items():
        at = [(x[0, 2], 3), (x[1, 4], 25), (x[2, 1], 50)] if name.startswith("in") else [tuple(rnd.integers(0, s) for s in value.shape) for _ in range(4)]
        for i in at:
            old = value[i]
            value[i] = old + 1e-5
            up = tagger.gradients(x, y)[0]
            value[i] = old - 1e-5
            down = tagger.gradients(x, y)[0]
            value[i] = old
            assert abs((up - down) / 2e-5 - g[name][i]) < 1e-6


def test_viterbi():
    import itertools

    tagger = personal.Tagger(2)
    tagger.p["trans"] = np.random.default_rng(3).normal(0, 1, tagger.p["trans"].shape)
    x = personal.training_set(2, 3)[0][:, :4]
    e = tagger.emissions(x)[0]
    for row, got in zip(e, tagger.viterbi(x)):
        best = max(itertools.product(range(len(personal.TAGS)), repeat=4), key=lambda p: sum(row[t, k] for t, k in enumerate(p)) + sum(tagger.p["trans"][a, b] for a, b in zip(p, p[1:])))
        assert tuple(got) == best


@pytest.fixture(scope="module")
def tagger():
    return personal.trained()


def test_held_out(tagger):
    x, y = personal.training_set(300, 777)
    got = tagger.viterbi(x)
    assert (got == y).mean() > 0.96
    assert 2 * ((got == y) & (y > 0)).sum() / ((got > 0).sum() + (y > 0).sum()) > 0.92
    plain = ["Licensed under CC BY-NC 4.0. version 3. in 2024 " * 5, "call 5 or 12 of 300 at 10:30, 2024-05-06", "x" * 5000, "7" * 3000]
    assert not any(personal.model_spans(tagger, plain[:3]))
    long = "word " * 3000 + 'token = "' + "9f8e7d6c5b4a39281706f5e4d3c2b1a0" + '" end ' + "word " * 500
    spans = personal.model_spans(tagger, [long])[0]
    assert len(spans) == 1 and spans[0][0] == "secret" and "7d6c5b4a3928" in long[spans[0][1] : spans[0][2]]


def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(2 * x - 9 * (x > 4) for x in d[-2::-2])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def personal_rows():
    rnd = random.Random(6)
    parts = ["a@b.c", "@d.e", "x.y+z@mail.example.com", "a@b", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8.9", "0001.2.3.4", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (482) 555-6762", "+49", "+1.2.3.4.5.6.7.8", " ", ".", "-", "word ", "é", "日本 ", "\n", "12", "@", "+"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))), "a") for i in range(400)]
    return rows + [(None, None, None), (500, "", "a"), (501, "a" * 60000 + "@b.c", "a"), (502, "1" * 60000, "a"), (503, "1.1." * 15000, "a"), rows[3], (504, "@a.b" * 10000, "a")]


def test_personal(spark, tagger):
    rows = personal_rows()
    got = personal.scanned(table(spark, rows, CLASHES), tagger).collect()
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(got, rows):
        base = [tuple(s) for s in r.base]
        assert r.doc_id == i and base == brute_base(t or ""), repr(t[:100])
        spans = [tuple(s) for s in r.spans]
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (personal.TAGS.index(s[0]), s[1:]))
        more = [s for s in spans if s not in base]
        assert not any(a < y and x < b for _, a, b in more for _, x, y in base)
    assert personal.scanned(table(spark, []), tagger).count() == 0
