"""Quality rules, license scans, media and mixing against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tesserae.llm import licenses, media, mixing, quality_rules

from .brute import CLASHES, odd_rows, table, words


def same(df, want, key=repr):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)


def rules(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    rep = {i + d for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for d in range(5)}
    failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text or ""), len(lines) - len(set(lines)), len(rep), failed


def test_quality_rules(spark):
    rows = odd_rows() + [(2000 + i, "bad", "worst.example") for i in range(60)]
    base = [rules(t) for _, t, _ in rows]
    by = defaultdict(list)
    for (_, _, s), b in zip(rows, base):
        by[s].append(b[5])
    rates = np.array([sum(x) / len(x) for x in by.values()])
    m, v = rates.mean(), rates.var(ddof=1)
    strength = max(1, min(1e6, m * (1 - m) / v - 1))
    ok = {s: (sum(x) + m * strength) / (len(x) + strength) <= 0.5 for s, x in by.items()}
    assert not ok["worst.example"] and any(ok.values())
    want = [(i, *b, not b[5] and ok[s]) for (i, _, s), b in zip(rows, base)]
    out = quality_rules.judged(table(spark, rows, CLASHES))
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), want)
    assert quality_rules.judged(table(spark, [])).count() == 0
    alone = quality_rules.judged(table(spark, [(1, "a b", "x")])).collect()
    assert len(alone) == 1 and not alone[0]["kept"]


def licensed(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    cut = lambda t: [w for w in __import__("re").split(licenses.BREAKS, t) if w]
    w = cut(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    own, met, best = {x for _, x in places}, set(), 0.0
    for line in text.split("\n"):
        s = set(cut(line))
        for name, t in licenses.TEMPLATES.items():
            t = set(licenses.tokens(t))
            if len(s & t) >= licenses.needed(len(t), licenses.THRESHOLD):
                met.add(name)
                best = max(best, len(s & t) / len(t))
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | met)), 1.0 if at else best


def test_licenses(spark):
    rnd, rows = random.Random(2), odd_rows()
    for i in range(120):
        t = rnd.choice(list(licenses.TEMPLATES.values())).split()
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice(["other", "CC BY", "É", "the"])
        rows.append((3000 + i, rnd.choice(["pre ", "pre\n", ""]) + " ".join(t) + rnd.choice(["", " CC-BY cc by", ".\nAll Rights reserved!"]), "a"))
    rows.append(rows[-1])
    same(licenses.scanned(table(spark, rows, CLASHES)), [(i, *licensed(t)) for i, t, _ in rows])
    assert licenses.scanned(table(spark, [])).count() == 0


def test_wrapped_licenses(spark):
    """Notices over several lines are found, whatever stands before and after; words of two notices are not put together."""
    import textwrap

    rows, want = [], {}
    for i, (name, t) in enumerate(licenses.TEMPLATES.items()):
        for width in (20, 40, 72):
            lines = textwrap.wrap(f"some words stand before it {t} and some after", width)
            rows.append((len(rows), "\n".join(f" * {x}" for x in lines), "a"))
            want[len(rows) - 1] = name
    rows.append((900, "etwas mit\nLicensed under the Apache License, Version 2.0", "a"))
    got = {r.doc_id: r.labels.split(",") for r in licenses.scanned(table(spark, rows)).collect()}
    assert all(name in got[i] for i, name in want.items())
    assert got[900] == ["apache-2.0"]


def sound_of(payload):
    """The features of a mu-law payload, sample by sample."""
    table = [int(x) for x in media.mulaw_table()]
    sound = [table[b] for b in payload]
    wide = [x for i, s in enumerate(sound) for x in (s, (s + sound[i + 1]) >> 1 if i + 1 < len(sound) else s)]
    pack = lambda xs: b"".join(x.to_bytes(2, "little", signed=True) for x in xs)
    turns = sum((a < 0) != (b < 0) for a, b in zip(wide, wide[1:]))
    out = [f"pcm:rate=16000,samples={len(wide)},peak={max(map(abs, wide))},power={sum(x * x for x in wide) // len(wide)},turns={turns},crc={zlib.crc32(pack(wide))}"]
    values = sorted({int(x) for x in media.alaw_table()})
    near = [min(values, key=lambda v: (abs(v - s), v)) for s in sound]
    far = lambda again: sum(abs(a - b) for a, b in zip(sound, again)) // len(sound)
    out.append(f"alaw:error={far(near)},crc={zlib.crc32(pack(near))}")
    steps, again = media.STEPS.tolist(), []
    for at in range(0, len(sound), 121):
        part = sound[at : at + 121]
        part += [part[-1]] * (121 - len(part))
        value = part[0]
        index = next((i for i, s in enumerate(steps) if s >= abs(part[1] - value)), 88)
        again.append(value)
        for want in part[1:]:
            step, off = steps[index], want - value
            left, code, size = abs(off), 0, step >> 3
            for bit in (4, 2, 1):
                if left >= step:
                    code, left, size = code | bit, left - step, size + step
                step >>= 1
            value = max(-32768, min(32767, value - size if off < 0 else value + size))
            index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code]))
            again.append(value)
    out.append(f"adpcm:error={far(again)},crc={zlib.crc32(pack(again))}")
    return ";".join(out)


def test_media(spark):
    rows = odd_rows()
    files = media.rendered(media.stored(table(spark, rows, CLASHES)), ("alaw", "adpcm", "pcm"))
    got = media.described(files).collect()
    assert len(got) == len(rows)
    for r, (i, t, _) in zip(got, rows):
        raw = (t or "").encode()
        padded = raw + bytes((-len(raw)) % 64 if raw else 64)
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (i, len(raw), len(padded))
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.tail_crc32 == zlib.crc32(padded[-64:])
        stored = media.wav(padded)
        assert r.media_bytes == len(stored) and r.media_sha256 == hashlib.sha256(stored).hexdigest()
        assert r.feature == sound_of(padded)
    assert media.described(media.rendered(media.stored(table(spark, [])), ("alaw", "adpcm", "pcm"))).count() == 0
    for tag in (media.MULAW, media.ALAW, media.ADPCM):
        out = media.rendered(media.stored(table(spark, rows[:12]), tag)).collect()
        for r in out:
            kind, rate, samples = media.unwav(bytes(r.media))
            pcm_kind, pcm_rate, pcm = media.unwav(bytes(r.pcm))
            assert kind == tag and (pcm_kind, pcm_rate) == (media.PCM, 2 * rate)
            assert np.array_equal(np.frombuffer(pcm, "<i2")[::2], media.expanded(tag, samples))


def test_media_in_one_worker(spark, small):
    """The query gives what its three steps give one by one, and its media don't go through the JVM between them."""
    df = media.op5_media(spark, small)
    steps = media.described(media.rendered(media.stored(spark.read.parquet(f"{small}/documents.parquet")), tuple(media.RENDITIONS)))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, steps.collect()))
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_bad_media(spark):
    """No sound, no row less: broken files give nulls, also beside good ones, and other columns stay as they are."""
    good = media.wav(b"abc")
    files = [None, b"", b"RIFF", good[:20], good[:-1], media.wav(b"", media.ADPCM), media.wav(b"x" * 100, 99), media.wav(b""), good, media.wav(b"q" * 100, media.ADPCM)]
    rows = spark.createDataFrame([(i, 0, f, "clash") for i, f in enumerate(files)], "doc_id long, n_bytes long, media binary, pcm string")
    out = media.rendered(rows.withColumnRenamed("pcm", "a b"), ("alaw", "adpcm", "pcm"))
    assert [r["a b"] for r in out.collect()] == ["clash"] * len(files)
    pcm = {r.doc_id: r.pcm for r in media.rendered(rows).collect()}
    assert [i for i, x in pcm.items() if x is None] == [0, 1, 2, 3, 4, 6]
    got = {r.doc_id: r for r in media.described(out).collect()}
    assert [i for i, r in got.items() if r.feature is None] == [0, 1, 2, 3, 4, 6]
    assert got[7].payload_bytes == 0 and got[8].payload_bytes == 3 and got[9].payload_bytes == 100 and got[1].media_bytes == 0


def test_sound():
    # reference values of the companding laws
    u, a = media.mulaw_table(), media.alaw_table()
    assert u[0xFF] == 0 and u[0x7F] == 0 and u[0] == -32124 and u[0x80] == 32124
    assert a[0xD5] == 8 and a[0x55] == -8 and a[0xAA] == 32256 and a[0x2A] == -32256
    assert len(set(u.tolist())) == 255 and len(set(a.tolist())) == 256
    rnd = np.random.default_rng(1)
    blocks = rnd.integers(0, 256, (40, 64), dtype=np.uint8)
    for b, got in zip(blocks, media.adpcm(blocks)):
        value = int.from_bytes(b[:2].tobytes(), "little", signed=True)
        index, want = min(int(b[2]), 88), [value]
        for byte in b[4:].tolist():
            for code in (byte & 15, byte >> 4):
                step = int(media.STEPS[index])
                d = step >> 3
                d += step if code & 4 else 0
                d += step >> 1 if code & 2 else 0
                d += step >> 2 if code & 1 else 0
                value = max(-32768, min(32767, value - d if code & 8 else value + d))
                index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
                want.append(value)
        assert got.tolist() == want


@pytest.mark.parametrize("rows", [odd_rows(), odd_rows(8, 400), [(1, "a b c", "x")], []])
def test_mixing(spark, rows):
    got = mixing.mixed(table(spark, rows, CLASHES)).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(repr((i, t)) for i, t, _ in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = float(sum(sizes.values())), {}, set(order)
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left, open_ = left - sum(3 * sizes[s] for s in over), open_ - over
    target |= {s: level * weight[s] for s in open_}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.mix_size == len(words(r.text)) and r.mix_source_size == sizes[r.source]
        assert math.isclose(r.mix_target, target[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r.mix_copies <= 3
        taken[r.source] += r.mix_copies * r.mix_size
        largest[r.source] = max(largest[r.source], r.mix_size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mixed(table(spark, rows, CLASHES).repartition(3)).collect()
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in again)
