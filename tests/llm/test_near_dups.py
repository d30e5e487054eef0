"""Near-dedup against plain Python over all pairs."""

import random
import re

import numpy as np
import pytest

from tesserae.llm import near_dups
from tesserae.llm.near_dups import CHUNKS, FARTHEST, SYMBOLS, grouped, lookup_keys

from .brute import CLASHES, odd_rows, table


def brute(rows, k, percent):
    def shingles(t):
        w = [x for x in re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))]
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b) and b:
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return [(r[0], len(s), None if r[0] is None else low[root(i)], r[0] is None or r[0] == low[root(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def near_rows(seed, groups, loose):
    """Groups of copies of a text with more and more words changed; some reach each other only through others."""
    rnd, rows, i = random.Random(seed), [], 0
    for g in range(groups):
        base = [f"g{g}w{rnd.randrange(500)}" for _ in range(rnd.choice([5, 40, 150]))]
        for _ in range(rnd.choice([1, 2, 12, loose])):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 12))):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
            t = t[: len(t) - rnd.randint(0, len(t) // 12)]
            rows.append((i, " ".join(t).title() if rnd.random() < 0.2 else " ".join(t), "a"))
            i += 1
            if rnd.random() < 0.2:
                base = t
    rnd.shuffle(rows)
    return rows


def test_pigeonhole():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 16, (500, SYMBOLS), dtype=np.uint16)
    for far in (0, 1, FARTHEST):
        b = a.copy()
        for row in b:
            at = rnd.permutation(SYMBOLS)[:far]
            row[at] ^= rnd.integers(1, 1 << 16, far, dtype=np.uint16)
        met = (lookup_keys(a) == lookup_keys(b)).any(axis=1)
        assert met.all()
    # one more error may put two into every chunk
    b = a.copy().reshape(500, CHUNKS, -1)
    b[:, :, :2] ^= 1
    assert not (lookup_keys(a) == lookup_keys(b.reshape(500, -1))).any()


@pytest.mark.parametrize("k, percent, rows", [(3, 85, near_rows(1, 25, 60)), (5, 80, near_rows(2, 20, 40)), (3, 85, odd_rows())])
def test_groups(spark, k, percent, rows):
    got = grouped(table(spark, rows, CLASHES), k, percent).collect()
    want = brute(rows, k, percent)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty(spark):
    assert grouped(table(spark, [])).count() == 0
    assert [tuple(r) for r in grouped(table(spark, [(4, None, None), (None, None, "x")])).orderBy("doc_id").collect()] == [(None, 0, None, True), (4, 0, 4, True)]


def test_repeated_rows_of_loose_groups(spark):
    """Rows that stand three times lengthen no list of shingles, so that the prefix join still meets all pairs."""
    rows = near_rows(2, 20, 40)
    got = grouped(table(spark, [r for r in rows for _ in range(3)]), 3, 85).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, 3 * brute(rows, 3, 85)))


@pytest.mark.parametrize("copies", [150, 450])
def test_few_edges(spark, copies, monkeypatch):
    """A group of loose copies is put together by a few pairs for each copy, not by all of its links."""
    rnd, rows = random.Random(copies), []
    base = [f"w{rnd.randrange(400)}" for _ in range(120)]
    for i in range(copies):
        t = list(base)
        for _ in range(rnd.randint(0, 7)):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t), "a"))
    edges, inner = [], near_dups.components

    def counted(pairs):
        edges.append(pairs.count())
        return inner(pairs)

    monkeypatch.setattr(near_dups, "components", counted)
    got = grouped(table(spark, rows), 3, 85).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, 3, 85)))
    assert sum(edges) <= 3 * copies
