"""Substring dedup against plain Python, and the FM-index against direct search."""

import numpy as np
import pytest

from tesserae.llm.fm_index import FMIndex, RangeMinimum
from tesserae.llm.substrings import removed

from .brute import CLASHES, odd_rows, table, words


@pytest.mark.parametrize("n, sigma", [(2, 2), (60, 3), (1500, 6), (2500, 700)])
def test_index(n, sigma):
    rnd = np.random.default_rng(n)
    text = np.append(rnd.integers(1, sigma, n - 1), 0)
    index = FMIndex(text, sigma, 13)
    for length in {1, 2, 5, 13} & set(range(n)):
        starts = np.arange(n - length)
        low, high = index.matching(text, starts, length)
        for i in starts[:300]:
            want = [j for j in range(n - length) if (text[j : j + length] == text[i : i + length]).all()]
            assert sorted(index.order[low[i] : high[i]]) == want
        values = rnd.integers(0, 99, n)
        assert (RangeMinimum(values)(low, high) == [values[a:b].min() for a, b in zip(low, high)]).all()
    query = np.append(rnd.integers(0, sigma, 200), text[: n // 2])
    ends = np.arange(len(query) + 1)
    got = index.statistics(query, ends, np.minimum(ends, 13))
    held = {tuple(text[i : i + k].tolist()) for k in range(1, 14) for i in range(n - k + 1)}
    for end in range(len(query) + 1):
        want = 0
        while want < 13 and end - want - 1 >= 0 and 0 not in query[end - want - 1 : end] and tuple(query[end - want - 1 : end].tolist()) in held:
            want += 1
        assert got[end] == want


def brute(rows, window):
    first, out = {}, []
    place = lambda i: float("inf") if i is None else i
    for i, t, _ in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, float("inf")), place(i))
    for i, t, _ in rows:
        w = words(t)
        gone = {k + d for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < place(i) for d in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("hot", [4096, 3])
def test_removed(spark, hot):
    rows = odd_rows() + odd_rows(9, 80, vocabulary=6)[8:]
    got = removed(table(spark, rows, CLASHES), hot=hot).select("doc_id", "n_words", "n_removed", "kept").collect()
    want = brute(rows, 13)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(n for _, _, n, _ in want)


def test_empty(spark):
    assert removed(table(spark, [])).count() == 0
    assert [tuple(r)[1:3] for r in removed(table(spark, [(None, None, None)])).collect()] == [(0, 0)]
