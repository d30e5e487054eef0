"""Line dedup against plain Python."""

import random

import pytest

from tesserae.llm.line_runs import deduplicated

from .brute import CLASHES, odd_rows, table, words


def brute(rows, min_lines, min_words):
    docs = sorted({(float("inf") if i is None else i, t or "", t is None) for i, t, _ in rows})
    seen1, seen, gone = {}, {}, {}
    for place, text, _ in docs:
        full = [(no, x) for no, x in enumerate(text.split("\n")) if words(x)]
        out = set()
        for k, (_, x) in enumerate(full):
            if seen1.setdefault(x, (place, text, k)) != (place, text, k) and len(words(x)) >= min_words:
                out.add(k)
            run = tuple(y for _, y in full[k : k + min_lines])
            if len(run) == min_lines and seen.setdefault(run, (place, text, k)) != (place, text, k):
                out |= set(range(k, k + min_lines))
        gone[place, text] = (len(full), {full[k][0] for k in out})
    result = []
    for i, t, _ in rows:
        n, cut = gone[float("inf") if i is None else i, t or ""]
        kept = t if not cut else "\n".join(x for no, x in enumerate(t.split("\n")) if no not in cut)
        result.append((i, kept, n, len(cut)))
    return result


def line_rows(seed, n):
    rnd = random.Random(seed)
    vocab = [" ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.choice([1, 3, 8, 40]))) for _ in range(12)] + ["", "  "]
    rows = [(i, "\n".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 25))), "a") for i in range(n)]
    return rows + [(n, rows[3][1], "a"), (n + 1, rows[3][1], "b"), rows[4], rows[4], (n + 2, "\n".join([vocab[0]] * 300), "c"), (None, rows[5][1], "a")]


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_runs(spark, min_lines):
    rows = line_rows(4, 40) + [(i and i + 5000, t, s) for i, t, s in odd_rows()[1:4] + odd_rows()[5:]]
    got = deduplicated(table(spark, rows, CLASHES), min_lines, 30).select("doc_id", "text", "n_lines", "n_deleted").collect()
    want = brute(rows, min_lines, 30)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(r[3] for r in want) > 50


def test_pairs(spark):
    """Two repeated lines that hold 51 words together are a run if asked for; 50 words are not, nor lines that repeat apart."""
    line = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d = line("a", 29), line("b", 25), line("c", 25), line("d", 25)
    rows = [(1, f"x\n{a}\n{b}\ny", "a"), (2, f"{a}\n{b}\nz", "a"), (3, f"{c}\n{d}\nu", "a"), (4, f"{c}\n{d}\nv", "a"), (5, f"{b}\nw\n{a}", "a")]
    kept = lambda **more: {r.doc_id: (r.text, r.n_deleted) for r in deduplicated(table(spark, rows), 3, 30, **more).collect()}
    whole = {i: (t, 0) for i, t, _ in rows}
    assert kept() == whole
    assert kept(pair_words=51) == whole | {2: ("z", 2)}


def test_empty(spark):
    assert deduplicated(table(spark, [])).count() == 0
    assert [tuple(r)[1] for r in deduplicated(table(spark, [(None, None, None)])).collect()] == [None]
