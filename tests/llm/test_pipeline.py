"""The pipeline's stages against plain Python, each on its own input, and the whole on a small table."""

import math
from collections import Counter

import corpus_pipeline
from tesserae.llm import pieces, resampling

from . import test_line_runs, test_near_dups
from .brute import odd_rows, table, words

CLASHES = ("n_lines", "n_deleted", "copy", "row", "gone_id", "mix_size", "mix_copies", "kept", "key", "place", "tag", "more", "comp", "set")


def odd_stages(spark, rows, small):
    out, docs = [], table(spark, rows, CLASHES)
    for _, f in corpus_pipeline.STAGES:
        made = f(spark, docs, small)
        out.append(made.collect())
        if len(out) < len(corpus_pipeline.STAGES):
            assert made.columns == docs.columns and [x.dataType for x in made.schema] == [x.dataType for x in docs.schema]
            assert all(r[c] == "clash" for r in out[-1] for c in CLASHES)
        docs = spark.createDataFrame(out[-1], made.schema)
    return out


def test_odd_rows(spark, small):
    """Nulls, empty and long texts, ties, repeated rows and columns with names that the stages use."""
    rows = odd_rows(n=30)
    kept, lines, near, mixed, encoded = odd_stages(spark, rows, small)
    assert Counter((r.doc_id, r.text) for r in kept) <= Counter((i, t) for i, t, _ in rows)
    want = test_line_runs.brute([(r.doc_id, r.text, r.source) for r in kept], 3, 30)
    assert Counter((r.doc_id, r.text) for r in lines) == Counter((i, t) for i, t, n, cut in want if cut == 0 or cut < n)
    want = test_near_dups.brute([(r.doc_id, r.text, r.source) for r in lines], 5, 80)
    assert {(r.doc_id, r.text) for r in near} == {(r.doc_id, r.text) for r, (_, _, _, stays) in zip(lines, want) if stays}
    assert len([r for r in near if r.doc_id is not None]) == len({(r.doc_id, r.text) for r in near if r.doc_id is not None})
    assert {(r.doc_id, r.text) for r in mixed} <= {(r.doc_id, r.text) for r in near}
    assert Counter(r.doc_id for r in encoded) == Counter(r.doc_id for r in mixed)


def test_empty_table(spark, small):
    assert odd_stages(spark, [], small) == [[], [], [], [], []]
    bare = spark.createDataFrame([(1, "a\nb", "x")], "doc_id long, text string, source string")
    assert corpus_pipeline.line_dedup(spark, bare, small).collect() == [(1, "a\nb", "x")]


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, steps = docs.columns, [docs]
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, steps[-1], small)
        out = spark.createDataFrame(out.collect(), out.schema)
        steps.append(out)
    for out in steps[:-1]:
        assert out.columns == columns
    rows = [{r.doc_id: r for r in out.collect()} for out in steps]
    lists = [out.collect() for out in steps]
    # quality: those at or above the k-th key
    got = resampling.resampled(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()
    assert {r.doc_id for r in got if r.kept} == set(rows[1])
    by_key = sorted(got, key=lambda r: -r.key)
    assert all(r.kept for r in by_key[: len(rows[1])]) and len(rows[1]) < len(rows[0])
    assert all(rows[1][i] == rows[0][i] for i in rows[1])
    # line dedup
    want = test_line_runs.brute([(r.doc_id, r.text, r.source) for r in lists[1]], 3, 30)
    want = {i: t for i, t, n, cut in want if cut == 0 or cut < n}
    assert {i: r.text for i, r in rows[2].items()} == want
    assert all(r.n_chars == (len(r.text) if r.text != rows[1][i].text else rows[1][i].n_chars) for i, r in rows[2].items())
    # near copies
    want = test_near_dups.brute([(r.doc_id, r.text, r.source) for r in lists[2]], 5, 80)
    assert {i for i, _, _, kept in want if kept} == set(rows[3]) and all(rows[3][i] == rows[2][i] for i in rows[3])
    # mixing: words of each source near its target
    copies, sizes, taken = Counter(r.doc_id for r in lists[4]), Counter(), Counter()
    for r in lists[3]:
        sizes[r.source] += len(words(r.text))
        taken[r.source] += copies[r.doc_id] * len(words(r.text))
    assert max(copies.values()) <= 3 and all(rows[4][i] == rows[3][i] for i in rows[4])
    order = sorted(sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while over := {s for s in open_ if left / sum(weight[x] for x in open_) * weight[s] > 3 * sizes[s]}:
        target |= {s: 3.0 * sizes[s] for s in over}
        left, open_ = left - sum(3 * sizes[s] for s in over), open_ - over
    target |= {s: left / sum(weight[x] for x in open_) * weight[s] for s in open_}
    for s in order:
        assert abs(taken[s] - target[s]) <= max(len(words(r.text)) for r in lists[3] if r.source == s) / 2 + 1e-6
    # ids
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    assert len(lists[5]) == len(lists[4])
    for r in lists[5]:
        assert r.ids == library.encode(rows[4][r.doc_id].text, add_bos=True, add_eos=True) and r.decoded == library.decode(r.ids)
    assert math.isclose(sum(taken.values()), sum(sizes.values()), rel_tol=0.5)
    whole = corpus_pipeline.run(spark, small)
    assert Counter(r.doc_id for r in whole.select("doc_id").collect()) == copies
