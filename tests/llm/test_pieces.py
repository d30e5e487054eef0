"""Ids and decoded texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest

from tesserae.llm.pieces import Encoder, Pieces, default_model, digests, encoded


@pytest.fixture(scope="module")
def pieces():
    return Pieces(default_model())


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def odd_texts():
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "é", "▁", "<s>", "th", "e", "in", "0", "\t", "日", "🙂", "\x00", "ing", " t", "aa", "==", "</s>", "<0x0A>", " ", "　"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return ["", " ", "   ", "▁", "a" * 3000, "ab" * 1500, "=-" * 900, " " * 500, *made]


def test_same_ids_and_text_as_library(pieces, library):
    texts = odd_texts()
    for text, raw in zip(texts, Encoder(pieces)(texts)):
        ids = np.frombuffer(raw, "<u4")
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want, repr(text)
        assert pieces.decode(ids).decode() == library.decode(want), repr(text)


def test_rows(spark, pieces, library, small):
    texts = [None, "", "same", "same", "x " * 30000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encoded(df, pieces).collect()
    assert len(got) == 6 and got[0]["ids"] == got[1]["ids"] == [1, 2] and got[0]["decoded"] == ""
    for r, (_, t, _) in zip(got, rows):
        assert r["ids"] == library.encode(t or "", add_bos=True, add_eos=True)
    assert encoded(df.limit(0), pieces).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: library.encode(r.text or "", add_bos=True, add_eos=True) for r in docs.collect()}
    for r in digests(docs, pieces).collect():
        ids = want[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
