"""What a task of the pipeline's Python stages holds at once, beside its input: an executor has little room left for it."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as in Spark's workers
import pytest

from tesserae.llm import pieces, resampling


@pytest.fixture
def work(spark, monkeypatch):
    """What is given to mapInArrow, and a table."""
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: f)
    return docs


def peak_mb(run, column):
    """Of a task over 4 MB of words of which most are new."""
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(10**9)}" if i % 2 else rnd.choice(["the", "of", "and"]) for i in range(270)) for _ in range(2000)]
    batch = pa.record_batch({"doc_id": pa.array(range(2000)), "source": pa.array(["a"] * 2000), column: pa.array(texts)})
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter([batch])))
        assert rows == 2000
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_encoding(work):
    assert peak_mb(pieces.encoded(work, pieces.Pieces(pieces.default_model()), keep=["source"]), "_text") < 25


def test_quality(work):
    model = resampling.Model(np.zeros(resampling.BUCKETS, np.int64), 1.0)
    assert peak_mb(resampling.scored(work, model), "text") < 25
