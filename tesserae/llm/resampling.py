"""Quality classification by importance resampling.

Texts become hashed n-grams: words and marks in lower case, alone and in pairs; a pair of equal words is one feature of
its own. Two generative models are bags of these features: one of the target (labelled rows of good quality and without
toxic content), one of all documents. A document's log weight is the sum of log(p_target / p_raw) over its features.
Adding Gumbel noise and taking the top k samples k documents without replacement in proportion to their weights. k is
the share of good rows among the labelled ones, with a margin, of all documents; the others are rejected.

The target comes from at most MOST_LABELLED labelled rows, taken by a hash of their ids; everything else, the raw model,
weights and the k-th key, covers all documents. The k-th key is found with histograms of BINS bins, refined until a bin
is small enough to sort: no task and not the driver sees all keys. Weights are summed as integers, so that they don't
depend on the order; noise comes from a hash of the id.

Null or empty texts have weight 0. Rows without an id share their noise. Repeated rows get the same key; documents that
tie with the k-th stay. Labels of one id are put together: good if all are, toxic if any is. Without labelled rows of
good quality nothing is rejected. An empty table gives no rows. A very long text is counted whole; a batch holds one of
them at a time. Columns besides doc_id and text are not looked at, whatever their names; selected() returns them unchanged.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import documents, labels, slices, written

BUCKETS, SCALE = 1 << 14, 1 << 20
MOST_LABELLED, MARGIN, SEED = 50_000, 0.01, 11
BINS, SORTABLE = 4096, 10_000
#: How many words a worker remembers, and of how many characters at most.
REMEMBERED, LONGEST = 100_000, 64
#: Bytes of text whose features are counted in one go: lists and arrays take many times as much.
PART = 256 << 10
CUT = re.compile(r"\w+|[^\w\s]+")


class Codes(dict):
    """32-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little")
        if len(word) <= LONGEST:
            if len(self) > REMEMBERED:
                self.clear()
            self[word] = h
        return h


def features(texts: list[str | None], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, and the texts they belong to."""
    split = [CUT.findall((t or "").lower()) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in split])
    code = np.fromiter(map(codes.__getitem__, chain.from_iterable(split)), np.int64, len(owner))
    left, right = code[:-1], code[1:]
    inside = owner[1:] == owner[:-1]
    pair = np.where(left == right, 0, 1 + ((left * 0x9E3779B1 + right * 0x85EBCA6B) >> 7) % (BUCKETS - 1))
    return np.concatenate([1 + code % (BUCKETS - 1), pair[inside]]), np.concatenate([owner, owner[1:][inside]])


def noise(ids: list, seed: int) -> np.ndarray:
    raw = b"".join(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest() for i in ids)
    u = (np.frombuffer(raw, "<u8").astype(np.float64) + 0.5) / 2.0**64
    return -np.log(-np.log(np.minimum(u, 1 - 2.0**-53)))


@dataclass
class Model:
    """ratios: log(p_target / p_raw) of each bucket, times SCALE; share: of good rows among the labelled, with the margin."""

    ratios: np.ndarray
    share: float

    def weights(self, texts: list[str | None], codes: Codes) -> np.ndarray:
        bucket, owner = features(texts, codes)
        # whole numbers, and so few that every sum is exact
        return np.bincount(owner, weights=self.ratios[bucket], minlength=len(texts)) / SCALE


def labelled_sample(labelled: DataFrame, most: int) -> DataFrame:
    """label_id, good and clean of at most `most` labelled ids."""
    one = labelled.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    one = one.filter("quality is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return one.select(F.col("doc_id").alias("label_id"), (F.col("quality") > 0).alias("good"), (F.coalesce("toxic", F.lit(0)) == 0).alias("clean"))


def fitted(docs: DataFrame, labelled: DataFrame, most: int = MOST_LABELLED, margin: float = MARGIN) -> Model:
    sample = written(labelled_sample(labelled, most), "labels")
    n, good = sample.agg(F.count("*"), F.coalesce(F.sum(F.col("good").cast("int")), F.lit(0))).first()
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left")  # at most `most` rows
    marked = marked.select("text", F.coalesce(F.col("good") & F.col("clean"), F.lit(False)).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, raw, target = Codes(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in slices(batches, "text", PART):
            bucket, owner = features(b.column("text").to_pylist(), codes)
            mine = b.column("target").to_numpy(zero_copy_only=False).astype(bool)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[mine[owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], ["bucket", "raw", "target"])

    counts = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # BUCKETS rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not good or not target.sum():
        return Model(np.zeros(BUCKETS, np.int64), 1.0)
    ratio = np.log((target + 1) / (target + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())
    p = good / n
    return Model(np.round(ratio * SCALE).astype(np.int64), min(1.0, p + margin + 2 * math.sqrt(p * (1 - p) / n)))


def scored(docs: DataFrame, model: Model, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight and key (with noise)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b in slices(batches, "text", PART):
            weight = model.weights(b.column("text").to_pylist(), codes)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(weight), pa.array(weight + noise(b.column("doc_id").to_pylist(), seed))], ["doc_id", "log_weight", "key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, log_weight double, key double")


def kth_largest(keys: DataFrame, share: float) -> float:
    """The ceil(share * n)-th largest key; -inf if all are wanted."""
    n, low, high = keys.agg(F.count("*"), F.min("key"), F.max("key")).first()
    k = math.ceil(share * n)
    if k >= n:
        return -math.inf
    if k == 0:
        return math.inf
    while True:
        width = (high - low) / BINS
        inside = keys.filter(F.col("key").between(low, high))
        if width <= 0 or low + width == low:
            return low
        at = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1))
        bins = sorted(((r["at"], r["n"], r["low"], r["high"]) for r in inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()), reverse=True)
        for _, many, low, high in bins:  # the bin with the k-th
            if many >= k:
                break
            k -= many
        if many <= SORTABLE:
            return keys.filter(F.col("key").between(low, high)).orderBy(F.desc("key")).limit(k).agg(F.min("key")).first()[0]


def resampled(docs: DataFrame, labelled: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """doc_id, log_weight, key and kept, one row for each of docs."""
    model = fitted(docs, labelled, **options)
    keys = written(scored(docs, model, seed), "keys")
    return keys.withColumn("kept", F.col("key") >= kth_largest(keys, model.share))


def selected(docs: DataFrame, labelled: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of docs that are kept, unchanged. Texts are gone through once more rather than shuffled."""
    model = fitted(docs, labelled, **options)
    least = kth_largest(written(scored(docs, model, seed), "keys"), model.share)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for b in slices(batches, "text", PART):
            key = model.weights(b.column("text").to_pylist(), codes) + noise(b.column("doc_id").to_pylist(), seed)
            yield b.filter(pa.array(key >= least))

    return docs.mapInArrow(work, docs.schema)


def op7_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), labels(spark, sf_dir))
