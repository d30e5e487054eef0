"""Substring dedup: runs of words that an earlier document holds, found by the matching statistics of FM-indexes.

Windows are dealt to shards by content, so that each shard's index holds every occurrence of the windows it answers for.
A window's anchor is the leftmost least hash among its runs of ANCHOR words; consecutive windows with one anchor form a
segment. Segments whose anchor occurs in a single document are dropped, as their windows can't repeat. The others go to
the shard of their anchor. There the distinct segments are laid out as one sequence of word numbers and a compressed
FM-index is built over it. The segments are then streamed through backward search: at each of their words the matching
statistic is the longest run that ends there and that the index holds for an earlier document, by the least document
over the suffix range. Statistics of `window` words and more give the intervals, which are joined back to the documents.
A segment that stands in an earlier document as a whole is one interval.

Which anchors repeat is counted from what each part of the table has summed up: rows whose anchor two documents of the
part hold are known to repeat, and one row speaks for all of them. So a hot anchor sends a few rows to its counter. If an
anchor has more than HOT segments, its shard would be an unbounded group: the distinct ones are cut into single windows,
and these are dealt to shards by a hash of the whole window; the answers are joined back to the segments, where Spark
splits skewed keys.

Words are compared as they are, never as hashes alone. Null or empty texts have no words. Documents are ordered by
doc_id; rows without one come after all others and none of them before another. Rows with equal ids are neither before
the other. Texts shorter than a window lose nothing. A very long text is cut like any other: its segments go to many
shards, and a batch holds one such text at a time. An empty table gives no rows. Columns besides doc_id and text are not
looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fm_index import FMIndex, RangeMinimum
from .text import LAST, NAME, documents, dropped, lookup, named, slices, written

WINDOW, ANCHOR = 13, 5
#: Words of one shard's index, about; and the segments of about 16 words that make up so many.
SHARD_WORDS = 1 << 19
HOT = SHARD_WORDS // 16
#: Text of the parts whose anchors are summed up at once.
PART_BYTES = 8 << 20
NAMES = "place long, tag long, more long"


def hashes_of(words: Iterable[bytes], n: int) -> np.ndarray:
    """64-bit hashes of n words. Nothing is remembered, so that no vocabulary grows in a worker."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def anchors(hashes: np.ndarray, ends: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a batch: first word of the first window, number of windows and anchor hash. ends: of the documents' words."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        runs = hashes[: n - run + 1].copy()
        for k in range(1, run):
            runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - run + 1 + k]
        runs = (runs ^ (runs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        runs ^= runs >> np.uint64(32)
    count = n - window + 1
    least, place = runs[:count].copy(), np.zeros(count, np.int64)
    for k in range(1, window - run + 1):
        better = runs[k : k + count] < least
        least = np.where(better, runs[k : k + count], least)
        place = np.where(better, k, place)
    at = np.arange(count)
    place += at
    valid = np.ones(count, bool)
    for k in range(1, window):  # windows that reach into the next document
        cut = ends - k
        valid[cut[(cut >= 0) & (cut < count)]] = False
    first = valid & np.append(True, (place[1:] != place[:-1]) | ~valid[:-1])
    starts = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    sizes = np.bincount(group[valid], minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    return starts, sizes, least[starts].view(np.int64)


def batch_words(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray]:
    split = [(t or "").encode().split() for t in texts]  # bytes split at ASCII white space only
    return split, np.cumsum([len(w) for w in split])


def find_anchors(docs: DataFrame, window: int, run: int) -> DataFrame:
    """The segments, with `known` if two documents of the table's part hold the anchor, and a notice for each such anchor.

    deal: what rows are dealt by, the anchor for the notices and the segments that are not known. low and high: the first
    and the last place that a row speaks for.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PART_BYTES):
            split, ends = batch_words(b.column("text").to_pylist())
            hashes = hashes_of(chain.from_iterable(split), int(ends[-1]))
            starts, sizes, anchor = anchors(hashes, ends, window, run)
            doc = np.searchsorted(ends, starts, side="right")
            begins = ends - [len(w) for w in split]
            names = [b.column(c).to_numpy() for c in NAME]
            place = names[0][doc]
            order = np.argsort(anchor, kind="stable")
            heads = np.flatnonzero(np.append(True, np.diff(anchor[order]) != 0)) if len(order) else order
            low, high = (f.reduceat(place[order], heads) if len(order) else place for f in (np.minimum, np.maximum))
            twice = np.flatnonzero(low < high)
            known = np.empty(len(order), bool)
            known[order] = np.repeat(low < high, np.diff(np.append(heads, len(order))))
            m = len(twice)
            own = names[1][doc] ^ place * np.int64(0x9E3779B1)
            pad = np.zeros(m, np.int64)
            columns = [
                *[np.append(c[doc], pad) for c in names],
                np.append(starts - begins[doc], pad).astype(np.int32),
                np.append(sizes, pad).astype(np.int32),
                np.append(anchor, anchor[order[heads[twice]]] if m else pad),
                np.append(np.where(known, own, anchor), anchor[order[heads[twice]]] if m else pad),
                np.append(place, low[twice]),
                np.append(place, high[twice]),
            ]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.append(known, np.zeros(m, bool)))], [*NAME, "start", "windows", "anchor", "deal", "low", "high", "known"])

    return docs.mapInArrow(work, f"{NAMES}, start int, windows int, anchor long, deal long, low long, high long, known boolean")


def cut_segments(docs: DataFrame, window: int) -> DataFrame:
    """The words of the listed segments, joined by spaces."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lists = b.column("segments")
            counts = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            starts, windows = flat.field("start").to_pylist(), flat.field("windows").to_pylist()
            out, at = [], 0
            for text, n in zip(b.column("text").to_pylist(), counts.tolist()):
                words = (text or "").encode().split()
                out += [b" ".join(words[x : x + y + window - 1]) for x, y in zip(starts[at : at + n], windows[at : at + n])]
                at += n
            row = pa.array(np.repeat(np.arange(len(counts)), counts))
            columns = [*[b.column(c).take(row) for c in NAME], flat.field("start"), flat.field("anchor"), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*NAME, "start", "anchor", "words"])

    return docs.mapInArrow(work, f"{NAMES}, start int, anchor long, words binary")


def index_of(segments: list[bytes]) -> tuple[FMIndex, np.ndarray, np.ndarray, np.ndarray]:
    """The index over distinct segments, their words as numbers, and where each begins and how long it is."""
    numbers: dict[bytes, int] = {}
    symbols: list[int] = []
    lengths = []
    for s in segments:
        words = s.split(b" ")
        symbols += [numbers.setdefault(w, len(numbers) + 1) for w in words]
        symbols.append(0)
        lengths.append(len(words))
    text, length = np.array(symbols, np.int64), np.array(lengths, np.int64)
    index = FMIndex(text, len(numbers) + 1, int(length.max(initial=1)))
    return index, text, np.cumsum(length + 1) - (length + 1), length


def earlier_runs(segments: list[bytes], places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, first and last word (exclusive) of the longest runs, of `window` words or more, that the distinct segments
    share with one of a smaller place; in the order of the segments. Runs may overlap."""
    index, text, begin, length = index_of(segments)
    order = np.unique(places, return_inverse=True)[1].astype(np.int32)
    least = RangeMinimum(np.repeat(order, length + 1)[index.order])
    counts = length - window + 1
    segment = np.repeat(np.arange(len(segments)), counts)
    most = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + window
    found = [np.zeros(0, np.int64)]
    for k in range(0, len(most), 1 << 18):
        part = slice(k, k + (1 << 18))
        found.append(index.statistics(text, begin[segment[part]] + most[part], most[part], least, order[segment[part]]))
    matched = np.concatenate(found)
    first = most - matched
    hit = matched >= window
    longer = np.append(hit[1:] & (segment[1:] == segment[:-1]) & (first[1:] <= first[:-1]), False)  # the next one covers it
    hit &= ~longer
    return segment[hit], first[hit], most[hit]


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each shard, from batches that are sorted by shard."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        shards = b.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if kept and kept[-1].column("shard")[0] != b.column("shard")[x]:
                yield pa.Table.from_batches(kept)
                kept = []
            if y > x:
                kept.append(b.slice(x, y - x))
    if kept:
        yield pa.Table.from_batches(kept)


def search_segments(dealt: DataFrame, window: int) -> DataFrame:
    """Intervals of words to remove, per document, from segments that are dealt and sorted by shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches):
            rows = rows.combine_chunks()
            coded = rows.column("words").chunk(0).dictionary_encode()
            which, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            place = rows.column("place").to_numpy()
            least = np.full(len(distinct), LAST, np.int64)
            np.minimum.at(least, which, place)
            segment, first, last = earlier_runs(distinct, least, window)
            held = np.searchsorted(segment, np.arange(len(distinct) + 1))
            own = np.flatnonzero(place == least[which])
            many = np.diff(held)[which[own]]
            row = np.repeat(own, many)
            run = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(held[which[own]], many)
            whole = np.flatnonzero(place > least[which])
            length = np.array([s.count(b" ") + 1 for s in distinct], np.int64)
            pick = np.append(row, whole)
            start = rows.column("start").to_numpy()[pick]
            a, b = np.append(first[run], np.zeros(len(whole), np.int64)), np.append(last[run], length[which[whole]])
            taken = rows.select(NAME).take(pa.array(pick))
            columns = [*[taken.column(c).combine_chunks() for c in NAME], pa.array((start + a).astype(np.int32)), pa.array((start + b).astype(np.int32))]
            yield from pa.Table.from_arrays(columns, [*NAME, "start", "end"]).to_batches()

    return dealt.mapInArrow(work, f"{NAMES}, start int, end int")


def search_windows(dealt: DataFrame, window: int) -> DataFrame:
    """words and least place of each distinct window, from windows that are dealt and sorted by shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_shard(batches):
            index, text, begin, length = index_of(rows.column("words").to_pylist())
            least = RangeMinimum(np.repeat(rows.column("place").to_numpy(), length + 1)[index.order])
            yield pa.RecordBatch.from_arrays([rows.column("words").combine_chunks(), pa.array(least(*index.matching(text, begin, window)))], ["words", "least"])

    return dealt.mapInArrow(work, "words binary, least long")


def dealt_by(df: DataFrame, key: str, shards: int) -> DataFrame:
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
    return df.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard")


def with_name(docs: DataFrame) -> DataFrame:
    return named(docs.select("doc_id", F.col("text").cast("string").alias("text")))


def repeated_segments(docs: DataFrame, window: int, run: int) -> DataFrame:
    """Name, start, anchor and words of the segments whose anchor occurs in two documents."""
    # the counts and the join use every column and filter nothing beforehand, so that they read one exchange and the texts
    # are gone through once
    found = find_anchors(docs, window, run).repartition("deal")
    used = lambda *columns: F.max(reduce(Column.bitwiseXOR, [F.col(c).cast("long") for c in columns])).alias("used")
    counted = found.groupBy("deal").agg(F.min("low").alias("first"), F.max("high").alias("last"), F.bool_or("known").alias("sure"), used(*NAME, "start", "windows", "anchor"))
    again = counted.filter("(first < last or sure) and used is not null").select("deal")
    segment = F.when(F.col("windows") > 0, F.struct("start", "windows", "anchor"))
    listed = found.join(again.hint("shuffle_hash"), "deal").groupBy(*NAME).agg(F.collect_set(segment).alias("segments"), used("low", "high", "known"))
    listed = written(listed.filter("used is not null").select(*NAME, "segments"), "anchors")
    out = written(cut_segments(docs.join(listed, NAME), window), "segments")
    dropped(listed)
    return out


def intervals(docs: DataFrame, window: int = WINDOW, run: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Name, start and end (exclusive) of runs of words that an earlier document holds; they may overlap."""
    segments = repeated_segments(with_name(docs).select(*NAME, "text"), window, run)
    words = segments.agg(F.sum(F.octet_length("words")).alias("b")).first()["b"] or 0
    shards = max(1, words // (6 * SHARD_WORDS), docs.sparkSession.sparkContext.defaultParallelism if words > SHARD_WORDS else 1)
    crowds = written(segments.groupBy("anchor").count().filter(F.col("count") > hot).select(F.col("anchor").alias("crowd")), "crowds")
    if not crowds.limit(1).count():
        out = written(search_segments(dealt_by(segments, "anchor", int(shards)), window), "intervals")
        dropped(segments, crowds)
        return out
    marked = lookup(segments, crowds, F.col("anchor") == F.col("crowd"))
    usual = search_segments(dealt_by(marked.filter("crowd is null").drop("crowd"), "anchor", int(shards)), window)
    crowded = marked.filter("crowd is not null").drop("crowd")
    cut = F.split(F.decode("words", "UTF-8"), " ")
    each = crowded.groupBy("words").agg(F.min("place").alias("place")).select(F.col("words").alias("segment"), "place", cut.alias("w"))
    offsets = F.sequence(F.lit(0), F.size("w") - window)
    each = each.select("segment", "place", F.posexplode(F.transform(offsets, lambda k: F.encode(F.array_join(F.slice("w", k + 1, window), " "), "UTF-8"))).alias("k", "words"))
    answers = search_windows(dealt_by(each.groupBy("words").agg(F.min("place").alias("place")), "words", int(shards)), window)
    answered = each.join(answers, "words").groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("k", "least"))).alias("answers"))
    # a segment has fewer windows than a window has words, so what its first and last hit cover is one interval
    hits = F.transform(F.filter("answers", lambda x: x.getField("least") < F.col("place")), lambda x: x.getField("k"))
    held = crowded.join(answered, F.col("words") == F.col("segment")).withColumn("hits", hits).filter(F.size("hits") > 0)
    held = held.select(*NAME, (F.col("start") + F.array_min("hits")).alias("start"), (F.col("start") + F.array_max("hits") + window).alias("end"))
    out = written(usual.unionByName(held), "intervals")
    dropped(segments, crowds)
    return out


def removed(docs: DataFrame, window: int = WINDOW, run: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (start and end of removed words) and kept (the words that stay)."""
    listed = intervals(docs, window, run, hot).groupBy(*NAME).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    joined = with_name(docs).join(listed, NAME, "left").select("doc_id", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n_words, n_removed, texts, spans_out = [], [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                words = (text or "").encode().split()
                merged: list[list[int]] = []
                for s in spans or ():
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                kept, at = [], 0
                for start, end in merged:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept).decode())
                spans_out.append([{"start": x, "end": y} for x, y in merged])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans_out, kind), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(work, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start: int, end: int>>, kept string")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
