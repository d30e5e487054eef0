"""MinHash near-dedup by a multi-index Hamming join.

A document's set holds its distinct shingles of `words` words in lower case (A-Z only); with fewer words the whole
sequence is its one shingle. Documents with equal sets form a class, and only classes are compared. A signature is
SYMBOLS minimum hashes cut to BITS bits. It is split into CHUNKS; two signatures that differ in at most
CHUNKS * (ERRORS + 1) - 1 symbols have a chunk with at most ERRORS = 1 of them, so every chunk is looked up once for
each symbol that may be wrong, with that symbol left out. All pairs within that distance share a key. At a similarity of
0.85 a symbol differs with probability 0.15, and more than 23 of 48 do for less than one pair in 10^8.

Keys that one class has alone go. A group of many copies shares keys, and all of its pairs are never made. In turns each
key gets a pivot among its classes, and each class is compared with the nearest by signature of the pivots that it meets
and that are of another component; links that hold on the full sets put components together. A key whose classes are in
one component is done. Once a turn leaves most components apart, the classes of the keys that are left are joined
exactly, with prefix and position filters over their shingles, and the pairs across components that pass are verified
on the full sets. So no pair that shares a key is left undecided, the components are those of all links, and the edges
are few for each class, however many links a group has.

Null, empty: no shingles, linked with nothing. Rows without an id join no group: component_id is null, kept true. Rows
with one id and different texts are linked like any others. Repeated rows fall into one class. An empty table gives no
rows. component_id is the least doc_id of the component, so ties don't arise.
Very long texts are whole sets, cut into no parts; a batch holds one of them at a time. Columns besides doc_id and text
are not looked at, whatever their names; representatives() returns them unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .substrings import hashes_of
from .text import documents, dropped, slices, written

SYMBOLS, BITS, CHUNKS, ERRORS = 48, 16, 12, 1
WIDTH = SYMBOLS // CHUNKS
FARTHEST = CHUNKS * (ERRORS + 1) - 1
#: Pivots get another turn while it leaves at most this share of the components that share keys.
MERGED = 0.8
#: Bits that bound the difference of two sets from below.
PARITY = 1024


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted, from the words' hashes."""
    size = min(k, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = words[:n] + np.uint64(size)
        for i in range(1, size):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[i : n + i]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def text_shingles(text: str | None, k: int) -> np.ndarray:
    words = (text or "").encode().lower().split()  # of bytes, lower() changes A-Z only
    return shingle_hashes(hashes_of(words, len(words)), k)


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(2024)
    return rnd.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rnd.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), SYMBOLS) symbols of BITS bits of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    with np.errstate(over="ignore"):
        for i, (a, b) in enumerate(zip(*multipliers())):
            least = np.minimum.reduceat((flat ^ b) * a, starts)
            out[:, i] = (least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    return out


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, set (a 128-bit name of the set) and signature; the latter two null for empty sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [text_shingles(t, k) for t in b.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full) if full else ())
            sig = [next(rows).tobytes() if len(s) else None for s in sets]
            names = [set_name(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(sig, pa.binary())], ["doc_id", "n", "set", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, "doc_id long, n long, set binary, signature binary")


def parity(shingles: np.ndarray) -> np.ndarray:
    """PARITY bits, each toggled by every shingle that falls on it: two sets differ in at least as many shingles as bits."""
    odd = np.bincount((shingles >> np.uint64(64 - PARITY.bit_length() + 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def with_shingles(docs: DataFrame, k: int) -> DataFrame:
    """set, shingles and parity bits of every text that has any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [s for t in b.column("text").to_pylist() if len(s := text_shingles(t, k))]
            yield pa.RecordBatch.from_arrays([pa.array([set_name(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([parity(s) for s in sets], pa.list_(pa.int64()))], ["set", "shingles", "bits"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "set binary, shingles array<long>, bits array<long>")


def lookup_keys(signature: np.ndarray) -> np.ndarray:
    """(n, SYMBOLS) keys: each symbol's chunk without that symbol, behind the symbol's number."""
    parts = signature.reshape(len(signature), CHUNKS, WIDTH).astype(np.int64)
    keys = np.empty((len(signature), CHUNKS, WIDTH), np.int64)
    for out in range(WIDTH):
        key = np.zeros((len(signature), CHUNKS), np.int64)
        for i in range(WIDTH):
            if i != out:
                key = key << BITS | parts[:, :, i]
        keys[:, :, out] = key | (np.arange(CHUNKS) * WIDTH + out) << (BITS * (WIDTH - 1))
    return keys.reshape(len(signature), SYMBOLS)


def keyed(classes: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            keys = lookup_keys(sig).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column("c").to_numpy(), SYMBOLS))], ["key", "c"])

    return classes.select("c", "signature").mapInArrow(work, "key long, c long")


def with_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b, p, q) with the distance of their signatures, up to FARTHEST."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for c in ("x", "y"))
            far = (x != y).sum(axis=1).astype(np.int32)
            ok = far <= FARTHEST
            near = b.select(["a", "b", "p", "q"]).filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([*near.columns, pa.array(far[ok])], ["a", "b", "p", "q", "far"])

    x = classes.select(F.col("c").alias("a"), F.col("signature").alias("x"))
    y = classes.select(F.col("c").alias("b"), F.col("signature").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "p", "q", "x", "y").mapInArrow(work, "a long, b long, p long, q long, far int")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, p, q) whose sets reach the similarity."""
    x = sets.select(F.col("c").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("c").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b")
    both = both.select("a", "b", "p", "q", F.size(F.array_intersect("x", "y")).cast("long").alias("same"), (F.size("x") + F.size("y")).cast("long").alias("all"))
    return both.filter(100 * F.col("same") >= percent * (F.col("all") - F.col("same"))).select("a", "b", "p", "q")


def components(edges: DataFrame) -> DataFrame:
    """node and comp, the least node that it reaches, for the nodes of edges (a, b), by contraction.

    In each round every node takes the name whose hash is the least within two steps; the hash differs by round. Edges
    within a name go, and equal ones become one, so that each round leaves a fraction of the names, hubs or not.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct(), "edges")
    names, turn = written(both.select(F.col("a").alias("node"), F.col("a").alias("name")).distinct(), "names"), 0
    while both.limit(1).count():
        turn += 1
        mark = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        one = both.groupBy("a").agg(F.least(mark("a"), F.min(mark("b"))).alias("one"))
        near = both.join(one.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("one").alias("two")).select("a", F.col("two.to").alias("to"))
        near = written(near, "near")
        left = both.join(near, "a").select(F.col("to").alias("x"), "b").join(near.withColumnsRenamed({"a": "b", "to": "y"}), "b")
        fewer = written(left.filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        renamed = written(renamed_by(names, "name", near.withColumnsRenamed({"a": "node", "to": "comp"})), "names")
        dropped(both, near, names)
        both, names = fewer, renamed
    dropped(both)
    low = names.groupBy("name").agg(F.min("node").alias("comp"))
    return names.join(low, "name").select("node", "comp")


def renamed_by(rows: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """rows with the values of `column` that stand as node in names replaced by their comp."""
    to = names.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
    joined = rows.join(to, rows[column] == to["_node"], "left")
    return joined.select(*[F.coalesce("_comp", c).alias(c) if c == column else c for c in rows.columns])


def mixed_keys(rows: DataFrame) -> DataFrame:
    """The rows (key, comp, ...) of keys that have more than one component."""
    keys = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x < y").select("key")
    return rows.join(keys, "key")


def classes_of(sketches: DataFrame) -> DataFrame:
    grouped = sketches.filter("set is not null and doc_id is not null").groupBy("set")
    one = grouped.agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    return written(one.withColumn("c", F.monotonically_increasing_id()), "classes")


def sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """c, shingles and bits of the wanted classes, from the texts of their first documents; one row a class, however often these stand in docs."""
    need = written(classes.join(wanted, "c", "left_semi").select("c", "set", "low"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("low"), "text").join(need.select("low").distinct(), "low", "left_semi")
    shingled = with_shingles(texts, k)
    # a set is one class; the join has dealt the rows by it
    out = written(shingled.join(need.select("c", "set"), "set").dropDuplicates(["set"]).select("c", "shingles", "bits"), "sets")
    dropped(need)
    return out


def nearest_pivots(rows: DataFrame, classes: DataFrame, turn: int, tested: DataFrame | None) -> DataFrame:
    """Pairs (a, b) to compare, of components p and q: each class of rows (key, c, many, comp) with one pivot at most, the
    nearest by signature.

    Every key has one pivot: the class whose keys are the most shared, in later turns any by its hash. Classes of the
    pivot's component and pairs that were compared before are left out, so there are no more pairs than rows.
    """
    if turn:
        pivot = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "key", "c").alias("h"), "c", "comp")).alias("top"))
    else:
        weight = rows.groupBy("c").agg(F.sum("many").alias("weight"))
        pivot = rows.join(weight, "c").groupBy("key").agg(F.max(F.struct("weight", "c", "comp")).alias("top"))
    pivot = pivot.select("key", F.col("top.c").alias("b"), F.col("top.comp").alias("q"))
    star = rows.join(pivot, "key").filter("comp != q").select(F.col("c").alias("a"), "b", F.col("comp").alias("p"), "q").distinct()
    if tested is not None:
        star = star.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return with_distance(star, classes).groupBy("a").agg(F.min(F.struct("far", "b", "p", "q")).alias("near")).select("a", "near.b", "near.p", "near.q")


def placed(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """c and comp of the classes that share a key with others: the components of all links between classes."""
    keys = keyed(classes)
    shared = keys.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1")
    rows = written(keys.join(shared, "key").withColumn("comp", F.col("c")), "keys")
    out = written(rows.select("c", "comp").distinct(), "placed")
    sets = sets_of(docs, classes, out, k)
    tested: list[DataFrame] = []
    before = None
    while number := rows.agg(F.count_distinct("comp")).first()[0]:
        # if a turn leaves most components apart, what is open is settled at once
        last = before is not None and number > before * MERGED
        if last:
            pairs = written(crossing_pairs(rows, sets, percent), "pairs")
        else:
            pairs = written(nearest_pivots(rows, classes, len(tested), reduce(DataFrame.union, tested) if tested else None), "stars")
        found = linked(pairs, sets, percent).select(F.col("p").alias("a"), F.col("q").alias("b"))
        names = written(components(found), "components")
        moved = written(renamed_by(out, "comp", names), "placed")
        dropped(out)
        out, before = moved, number
        tested.append(pairs)
        if last:
            break
        fewer = written(mixed_keys(renamed_by(rows, "comp", names)), "mixed")
        dropped(rows, names)
        rows = fewer
    dropped(rows, sets, *tested)
    return out


def crossing_pairs(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components p and q among the classes of rows that may reach the similarity.

    An exact set-similarity join: shingles stand in one order, rarest first by the classes in question. Sets that reach
    the similarity share a shingle of their prefixes; where the first that they share stands bounds their overlap, as
    none of those before it is common. Parity bits then bound the difference of what is left from below. So a group of
    loose copies makes hardly any pairs but those that are links or nearly so, though all of them share most shingles.
    """
    asked = rows.select("c", "comp").distinct()
    each = sets.join(asked, "c").select("c", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("many"))
    order = F.array_sort(F.collect_list(F.struct("many", "shingle")))  # as long as the set itself
    ordered = each.join(held, "shingle").groupBy("c", "comp", "n").agg(order.alias("order"))
    prefix = F.slice("order", 1, F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1)
    posted = ordered.select("c", "comp", "n", F.posexplode(prefix).alias("at", "one")).filter("one.many > 1")
    posted = written(posted.select("c", "comp", "n", "at", F.col("one.shingle").alias("shingle")), "posted")
    bits = sets.select("c", *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(PARITY // 64)])
    posted = posted.join(bits, "c")
    x, y = (posted.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in posted.columns if c != "shingle"]) for side in "xy")
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    enough = (100 + percent) * left >= percent * (F.col("n_x") + F.col("n_y"))
    differ = sum((F.bit_count(F.col(f"b{i}_x").bitwiseXOR(F.col(f"b{i}_y"))) for i in range(PARITY // 64)), F.lit(0))
    near = (100 + percent) * differ <= (100 - percent) * (F.col("n_x") + F.col("n_y"))
    met = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("c_x") < F.col("c_y")) & (F.col("comp_x") != F.col("comp_y")) & enough & near)
    p, q = F.least("comp_x", "comp_y").alias("p"), F.greatest("comp_x", "comp_y").alias("q")
    return met.select(F.col("c_x").alias("a"), F.col("c_y").alias("b"), p, q).distinct()


def components_by_set(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sketches of docs, and set with component_id."""
    sketches = written(sketched(docs, words), "sketches")
    classes = classes_of(sketches)
    found = classes.select("set", "c", "low").join(placed(docs, classes, words, percent), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    names = found.groupBy("comp").agg(F.min("low").alias("component_id"))
    return sketches, found.join(names, "comp").select("set", "component_id")


def grouped(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each of docs."""
    sketches, named = components_by_set(docs, words, percent)
    out = sketches.select("doc_id", F.col("n").alias("n_shingles"), "set").join(named, "set", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without those that stand for no group: a row goes if its id is not its component's.

    Of rows that repeat one id, one with each text stays.
    """
    out = grouped(docs, words, percent)
    gone = written(out.filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.struct("*").alias("row"))
    stay = rows.join(gone, "doc_id", "left_anti")
    repeated = written(docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().filter("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    if not repeated.limit(1).count():
        return stay.select("row.*")
    once = stay.join(repeated, "doc_id", "left_anti")
    return once.unionByName(stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select("row.*")


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(documents(spark, sf_dir), words=3, percent=85)
