"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

Every document gets the key -ln(u) / weight, with u in (0, 1) from a hash of its id and the seed; ascending keys give a
weighted order without replacement. A source's target is its share of all words by weight, at most `most_epochs` times
its size, with the excess shared again by weight (water filling, in closed form: sources in the order of cap by weight
fill up one after the other). A source repeats whole as often as its target holds it; the rest is taken in key order
until the words reach what is left, the last document if at least half of it fits.

Prefix sums don't need a source in one task: keys fall into bins of equal width, the bins' sums are summed up within a
source (at most MOST_BINS rows), and only the bin in which a source's rest ends is sorted.

Null or empty texts have no words; nothing is taken from them. Rows without a source form a source of their own, last
in order. Rows without an id share one u. Equal keys are ordered by id, then by a hash of the text, so that only rows
equal in both stand in any order. Repeated rows count as often as they occur. A very long text is taken whole or not at
all. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import documents, lookup, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
BINS_PER_UNIT, MOST_BINS = 4096, 1 << 19


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def text_weight(text: Column, size: Column) -> Column:
    """1 for texts of usual word lengths (4 to 11 characters with the space), else a half."""
    return F.when(F.coalesce(F.try_divide(F.char_length(text.cast("string")), size).between(4, 11), F.lit(False)), 1.0).otherwise(0.5)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3) -> DataFrame:
    """source, source_size and target, from source and size: one row a source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row a source
    weighed = by_source.withColumn("weight", F.get(F.array(*map(F.lit, weights)), rank % len(weights)).cast("long"))
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = most_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - full) / rest
    leveled = weighed.withColumn("level", level).withColumn("at", F.row_number().over(filling))
    open_at = F.when(F.col("level") * F.col("weight") <= most_epochs * F.col("source_size"), F.col("at"))
    final = F.min_by("level", open_at).over(everything)
    cap = (most_epochs * F.col("source_size")).cast("double")
    return leveled.withColumn("final", final).select("source", "source_size", F.least(cap, F.coalesce(F.col("final") * F.col("weight"), cap)).alias("target"))


def mixed(docs: DataFrame, weight: Column | None = None, seed: int = 7, most_epochs: int = 3) -> DataFrame:
    """The rows of docs with mix_size, mix_source_size, mix_target and mix_copies: how often the mix takes the row.

    Columns of these names in docs are replaced; all others are kept, whatever their names.
    """
    made = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    rows = docs.drop(*made).select(F.struct("*").alias("row"))
    doc_id, text = F.col("row.doc_id"), F.col("row.text")
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    sized = rows.select("row", F.col("row.source").alias("source"), size_of(text).alias("size"))
    keyed = sized.withColumn("key", -F.log(u) / (text_weight(text, F.col("size")) if weight is None else weight))
    keyed = keyed.withColumn("bin", F.least(F.floor(F.col("key") * BINS_PER_UNIT), F.lit(MOST_BINS)).cast("int"))
    # the sums of the bins are all that the plan needs from a first pass
    bins = written(keyed.groupBy("source", "bin").agg(F.sum("size").alias("size")), "bins")
    epochs = F.least(F.lit(most_epochs), F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))).cast("long")
    wanted = targets(bins, most_epochs=most_epochs).withColumn("epochs", epochs)
    wanted = wanted.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    b, t = bins.alias("b"), wanted.alias("t")
    summed = F.sum("b.size").over(Window.partitionBy("b.source").orderBy("b.bin"))
    ends = b.join(t, F.col("b.source").eqNullSafe(F.col("t.source"))).select("t.*", "b.bin", "b.size", summed.alias("end"))
    crossing = F.min_by(F.struct("bin", (F.col("end") - F.col("size")).alias("before")), F.when(F.col("end") > F.col("rest"), F.col("bin")))
    plan = ends.groupBy(F.col("source").alias("plan_source")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("epochs").alias("epochs"), F.first("rest").alias("rest"), crossing.alias("cross")
    )
    joined = lookup(keyed, written(plan, "plan"), F.col("source").eqNullSafe(F.col("plan_source")))
    at = F.coalesce(F.col("cross.bin"), F.lit(MOST_BINS + 1))  # no bin crosses if the whole source fits
    decided = joined.filter(F.col("bin") != at).withColumn("more", (F.col("bin") < at).cast("long"))
    order = Window.partitionBy("plan_source").orderBy("key", doc_id.asc_nulls_last(), F.xxhash64(text))
    before = F.col("cross.before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    open_bin = joined.filter(F.col("bin") == at).withColumn("more", (2 * before + F.col("size") <= 2 * F.col("rest")).cast("long"))
    out = decided.unionByName(open_bin)
    values = [F.col("size"), F.col("source_size"), F.col("target"), F.col("epochs") + F.col("more")]
    return out.select("row.*", *[v.alias(n) for v, n in zip(values, made)])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(documents(spark, sf_dir).select("doc_id", "text", "source")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('7:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496)
    / CASE WHEN length(text) / nullif(size, 0) BETWEEN 4 AND 11 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3] AS weight FROM s),
fill(n, left_over, open) AS (
  SELECT 0, (SELECT sum(source_size) FROM w)::DOUBLE, (SELECT list(source) FROM w)
  UNION ALL
  SELECT n + 1, left_over - (SELECT coalesce(sum(3 * source_size), 0) FROM w WHERE list_contains(open, source) AND left_over * weight > 3.0 * source_size * (SELECT sum(weight) FROM w AS v WHERE list_contains(open, v.source))),
    (SELECT list(source) FROM w WHERE list_contains(open, source) AND left_over * weight <= 3.0 * source_size * (SELECT sum(weight) FROM w AS v WHERE list_contains(open, v.source)))
  FROM fill WHERE n < 60),
z AS (SELECT * FROM fill WHERE n = 60),
t AS (
  SELECT w.*, CASE WHEN list_contains((SELECT open FROM z), source)
    THEN (SELECT left_over FROM z) * weight / (SELECT sum(weight) FROM w AS v WHERE list_contains((SELECT open FROM z), v.source)) ELSE 3.0 * source_size END::DOUBLE AS target FROM w),
e AS (SELECT *, least(3, floor(target / source_size))::BIGINT AS epochs FROM t),
o AS (
  SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - k.size AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""
