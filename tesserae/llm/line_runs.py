"""Line dedup: a suffix array over sequences of line ids, by distributed prefix doubling. DataFrame functions only.

A document is the sequence of its lines that hold a word; a line's id is a 128-bit hash. Suffixes get the rank of their
first line, then of their first two, four, ... lines: the rank of 2k lines at a place is that of the pair of ranks of k
lines there and k lines further on. Ranks follow the order of the pairs: distinct pairs are partitioned by range and
sorted, and numbered by partition and place. Suffixes that stand alone in their rank have left the array, since no
longer run of theirs repeats either; so do pairs that reach beyond a document's end. Doubling goes on until no run
repeats, so the ranks hold every common prefix.

Suffixes of one rank at depth `min_lines` (from two overlapping powers of two, if it is none) are an interval of the
suffix array; all but its first by doc_id and place start a later copy. Where the suffix before starts the same copy one
line earlier, it is part of that one; the others are heads. A head's longest common prefix with the first of its interval
is read from the ranks, from the deepest down: where the ranks of both agree, that many lines are common, and the rest is
compared behind them. A head and its prefix are a maximal repeated run. A line of `min_words` words or more counts as a
run by itself, and with `pair_words` so do two lines that hold so many together. Each run stays where it occurs first;
its later copies are deleted.

Null or empty texts have no lines. Lines without a word are kept. Rows without an id come after all others, ordered by a
hash of the text. Rows equal in id and text are one document and give equal results. A very long text is as many rows as
it has lines. An empty table gives no rows. Columns besides doc_id and text are kept, whatever their names, but for
n_lines and n_deleted, which deduplicated() makes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import NAME, SPACES, documents, dropped, named, written

MIN_LINES, MIN_WORDS = 3, 30
#: Words of two lines, for callers that take these as a run; OP10_SQL does not.
PAIR_WORDS = 51
AT = [*NAME, "i"]
WORD = r"[^\x20\x09-\x0D]"


def first_and_last(df: DataFrame, *keys: str) -> DataFrame:
    """Per key the first and the last place; a key with one place can't repeat. Partial sums make hot keys small."""
    at = F.struct(*AT)
    return df.groupBy(*keys).agg(F.min(at).alias("first"), F.max(at).alias("last")).filter("first != last")


def ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """The groups with rank, in the order of the keys."""
    return groups.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, "first", F.monotonically_increasing_id().alias("rank"))


def numbered(rows: DataFrame, *keys: str, depth: int) -> DataFrame:
    """The rows whose keys repeat, with their rank and the first place of it."""
    ranks = written(ranked(first_and_last(rows, *keys), *keys), f"ranks-{depth}")
    out = written(rows.join(ranks, [*keys]).drop(*keys), f"suffixes-{depth}")
    dropped(ranks)
    return out


def shifted(suffixes: DataFrame, by: int) -> DataFrame:
    """Each suffix's rank beside that of the suffix `by` lines further on, where there is one, and the words of both."""
    on = suffixes.select(*NAME, (F.col("i") - by).cast("int").alias("i"), F.col("rank").alias("right"), F.col("words").alias("more_words"))
    both = suffixes.select(*AT, F.col("rank").alias("left"), "words").join(on, AT)
    return both.withColumn("words", F.col("words") + F.col("more_words")).drop("more_words")


def suffix_ranks(docs: DataFrame) -> dict[int, DataFrame]:
    """Tables by depth 1, 2, 4, ...: place and number of each suffix whose first `depth` lines repeat, words of these, rank and
    first, where they occur first. The last of them is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    lines = named(docs.select("doc_id", "text")).select(*NAME, F.posexplode(full).alias("i", "line"))
    words = F.size(F.split(F.trim(F.regexp_replace("line", SPACES, " ")), " "))
    lines = lines.select(*AT, F.unhex(F.md5("line")).alias("id"), words.alias("words"))
    one = numbered(lines, "id", depth=1)
    depth, out = 1, {1: written(one.dropDuplicates(AT), "suffixes")}
    dropped(one)
    while out[depth].limit(1).count():
        out[2 * depth] = numbered(shifted(out[depth], depth), "left", "right", depth=2 * depth)
        depth *= 2
    return out


def heads(copies: DataFrame) -> DataFrame:
    """Of the suffixes that start later copies those that don't continue the copy of the suffix before, with that copy's place."""
    before = Window.partitionBy(*NAME).orderBy("i")  # one document
    source = [F.col(f"first.{c}") for c in NAME]
    same = F.lag(F.struct(*source)).over(before) == F.struct(*source)
    next_to = (F.lag("i").over(before) == F.col("i") - 1) & (F.lag("first.i").over(before) == F.col("first.i") - 1)
    marked = copies.withColumn("inner", F.coalesce(same & next_to, F.lit(False)))
    return marked.filter(~F.col("inner")).select(*AT, "first")


def common_prefixes(pairs: DataFrame, ranks: dict[int, DataFrame]) -> DataFrame:
    """place, i and lcp: how many lines each head has in common with its first copy, read from the ranks, deepest first."""
    out = pairs.select(*AT, *[F.col(f"first.{c}").alias(f"from_{c}") for c in AT], F.lit(0).alias("lcp"))
    for depth, table in sorted(ranks.items(), reverse=True):
        rank = lambda side: table.select(*[F.col(c).alias(f"{side}{c}") for c in AT], F.col("rank").alias(f"{side}rank"))  # noqa: E731, B023
        here, there = rank("x_"), rank("y_")
        met = out.join(here, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"x_{c}") for c in NAME]) & (F.col("i") + F.col("lcp") == F.col("x_i")), "left")
        met = met.join(there, reduce(lambda a, b: a & b, [F.col(f"from_{c}") == F.col(f"y_{c}") for c in NAME]) & (F.col("from_i") + F.col("lcp") == F.col("y_i")), "left")
        more = F.when(F.col("x_rank") == F.col("y_rank"), depth).otherwise(0)
        out = written(met.withColumn("lcp", F.col("lcp") + more).select(out.columns), f"prefixes-{depth}")
    return out


def runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, pair_words: int | None = None) -> DataFrame:
    """Name, i and lines: the maximal runs of lines, by their number among the lines with a word, that are later copies. Long
    lines and pairs that are runs by themselves stand beside those that hold them."""
    ranks = suffix_ranks(docs)
    later = F.col("first") != F.struct(*AT)
    out = [ranks[1].filter(later & (F.col("words") >= min_words)).select(*AT, F.lit(1).alias("lines"))]
    if pair_words is not None and 2 in ranks:
        out.append(ranks[2].filter(later & (F.col("words") >= pair_words)).select(*AT, F.lit(2).alias("lines")))
    power = 1 << (min_lines.bit_length() - 1)
    if power in ranks:
        exact = ranks[power] if power == min_lines else numbered(shifted(ranks[power], min_lines - power), "left", "right", depth=min_lines)
        found = written(heads(exact.filter(later)), "heads")
        out.append(common_prefixes(found, ranks).select(*AT, F.col("lcp").alias("lines")))
    out = written(reduce(DataFrame.unionByName, out), "runs")
    dropped(*ranks.values())
    return out


def deletions(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, pair_words: int | None = None) -> DataFrame:
    """Name and gone: per document that loses lines, the sorted numbers of these among its lines with a word."""
    inside = Window.partitionBy(*NAME).orderBy("i", "lines")  # one document
    ends = runs(docs, min_lines, min_words, pair_words).withColumn("end", F.col("i") + F.col("lines"))
    # what runs before have covered is left out, so that runs that overlap name each line once
    ends = ends.withColumn("covered", F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    ends = ends.withColumn("from", F.greatest("i", "covered")).filter(F.col("from") < F.col("end"))
    each = ends.select(*NAME, F.explode(F.sequence(F.col("from"), F.col("end") - 1)).alias("i"))
    return each.groupBy(*NAME).agg(F.array_sort(F.collect_list("i")).alias("gone"))


def deduplicated(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, pair_words: int | None = None) -> DataFrame:
    """The rows of docs with text shortened (null stays null), and n_lines, n_deleted: lines with a word, and those deleted.

    Columns of the latter names in docs are replaced; all others are kept, whatever their names.
    """
    listed = deletions(docs, min_lines, min_words, pair_words)
    rows = docs.drop("n_lines", "n_deleted").select(F.struct("*").alias("row"))
    rows = named(rows.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))).drop("doc_id", "text")
    joined = rows.join(listed, NAME, "left").select("row", "gone", F.split(F.coalesce(F.col("row.text").cast("string"), F.lit("")), "\n").alias("lines"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    cut = joined.select("row", "gone", "lines", F.filter(every, lambda k: F.get(F.col("lines"), k).rlike(WORD)).alias("full"))
    out = F.transform("gone", lambda i: F.get(F.col("full"), i))
    cut = cut.select("row", F.size("full").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"), "lines", F.array_except(every, out).alias("left"))
    text = F.when(F.col("n_deleted") > 0, F.array_join(F.transform("left", lambda k: F.get(F.col("lines"), k)), "\n")).otherwise(F.col("row.text"))
    columns = [text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_deleted")]
    return cut.select(*columns, F.col("n_lines"), F.greatest(F.col("n_deleted"), F.lit(0)).alias("n_deleted"))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS no FROM documents),
f AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS has, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 30 AS long FROM l),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS i FROM f WHERE has),
w AS (SELECT *, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c FROM s WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS again1,
    c IS NOT NULL AND row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, i) > 1 AS again3 FROM w),
g AS (
  SELECT doc_id, i FROM r WHERE again1 AND long
  UNION SELECT doc_id, i + k FROM r, range(0, 3) AS t(k) WHERE again3),
o AS (
  SELECT f.doc_id, f.no, f.line, f.has, g.i IS NOT NULL AS gone
  FROM f LEFT JOIN s ON f.doc_id = s.doc_id AND f.no = s.no LEFT JOIN g ON s.doc_id = g.doc_id AND s.i = g.i)
SELECT doc_id, count(*) FILTER (WHERE has)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_deleted,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM o GROUP BY doc_id
"""
