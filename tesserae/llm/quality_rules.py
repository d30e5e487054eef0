"""Quality rules by document, and verdicts by host from shrunk failure rates. DataFrame functions only.

A document fails with fewer than `least_words` words, or if more than `most_repeated` per cent of its words lie in
five-word windows that occur twice or more in it. For every host (the `source` column; rows without one form a host of
their own) failures are counted with partial sums, so a hot host costs no more than any other. A beta prior is fitted to
the hosts' rates by moments, and each host's rate is shrunk to (failed + a) / (rows + a + b). A host whose shrunk rate
is above `most_rate` is rejected with all its documents.

Null, empty: no words, so the document fails. Repeated rows count as often as they occur. An empty table gives no rows.
Without spread between hosts (one host, or equal rates) the prior is as strong as STRONGEST documents. Very long texts
are whole: their windows are counted within the row. Columns besides doc_id, text and source are not looked at, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import documents, lookup, words, written

#: Bounds of a + b, in documents.
WEAKEST, STRONGEST = 1.0, 1e6


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and host with word_chars, n_symbols, n_dup_lines, n_words and n_repeat_words (long)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        words(text).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    at = lambda k: F.get(F.col("w"), k)
    window = lambda k: F.xxhash64(at(k), at(k + 1), at(k + 2), at(k + 3), at(k + 4))
    none = F.array().cast("array<bigint>")
    two = one.select(
        "doc_id",
        "host",
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 5, F.transform(F.sequence(F.lit(0), F.size("w") - 5), window)).otherwise(none).alias("h"),
    )
    kept = [c for c in two.columns if c != "h"]
    pairs = F.array_sort(F.transform("h", lambda x, k: F.struct(x.alias("x"), k.alias("k"))))
    repeated = F.size(F.array_distinct("h")) < F.size("h")
    three = two.select(*kept, F.when(repeated, pairs).alias("s"))
    same = lambda x, k: F.get(F.col("s"), k).getField("x") == x.getField("x")
    met = F.filter("s", lambda x, k: F.coalesce(same(x, k + 1), F.lit(False)) | (k > 0) & same(x, F.greatest(k - 1, F.lit(0))))
    four = three.select(*kept, F.array_sort(F.transform(met, lambda x: x.getField("k"))).alias("p"))
    covered: Column = F.aggregate(
        F.transform("p", lambda q, k: F.least(F.lit(5), F.coalesce(F.get(F.col("p"), k + 1) - q, F.lit(5))).cast("long")),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    return four.select(*kept, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def host_verdicts(failures: DataFrame, most_rate: float = 0.5) -> DataFrame:
    """host, host_docs, host_failed, host_rate (shrunk) and host_kept, from rows with host and base_failed."""
    hosts = failures.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    m, v = F.avg(rate), F.var_samp(rate)
    strength = F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), F.coalesce(F.try_divide(m * (1 - m), v) - 1, F.lit(STRONGEST))))
    prior = hosts.agg((m * strength).alias("a"), strength.alias("strength"))
    a, s = prior.select("a").scalar(), prior.select("strength").scalar()
    shrunk = (F.col("host_failed") + a) / (F.col("host_docs") + s)
    return hosts.select("*", shrunk.alias("host_rate")).withColumn("host_kept", F.col("host_rate") <= most_rate)


def judged(docs: DataFrame, least_words: int = 10, most_repeated: int = 20, most_rate: float = 0.5) -> DataFrame:
    """Every row's features, base_failed, its host's figures and kept."""
    few = F.col("n_words") < least_words
    dense = 100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")
    # both the counting and the join below read the features; written, the texts are gone through once
    base = written(with_features(docs).withColumn("base_failed", few | dense), "rules")
    verdicts = written(host_verdicts(base, most_rate).withColumnRenamed("host", "verdict_host"), "hosts")
    joined = lookup(base, verdicts, F.col("host").eqNullSafe(F.col("verdict_host"))).drop("verdict_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host_docs", "host_failed", F.round("host_rate", 6).alias("host_rate"),
    )


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, source, text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, k, w[k:k+4]::VARCHAR AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM w)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, x) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT k + d) AS n FROM r, range(0, 5) AS t(d) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, w.source, len(w.w)::BIGINT AS n_words,
    length(array_to_string(w.w, ''))::BIGINT AS word_chars,
    (length(coalesce(w.text, '')) - length(regexp_replace(coalesce(w.text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*)::BIGINT AS host_docs, sum(base_failed::INT)::BIGINT AS host_failed FROM b GROUP BY source),
p AS (
  SELECT m, greatest(1.0, least(1e6, coalesce(m * (1 - m) / nullif(v, 0) - 1, 1e6))) AS s
  FROM (SELECT avg(host_failed / host_docs) AS m, var_samp(host_failed / host_docs) AS v FROM h)),
v AS (SELECT h.*, (host_failed + (SELECT m * s FROM p)) / (host_docs + (SELECT s FROM p)) AS host_rate FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= 0.5 AS kept, host_docs, host_failed, round(host_rate, 6) AS host_rate
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""
