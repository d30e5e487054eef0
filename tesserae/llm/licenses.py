"""License scans: an exact set-similarity join of text blocks with license templates. DataFrame functions only.

A block is a line; its set is its distinct words in lower case. It meets a template if it holds at least the share
`threshold` of the template's distinct words. Words of all templates are put in one global order, rarest first, by the
number of blocks of the corpus that hold them. A template of s words that must share c has a prefix of its s - c + 1
rarest: a block that meets it holds one of those. Blocks are joined with the prefix index on that word; pairs go if the
block has fewer than c words (length filter) or if too few words follow the shared one in either order (positional
filter); what is left is verified on the full sets.

A notice may be wrapped, so a run of as many consecutive words as the template has is a block too where it goes over a
line's end. Such runs are looked at around each word of a template's prefix alone, as no other can meet it.

Null or empty texts have no blocks. Rows with the same id and text get the same labels. Rows without an id are scanned
too. An empty table gives no rows. Very long texts are as many blocks as they have lines, and as many places of phrases.
Columns besides doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import documents, lower_ascii, written

#: What separates words once A-Z is in lower case.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose words must stand consecutively, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Common license notices by label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-terms": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-terms": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "rights-reserved": "All rights reserved",
}
THRESHOLD = 0.8


def tokens(text: str) -> list[str]:
    import re

    return [w for w in re.split(BREAKS, text.lower()) if w]


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def block_matches(docs: DataFrame, templates: dict[str, str], threshold: float) -> DataFrame:
    """id, key (hash of the text), template and containment of every block that meets a template."""
    sets = {name: sorted(set(tokens(t))) for name, t in templates.items()}
    vocabulary = sorted(set().union(*sets.values()))
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    lines = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.posexplode(F.split(text, "\n")).alias("block", "line"))
    every = F.filter(F.split("line", BREAKS), lambda w: w != "")
    own = lines.select("id", "key", "block", F.array_intersect(every, F.array(*map(F.lit, vocabulary))).alias("shared"))
    # read twice: for the words' frequencies and for the join
    blocks = written(own.filter(F.size("shared") > 0), "blocks")
    counts = {r["word"]: r["n"] for r in blocks.select(F.explode("shared").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}  # at most the templates' words
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index, whole = [], []
    for name, words in sets.items():
        words = sorted(words, key=order.__getitem__)
        least = needed(len(words), threshold)
        index += [(w, name, i, len(words), least) for i, w in enumerate(words[: len(words) - least + 1])]
        whole += [(name, words)]
    spark = docs.sparkSession
    prefixes = spark.createDataFrame(index, "word string, template string, place int, size int, least int")
    full = spark.createDataFrame(whole, "template string, words array<string>")
    rank = F.create_map(*[F.lit(x) for w, i in order.items() for x in (w, i)])
    ordered = F.array_sort(F.transform("shared", lambda w: F.struct(F.element_at(rank, w).alias("rank"), w.alias("word"))))
    listed = blocks.withColumn("ordered", ordered).select("id", "key", "block", "shared", F.posexplode("ordered").alias("at", "one"))
    pairs = (
        listed.withColumn("word", F.col("one.word"))
        .join(F.broadcast(prefixes), "word")  # bounded by the templates, which are a parameter
        .filter(F.size("shared") >= F.col("least"))
        .filter(F.least(F.col("size") - F.col("place"), F.size("shared") - F.col("at")) >= F.col("least"))
        # a pair is met at each shared word of the prefix; the first in the block's order stands for all
        .join(F.broadcast(full), "template")
        .withColumn("overlap", F.size(F.array_intersect("shared", "words")))
        .filter(F.col("overlap") >= F.col("least"))
    )
    met = pairs.groupBy("id", "key", "block", "template").agg(F.max(F.col("overlap") / F.col("size")).alias("containment"))
    return met.select("id", "key", "template", "containment").unionByName(wrapped_matches(docs, templates, vocabulary, prefixes, full))


def wrapped_matches(docs: DataFrame, templates: dict[str, str], vocabulary: list[str], prefixes: DataFrame, full: DataFrame) -> DataFrame:
    """id, key, template and containment of the runs of words over line ends that meet a template."""
    longest = max((len(tokens(t)) for t in templates.values()), default=1)
    lengths = docs.sparkSession.createDataFrame([(name, len(tokens(t))) for name, t in templates.items()], "template string, length int")
    rare = [r["word"] for r in prefixes.select("word").distinct().collect()]  # at most the templates' words
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    every = F.transform(F.split(text, "\n"), lambda x, i: F.transform(F.filter(F.split(x, BREAKS), lambda w: w != ""), lambda w: F.struct(i.alias("no"), w.alias("word"))))
    placed = F.transform(F.flatten(every), lambda x, p: F.struct(p.alias("p"), x["no"].alias("no"), x["word"].alias("word")))
    hits = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.filter(placed, lambda x: x["word"].isin(vocabulary)).alias("hits"))
    # places differ, so those within a run of a word are at most as many entries away
    around = lambda j: F.slice("hits", F.greatest(j - longest + 1, F.lit(0)) + 1, 2 * longest - 1)
    near = F.transform("hits", lambda x, j: F.when(x["word"].isin(rare), F.struct(x["p"].alias("p"), x["word"].alias("word"), around(j).alias("near"))))
    seeds = hits.select("id", "key", F.explode(F.filter(near, lambda x: x.isNotNull())).alias("one")).select("id", "key", "one.*")
    seeds = seeds.filter(F.element_at("near", 1)["no"] < F.element_at("near", -1)["no"])
    asked = seeds.join(F.broadcast(prefixes), "word").join(F.broadcast(full), "template").join(F.broadcast(lengths), "template")
    own = F.filter("near", lambda x: F.array_contains("words", x["word"]) & (F.abs(x["p"] - F.col("p")) < F.col("length")))
    asked = asked.withColumn("own", own).filter(F.size("own") >= F.col("least"))

    def held(x: Column) -> Column:
        inside = F.filter("own", lambda y: (y["p"] >= x["p"]) & (y["p"] < x["p"] + F.col("length")))
        return F.size(F.array_distinct(F.transform(inside, lambda y: y["word"])))

    best = asked.withColumn("overlap", F.array_max(F.transform("own", held))).filter(F.col("overlap") >= F.col("least"))
    return best.select("id", "key", "template", (F.col("overlap") / F.col("size")).alias("containment"))


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Per row: n_words, places and labels of the phrases, labels with the templates' and the best containment."""
    found = block_matches(docs, templates, threshold).groupBy("id", "key").agg(F.collect_set("template").alias("met"), F.max("containment").alias("best"))
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    base = docs.select("doc_id", F.xxhash64("text").alias("doc_key"), F.filter(F.split(text, BREAKS), lambda w: w != "").alias("w"))
    base = base.select("*", F.size("w").alias("n"), F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("line"))

    def starts(phrase: str):
        parts = phrase.split(" ")

        def stands(k):
            out = F.get(F.col("w"), k) == parts[0]
            for i, p in enumerate(parts[1:], 1):
                out = out & (F.get(F.col("w"), k + i) == p)
            return F.coalesce(out, F.lit(False))

        return F.when(F.contains("line", F.lit(f" {phrase} ")), F.filter(F.sequence(F.lit(0), F.col("n") - 1), stands)).otherwise(F.array().cast("array<int>"))

    base = base.select("doc_id", "doc_key", "n", F.array(*[F.struct(F.lit(label).alias("label"), starts(p).alias("at")) for p, label in phrases.items()]).alias("p"))
    every = F.flatten(F.transform("p", lambda x: x.getField("at")))
    base = base.select(
        "doc_id",
        "doc_key",
        F.col("n").cast("long").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform(F.filter("p", lambda x: F.size(x.getField("at")) > 0), lambda x: x.getField("label")))).alias("own"),
    )
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("key")), "left")
    met = F.coalesce("met", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", met)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(documents(spark, sf_dir))


def _sql() -> str:
    templates = ", ".join(f"('{n}', {sorted(set(tokens(t)))!r}, {needed(len(set(tokens(t))), THRESHOLD)})" for n, t in TEMPLATES.items())
    phrases = ", ".join(f"({p.split(' ')!r}, '{label}')" for p, label in PHRASES.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cut = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH t(template, words, least) AS (VALUES {templates}),
p(words, label) AS (VALUES {phrases}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS text FROM documents),
w AS (SELECT doc_id, {cut.format("text")} AS w FROM d),
b AS (
  SELECT doc_id, p.label, k - 1 AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM w) s, p
  WHERE w[k] = p.words[1] AND w[k:k + len(p.words) - 1] = p.words),
base AS (
  SELECT doc_id, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word, list(DISTINCT label) AS own FROM b GROUP BY doc_id),
l AS (SELECT doc_id, list_distinct({cut.format("line")}) AS words FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
m AS (
  SELECT doc_id, template, len(list_intersect(l.words, t.words)) AS overlap, len(t.words) AS size, least FROM l, t),
met AS (SELECT doc_id, list(DISTINCT template) AS met, max(overlap / size) AS best FROM m WHERE overlap >= least GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(met, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base ON w.doc_id = base.doc_id LEFT JOIN met ON w.doc_id = met.doc_id
"""


OP4_SQL = _sql()
