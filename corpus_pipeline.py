"""The corpus pipeline: quality, line dedup, near-dedup, mixing, encoding.

Each stage takes the rows that its predecessor kept and returns a DataFrame; run() writes each as Parquet in the shared
folder and reads it again for the next.

All stages take rows as they come. A null text counts as empty; texts are looked at whole, however long. An empty table
gives an empty table with the same columns. Columns besides those named are carried along unchanged, whatever their
names; encode() alone returns columns of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import line_runs, mixing, near_dups, pieces, resampling
from tesserae.llm.text import documents, labels, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go. Null and empty texts have weight 0, rows that repeat share a key, and
    those that tie with the last kept one stay."""
    return resampling.selected(docs, labels(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left by that. Rows equal in id and text stay
    equal; null and empty texts have no lines and stay. n_chars, where there is one, follows a text that is cut."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    cut = line_runs.deduplicated(rows).filter("n_deleted = 0 or n_deleted < n_lines")

    def value(c: str):
        if c == "n_chars":
            return F.when(F.col("n_deleted") > 0, F.char_length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        return F.col("text") if c == "text" else F.col("row").getField(c).alias(c)

    return cut.select(*map(value, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id. Five-word shingles, similarity 0.8. Texts without
    words and rows without an id are in no group and stay; of rows that repeat one stays."""
    return near_dups.representatives(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Texts without words add none and go as their key says; rows without a source are a source of
    their own; rows that repeat count each."""
    mixed = mixing.mixed(docs.select("doc_id", "text", "source", F.struct("*").alias("row"))).filter("mix_copies > 0")
    copies = mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int"))))
    return copies.select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the ids and decoded text of SentencePiece. Null and empty texts give begin and end ids."""
    return pieces.encoded(docs, pieces.Pieces(pieces.default_model()), keep=["source"])


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mix),
    ("SentencePiece", encode),
]

#: Sampling noise, signatures and the merge rounds are no SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
