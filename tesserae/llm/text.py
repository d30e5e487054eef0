"""Words, lines and batches shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Spark's setting by which a query's shuffle files go when the query ends.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LAST = (1 << 63) - 1
#: ASCII white space; everything else belongs to words. bytes.split() without arguments splits at the same bytes.
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def words(text: Column) -> Column:
    """The maximal runs without ASCII white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Texts of one byte a character take the quick way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most_bytes` of text, at least one row each; bounds a worker's memory."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total + n > most_bytes and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield batch.slice(start)


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, and survives the loss of executors.

    Spark removes the shuffle files behind the table as soon as it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}-{name}"
    before = spark.conf.get(REMOVE_SHUFFLES, "false")
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(REMOVE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of written(), once all that was made from them is written too."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def named(docs: DataFrame) -> DataFrame:
    """docs with place, tag and more, which name a row by its id and text: rows equal in all three are one document.

    place orders documents; rows without an id come last. tag is a 64-bit hash of the text and tells rows of one id
    apart; the rows without an id are as many as the table may have, so more adds 60 other bits for them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    more = F.when(F.col("doc_id").isNull(), F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))
    return docs.withColumns({"place": F.coalesce(F.col("doc_id"), F.lit(LAST)).cast("long"), "tag": F.xxhash64(text), "more": more})


NAME = ["place", "tag", "more"]


def lookup(df: DataFrame, table: DataFrame, on: Column, most_rows: int = 100_000) -> DataFrame:
    """df left-joined with a table of short rows that is already written: broadcast up to `most_rows`, shuffled beyond."""
    return df.join(F.broadcast(table) if table.limit(most_rows + 1).count() <= most_rows else table, on, "left")
