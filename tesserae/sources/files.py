"""Scans and sinks: CSV as text with a row id, CSV and Parquet out, model metadata as JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; multi-line fields and doubled quotes are understood. row_id follows the file's order.

    The header alone gives the schema, so that nothing is inferred and numbers in text columns stay as written.
    """
    options = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.options(**options).schema(schema).csv(path).withColumn("row_id", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str) -> None:
    """Arrays are joined by commas, as CSV has no nested values."""
    flat = [F.array_join(f.name, ",").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def geometry_column(df: DataFrame) -> str:
    """The first of the usual names that df has."""
    return next(c for c in ("geometry_clean", "wkt", "geometry") if c in df.columns)


def with_id(df: DataFrame) -> DataFrame:
    return df if "id" in df.columns else df.withColumn("id", F.col("row_id").cast("string"))


def write_metadata(spark: SparkSession, path: str, features: list[str], medians: dict[str, float], score: float) -> None:
    text = json.dumps({"features": features, "impute_medians": medians, "holdout_r2": score}, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))
