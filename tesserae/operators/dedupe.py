"""Duplicates: the first row of each key stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by order for each combination of keys; nulls are one value. The window's filter stops at one row a key before the shuffle."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def keep_first_in_turn(df: DataFrame, key_sets: list[list[str]], order: str) -> DataFrame:
    for keys in key_sets:
        df = keep_first(df, keys, order)
    return df


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows, distinct keys, rows that a keep-first drops, and rows whose key occurs more than once."""
    by = df.groupBy(*keys).agg(F.count("*").alias("n"))
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    return by.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), (F.sum("n") - F.count("*")).alias("n_dropped"), repeated.alias("n_repeated"))
