"""Profiles and diagnostics as tables: each is one or two aggregations."""

from __future__ import annotations

from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import kernel
from ..functions import rules as R
from .ranks import quantiles

def long_form(row: DataFrame, keys: str, value: str) -> DataFrame:
    """A one-row table turned into rows of name and value."""
    return row.unpivot([], row.columns, keys, value)


def missing_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_missing, pct_missing and pct_filled, in one pass."""
    counts = df.agg(F.count("*").cast("double").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    out = counts.unpivot(["_n"], columns, "column", "n_missing")
    pct = F.col("n_missing") * 100 / F.col("_n")
    return out.select("column", "n_missing", pct.alias("pct_missing"), (100 - pct).alias("pct_filled")).orderBy(F.desc("n_missing"), "column")


def filled_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows have how many values."""
    n = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.groupBy(n.alias("n_filled")).agg(F.count("*").alias("n_rows")).orderBy("n_filled")


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """name and n of rows for each condition."""
    return long_form(df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()]), "name", "n")


def value_counts(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    out = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())
    return out.limit(most) if most else out


def top_with_rest(df: DataFrame, column: str, most: int, rest: str = "other", missing: str = "missing") -> DataFrame:
    """The most frequent values, the others together, and nulls on their own."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    top = counts.filter(F.col(column).isNotNull()).orderBy(F.desc("n"), column).limit(most).select(F.col(column).alias("_top"))
    joined = counts.join(F.broadcast(top), F.col(column) == F.col("_top"), "left")  # `most` rows
    label = F.when(F.col(column).isNull(), missing).when(F.col("_top").isNotNull(), F.col(column).cast("string")).otherwise(rest)
    return joined.select(label.alias("label"), "n").groupBy("label").agg(F.sum("n").alias("n"))


def summary(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    shares = [0.25, 0.5, 0.75, 0.95, 0.99]
    if by:
        q = F.percentile(value, F.array(*map(F.lit, shares)))
    else:
        q = F.first(F.array(*[F.lit(x).cast("double") for x in quantiles(df, value, shares) or [None] * len(shares)]))
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("low"), q.alias("q"), F.avg(value).alias("mean"), F.max(value).alias("high"), F.stddev_samp(value).alias("std"))
    return out.select(*by, "n", "low", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3", "p95", "p99"))], "mean", "high", "std")


def box_plot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles and whiskers: the outermost values within 1.5 interquartile ranges."""
    q = df.groupBy(by).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count(value).alias("n"))
    q = q.select(F.col(by).alias("_by"), "n", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = df.join(q, F.col(by).eqNullSafe(F.col("_by"))).filter(F.col(value).between(F.col("q1") - reach, F.col("q3") + reach))
    return inside.groupBy(by, "n", "q1", "median", "q3").agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """bin (from 0), n: equal widths between the extremes, the last closed."""
    if low is None:
        low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
        if low is None:
            return df.sparkSession.createDataFrame([], "bin int, n long")
    width = (high - low) / bins or 1.0
    at = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(value).between(low, high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n")).orderBy("bin")


def ecdf(df: DataFrame, value: str, key: str) -> DataFrame:
    """Every value with its share of rows up to it in order; ties get ranks of their own, by key.

    Ranks are taken without one task for all rows: values are partitioned by range, and each partition starts from the
    count of those before it.
    """
    placed = df.filter(F.col(value).isNotNull()).select(key, value).repartitionByRange(value, key).sortWithinPartitions(value, key)
    placed = placed.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    from ..session import cut

    placed = cut(placed)  # the partitions must not change between the two uses
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.select(F.col("_p"), (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_all"))  # one row a partition
    rank = F.col("_start") + F.col("_i") - F.shiftleft(F.col("_p").cast("long"), 33) + 1
    return placed.join(F.broadcast(starts), "_p").select(key, value, rank.alias("rank"), (rank / F.col("_all")).alias("ecdf"))


@F.pandas_udf(T.DoubleType())
def normal_quantile(p: pd.Series) -> pd.Series:
    d = NormalDist()
    return p.map(lambda v: d.inv_cdf(v) if 0 < v < 1 else None)


def normal_plot(df: DataFrame, value: str, key: str) -> DataFrame:
    """Each value beside the normal quantile of its rank (Filliben's medians)."""
    ranked = ecdf(df, value, key)
    n = ranked.agg(F.max("rank")).first()[0] or 1
    last = 0.5 ** (1.0 / n)
    p = F.when(F.col("rank") == 1, 1 - last).when(F.col("rank") == n, last).otherwise((F.col("rank") - 0.3175) / (n + 0.365))
    return ranked.select(key, value, "rank", normal_quantile(p).alias("theoretical"))


def error_ranges(df: DataFrame, actual: str, predicted: str, edges: list[float]) -> DataFrame:
    """Mean absolute error and rows by range of the actual value, empty ranges included."""
    ranges = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "range int, low double, high double")
    at = F.when(F.lit(False), 0)
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        at = at.when((F.col(actual) >= a) & (F.col(actual) < b), i)
    errors = df.groupBy(at.alias("range")).agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mae"), F.count("*").alias("n"))
    return ranges.join(errors, "range", "left").select("range", "low", "high", F.coalesce("mae", F.lit(0.0)).alias("mae"), F.coalesce("n", F.lit(0)).alias("n"))


def binned_median(df: DataFrame, by: str, value: str, bins: int = 30, least: int = 6) -> DataFrame:
    """Median of value in percentile bins of by (closed on the left) that have enough rows."""
    edges = quantiles(df, by, [i / bins for i in range(bins + 1)]) or []
    at = sum((F.when(F.col(by) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return df.filter(F.col(by).isNotNull()).groupBy(at.alias("bin")).agg(F.median(value).alias("median"), F.count("*").alias("n")).filter(F.col("n") >= least)


def fit_quality(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error and the share of variance explained."""
    e = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(e)).alias("mae"), (1 - F.try_divide(F.sum(e * e), F.var_pop(actual) * F.count(actual))).alias("r2"))


def sampled(df: DataFrame, key: str, most: int, seed: int = 42) -> DataFrame:
    """A sample of fixed size that reruns agree on: the rows with the least hashes."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)


def capped(df: DataFrame, value: str, share: float = 0.95) -> DataFrame:
    return df.withColumn(f"{value}_capped", F.least(F.col(value), F.lit((quantiles(df, value, [share]) or [None])[0])))


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("n"))


def scorecard(df: DataFrame, checks: dict[str, Column], warn: float = 5.0) -> DataFrame:
    """check, n and share of rows that fail it, and a status: ok, warn (below the share) or bad."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(c).alias(k) for k, c in checks.items()])
    out = counts.unpivot(["_n"], list(checks), "check", "n_failed")
    pct = F.col("n_failed") * 100 / F.col("_n")
    return out.select("check", "n_failed", pct.alias("pct"), F.when(F.col("n_failed") == 0, "ok").when(pct < warn, "warn").otherwise("bad").alias("status"))


def info(df: DataFrame) -> DataFrame:
    """at, column, type and number of values: what a table holds, at a glance."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    kinds = df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], "at int, column string, type string")
    return kinds.join(long_form(filled, "name", "n_filled"), F.col("column") == F.col("name")).select("at", "column", "type", "n_filled")


def describe_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row a column: count, unique, top and freq of its values, and for numbers mean, std, least, quartiles and most.

    Of values as frequent the least, as text, is the top one.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name in columns]
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value").filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("less"), "value"))
    out = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count("*").alias("unique"), top.alias("t"))
    out = out.select("column", "count", "unique", F.col("t.value").alias("top"), (-F.col("t.less")).alias("freq"))
    shape = "column string, mean double, std double, least double, q1 double, median double, q3 double, most double"
    rows = []
    for c in numeric:
        s = summary(df, c).first()
        rows.append((c, *[None if s[k] is None else float(s[k]) for k in ("mean", "std", "low", "q1", "median", "q3", "high")]))
    return out.join(df.sparkSession.createDataFrame(rows, shape), "column", "left")


def histogram_edges(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """bin (from 0) and n between given edges: closed on the left, the last bin on both sides; values beyond are left out."""
    at = F.when(F.lit(False), 0)
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        at = at.when((F.col(value) >= a) & ((F.col(value) < b) if i < len(edges) - 2 else (F.col(value) <= b)), i)
    return df.groupBy(at.alias("bin")).agg(F.count("*").alias("n")).filter("bin is not null").orderBy("bin")


def log_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """The histogram of the decimal logarithms of positive values."""
    return histogram(df.filter(F.col(value) > 0).select(F.log10(value).alias("_log")), "_log", bins)


def gap_analysis(df: DataFrame, low: str, high: str, wide: float = 5) -> DataFrame:
    """Of rows with both values: how many, with the larger first, equal, far apart; and the summary of the differences."""
    both = df.filter(F.col(low).isNotNull() & F.col(high).isNotNull()).select((F.col(high) - F.col(low)).cast("double").alias("_diff"))
    d = F.col("_diff")
    counts = both.agg(F.count("*").alias("n"), F.count_if(d < 0).alias("n_reversed"), F.count_if(d == 0).alias("n_equal"), F.count_if(d > wide).alias("n_wide"))
    return counts.crossJoin(F.broadcast(summary(both, "_diff").drop("n", "p95", "p99")))  # one row each


def training_estimate(df: DataFrame, target: str, limits: tuple[float, float], present: str, helpers: dict[str, Column]) -> DataFrame:
    """name and n: rows to train on (target within limits, `present` not null), rows to predict, and of the former those that have each helper."""
    train = F.coalesce(F.col(target).between(*limits) & F.col(present).isNotNull(), F.lit(False))
    return condition_counts(df, {"train": train, "predict": ~train} | {f"train_with_{k}": train & F.coalesce(c, F.lit(False)) for k, c in helpers.items()})


@F.pandas_udf(T.StringType())
def validity(wkt: pd.Series) -> pd.Series:
    """Why a geometry is not valid, or that it is."""
    return pd.Series([kernel.reason(w) for w in wkt], dtype="object")


def validity_rate(df: DataFrame, wkt: str, key: str, most: int = 10_000) -> DataFrame:
    """reason and n over a sample of geometries of fixed size, which reruns agree on."""
    return sampled(df.filter(F.col(wkt).isNotNull()), key, most).select(validity(wkt).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def geometry_profile(df: DataFrame, wkt: str) -> DataFrame:
    """One row: texts, those that can't be read, kinds, parts, areas in square degrees, the centroids' range and how many lie in the city's box."""
    geom = F.col("g")
    x, y = G.centroid(geom)
    each = df.select(F.col(wkt).alias("w"), G.parsed(F.col(wkt)).alias("g")).select("w", "g", G.kind(geom).alias("kind"), G.area(geom).alias("area"), G.part_count(geom).alias("parts"), x.alias("x"), y.alias("y"))
    inside = F.col("x").between(*R.LONGITUDE) & F.col("y").between(*R.LATITUDE)
    return each.agg(
        F.count("w").alias("n"), F.count_if(F.col("w").isNotNull() & F.col("g").isNull()).alias("n_unread"), F.count_if(F.col("kind") == "Polygon").alias("n_polygon"),
        F.count_if(F.col("kind") == "MultiPolygon").alias("n_multi"), F.max("parts").alias("most_parts"), F.min("area").alias("least_area"), F.max("area").alias("most_area"),
        F.min("x").alias("west"), F.max("x").alias("east"), F.min("y").alias("south"), F.max("y").alias("north"), F.count_if(inside).alias("n_inside"),
    )
