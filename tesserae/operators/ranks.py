"""Order statistics without one task for all rows: values are partitioned by range, and partitions know how many stand before them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Up to so many rows one task takes the quantiles.
SORTABLE = 1_000_000


def sequential(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """df with its rows numbered 0 .. n - 1 in the order of columns that tell all rows apart."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(placed.withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))  # the partitions must not change between the two uses
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_start"))  # one row a partition
    number = F.col("_start") + F.col("_i") - F.shiftleft(F.col("_p").cast("long"), 33)
    return placed.join(F.broadcast(starts), "_p").withColumn(out, number).drop("_p", "_i", "_start")


def quantiles(df: DataFrame, value: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles, linear between neighbours; None without values.

    Beyond SORTABLE rows equal values are counted, the distinct ones stand in range partitions, and only those that hold a
    rank in question come to the driver.
    """
    rows = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    n = rows.count()
    if not n:
        return None
    if n <= SORTABLE:
        return list(rows.agg(F.percentile("v", F.array(*map(F.lit, shares)))).first()[0])
    placed = cut(rows.groupBy("v").agg(F.count("*").alias("n")).repartitionByRange("v").withColumn("p", F.spark_partition_id()))
    sizes = placed.groupBy("p").agg(F.sum("n").alias("m"))
    starts = sizes.select("p", (F.sum("m").over(Window.orderBy("p")) - F.col("m")).alias("start"))  # one row a partition
    ends = placed.join(F.broadcast(starts), "p").withColumn("end", F.col("start") + F.sum("n").over(Window.partitionBy("p").orderBy("v")))
    at = [s * (n - 1) for s in shares]
    wanted = sorted({r for a in at for r in (math.floor(a), math.ceil(a))})
    holds = F.exists(F.array(*map(F.lit, wanted)), lambda r: (r >= F.col("end") - F.col("n")) & (r < F.col("end")))
    found = sorted((r["end"], r["v"]) for r in ends.filter(holds).select("end", "v").collect())  # two rows a share at most
    value_at = lambda r: next(v for end, v in found if r < end)
    return [value_at(math.floor(a)) + (a - math.floor(a)) * (value_at(math.ceil(a)) - value_at(math.floor(a))) for a in at]
