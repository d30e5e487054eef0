"""Joins by place through a grid: bounding boxes that meet, points within a radius, nearest neighbours.

The joins ask for sorted sides: rows dealt to several cells are many times those that Spark takes them for, and it would
send them through the driver as a broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

BOX = ("xmin", "ymin", "xmax", "ymax")


def grid(df: DataFrame, cell: float) -> DataFrame:
    """A row for each grid cell that the box touches."""
    at = lambda c: F.floor(F.col(c) / cell)
    wide = df.withColumn("cx", F.explode(F.sequence(at("xmin"), at("xmax"))))
    return wide.withColumn("cy", F.explode(F.sequence(at("ymin"), at("ymax"))))


def boxes_that_meet(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Pairs a_idx, b_idx (from column idx) whose boxes share a point, each once.

    An equi-join on grid cells; of the cells that a pair shares, the one with the lower left corner of the common box
    counts, so that no distinct is needed.
    """
    a = grid(left.select(F.col("idx").alias("a_idx"), *BOX), cell).select("a_idx", "cx", "cy", *[F.col(c).alias(f"a_{c}") for c in BOX])
    b = grid(right.select(F.col("idx").alias("b_idx"), *BOX), cell).select("b_idx", "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in BOX])
    x, y = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    meets = (x <= F.least("a_xmax", "b_xmax")) & (y <= F.least("a_ymax", "b_ymax"))
    here = (F.floor(x / cell) == F.col("cx")) & (F.floor(y / cell) == F.col("cy"))
    return a.join(b.hint("merge"), ["cx", "cy"]).filter(meets & here).drop("cx", "cy")


def within_radius(points: DataFrame, radius: float, *values: str) -> DataFrame:
    """idx, other, dist and the other's values for all pairs of different rows (idx, x, y) up to the radius apart."""
    cells = points.select("idx", "x", "y", *values, F.floor(F.col("x") / radius).alias("cx"), F.floor(F.col("y") / radius).alias("cy"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    near = cells.select(F.col("idx").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), "cx", "cy", *values, around.alias("d"))
    near = near.select("other", "ox", "oy", *values, (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy"))
    dist = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
    return cells.drop(*values).join(near.hint("merge"), ["cx", "cy"]).filter("idx != other").withColumn("dist", dist).filter(F.col("dist") <= radius).select("idx", "other", "dist", *values)


def nearest_distance(points: DataFrame, start: float, rounds: int = 24) -> DataFrame:
    """idx and nearest: the distance to the closest other row. The radius doubles for rows that have found none."""
    out, left, radius = None, points, start
    for _ in range(rounds):
        # rows in question against all others: one side is dealt to the cells around it
        around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        ask = left.select("idx", "x", "y", F.floor(F.col("x") / radius).alias("gx"), F.floor(F.col("y") / radius).alias("gy"), around.alias("d"))
        ask = ask.select("idx", "x", "y", (F.col("gx") + F.col("d.i")).alias("cx"), (F.col("gy") + F.col("d.j")).alias("cy"))
        every = points.select(F.col("idx").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.floor(F.col("x") / radius).alias("cx"), F.floor(F.col("y") / radius).alias("cy"))
        dist = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
        found = ask.join(every.hint("merge"), ["cx", "cy"]).filter("idx != other").groupBy("idx").agg(F.min(dist).alias("nearest")).filter(F.col("nearest") <= radius)
        found = cut(found)
        out = found if out is None else out.unionByName(found)
        left = cut(left.join(found.hint("merge"), "idx", "left_anti"))
        if not left.limit(1).count():
            break
        radius *= 2
    return points.select("idx").join(out.hint("merge"), "idx", "left")


def densities(pairs: DataFrame, points: DataFrame, radii: list[float]) -> DataFrame:
    """idx and a kde column for each radius: other points within it over the circle's area."""
    counts = pairs.groupBy("idx").agg(*[F.count_if(F.col("dist") <= r).alias(f"n{i}") for i, r in enumerate(radii)])
    joined = points.select("idx").join(counts.hint("merge"), "idx", "left")
    return joined.select("idx", *[(F.coalesce(F.col(f"n{i}"), F.lit(0)) / (math.pi * r * r)).alias(f"kde_{r:g}") for i, r in enumerate(radii)])


def neighbour_statistics(pairs: DataFrame, points: DataFrame, value: str, radius: float) -> DataFrame:
    """idx with mean, median, p75 (with four values or more), deviation and range of the neighbours' values, and their count.

    pairs carry the value of the other row.
    """
    v = F.col(value)
    stats = pairs.filter(F.col("dist") <= radius).groupBy("idx").agg(
        F.avg(v).alias("mean_value"), F.percentile(v, F.array(F.lit(0.5), F.lit(0.75))).alias("q"), F.count(v).alias("n_values"),
        F.stddev_pop(v).alias("std_value"), (F.max(v) - F.min(v)).alias("range_value"), F.count("*").alias("n_neighbours"),
    )
    p75 = F.when(F.col("n_values") >= 4, F.get("q", F.lit(1)))
    stats = stats.select("idx", "mean_value", F.get("q", F.lit(0)).alias("median_value"), p75.alias("p75_value"), "std_value", "range_value", "n_neighbours")
    return points.select("idx").join(stats.hint("merge"), "idx", "left").withColumn("n_neighbours", F.coalesce("n_neighbours", F.lit(0)))
