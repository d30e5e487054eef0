"""Features of fused buildings: shape, place, neighbours, categories."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import kernel
from ..functions import rules as R
from .ranks import quantiles
from .spatial import densities, nearest_distance, neighbour_statistics, within_radius

#: The centre that distances are taken to, and the radii of densities.
CENTRE = (328_800, 6_641_000)
RADII = [50.0, 100.0, 150.0, 200.0]
TARGET = "height_B_median"

#: Candidate features of the model, in order.
CANDIDATES = [
    "area_m2", "log_area", "perimeter_m", "npi", "bbox_length", "bbox_width",
    "bbox_ratio", "bbox_fill_ratio", "total_vertices", "geom_parts",
    "centroid_x", "centroid_y", "dist_to_center", "nearest_neighbor_dist",
    "mean_height_100m", "median_height_100m", "p75_height_100m",
    "std_height_100m", "height_range_100m", "count_nbrs_100m",
    "kde_50m", "kde_100m", "kde_150m", "kde_200m", "mean_height_by_zone",
    "avg_floor_height", "floor_mid_A", "floor_band_enc",
    "purpose_B_enc", "category_A_enc", "is_residential", "is_industrial_height",
    "height_source_enc", "has_height", "n_sources", "iou_ab_clean", "detail_ratio",
    "area_floor_product", "log_area_floor_product", "stairs_clean", "height_from_stairs",
    "floor_height_ratio", "area_per_section", "log_perimeter", "convexity",
]

SHAPE = T.StructType([T.StructField(c, T.DoubleType()) for c in ("bbox_length", "bbox_width", "bbox_ratio", "bbox_fill_ratio", "convexity")])


@F.pandas_udf(SHAPE)
def shape(wkt: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(kernel.shapes(wkt), columns=["bbox_length", "bbox_width", "bbox_ratio", "bbox_fill_ratio", "convexity"], dtype="float64")


def geometric(df: DataFrame) -> DataFrame:
    area = F.col("repr_area_m2")
    geom = G.parsed(F.col("repr_geometry_wkt"))
    df = df.withColumns({"area_m2": area, "log_area": F.log1p(R.clipped(area, 0.0)), "total_vertices": F.col("geom_complexity"), "geom_parts": R.clipped(F.col("geom_part_count"), 1)})
    df = df.withColumn("perimeter_m", F.when(area > 0, G.perimeter(geom))).withColumn("_shape", shape("repr_geometry_wkt")).select("*", "_shape.*").drop("_shape")
    return df.withColumns({"area_per_section": F.try_divide("area_m2", "geom_parts"), "npi": G.compactness(area, F.col("perimeter_m")), "log_perimeter": F.log1p("perimeter_m")})


def quantile_zones(df: DataFrame, value: str, parts: int = 5, out: str = "zone") -> DataFrame:
    """The number of the quantile interval (left open, the first closed), from exact linear quantiles; equal edges are one."""
    edges = list(dict.fromkeys(quantiles(df, value, [i / parts for i in range(parts + 1)]) or ()))
    if not edges:
        return df.withColumn(out, F.lit(None).cast("int"))
    chain: Column = F.when(F.col(value).isNull() | (F.col(value) < edges[0]), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:]):
        chain = chain.when(F.col(value) <= e, i)
    return df.withColumn(out, chain)


def spatial(df: DataFrame, key: str = "building_id", target: str = TARGET) -> DataFrame:
    """Distances, densities and statistics of neighbours. One grid join at the largest radius serves all of them."""
    df = df.withColumns({"centroid_x": F.col("repr_centroid_x"), "centroid_y": F.col("repr_centroid_y")})
    df = df.withColumn("dist_to_center", F.hypot(F.col("centroid_x") - CENTRE[0], F.col("centroid_y") - CENTRE[1]))
    points = df.select(F.col(key).alias("idx"), F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"), F.col(target).alias("v")).filter("x is not null")
    pairs = within_radius(points, max(RADII), "v").persist()
    near = nearest_distance(points, max(RADII)).withColumnRenamed("nearest", "nearest_neighbor_dist")
    stats = neighbour_statistics(pairs, points, "v", 100.0)
    stats = stats.select("idx", *[F.col(c).alias(n) for c, n in (("mean_value", "mean_height_100m"), ("median_value", "median_height_100m"), ("p75_value", "p75_height_100m"), ("std_value", "std_height_100m"), ("range_value", "height_range_100m"), ("n_neighbours", "count_nbrs_100m"))])
    kde = densities(pairs, points, RADII)
    kde = kde.select("idx", *[F.col(f"kde_{r:g}").alias(f"kde_{r:g}m") for r in RADII])
    zones = quantile_zones(df, "dist_to_center")
    means = zones.groupBy("zone").agg(F.avg(target).alias("mean_height_by_zone"))
    out = zones.join(means, "zone", "left").drop("zone")
    for side in (near, stats, kde):
        out = out.join(side.withColumnRenamed("idx", key), key, "left")
    return out


def categorical(df: DataFrame, target: str = TARGET) -> DataFrame:
    floors, each = R.clipped(F.col("stairs"), 1, 100), R.clipped(F.col("avg_floor_height_clean"), 2, 15)
    df = df.withColumns({"stairs_clean": floors, "avg_floor_height": each, "floor_mid_A": R.clipped(F.col("floor_mid_A_median"), 1, 100)})
    usual = F.coalesce("avg_floor_height", F.lit(3.0))
    area = F.col("area_m2") * F.coalesce("stairs_clean", F.lit(1))
    home = (F.col("purpose_category_B_mode") == "Жилое", F.col("category_A_mode") == "Жилое")
    return df.withColumns(
        {
            "height_from_stairs": F.col("stairs_clean") * F.col("avg_floor_height"),
            "floor_band_enc": R.encoded(F.col("floor_band"), R.FLOOR_BAND_CODES) if "floor_band" in df.columns else R.band_code(floors),
            "purpose_B_enc": R.encoded(F.col("purpose_category_B_mode"), R.PURPOSE_CODES),
            "category_A_enc": R.encoded(F.col("category_A_mode"), R.CATEGORY_CODES),
            "height_source_enc": R.encoded(F.col("height_source"), R.HEIGHT_SOURCE_CODES, 0),
            "is_residential": F.greatest(R.flag(home[0]), R.flag(home[1])),
            "is_industrial_height": R.flag(usual > 4),
            "has_height": R.flag(F.col(target).isNotNull()),
            "n_sources": R.flag(F.col("n_a") > 0) + R.flag(F.col("n_b") > 0),
            "iou_ab_clean": F.coalesce("iou_ab", F.lit(0.0)),
            "detail_ratio": F.try_divide(F.col("detail_a"), F.col("detail_a") + F.col("detail_b")),
            "floor_height_ratio": usual / 3,
            "area_floor_product": area,
            "log_area_floor_product": F.log1p(area),
        }
    )


def all_features(df: DataFrame) -> DataFrame:
    return categorical(spatial(geometric(df)))


