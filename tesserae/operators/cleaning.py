"""The two sources' cleaning: stateless rules as projections and filters, after the keyed removal of duplicates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import kernel
from ..functions import rules as R
from ..functions.address import address_key
from ..session import once
from .dedupe import keep_first_in_turn


#: The columns of cleaned tables, in order; those that a table lacks are left out.
KEPT_A = [
    "id", "title", "geometry_clean", "area_sq_m", "geom_area_approx_m2", "area_geom_ratio", "tags", "tags_parsed", "primary_tag", "category",
    "tag_count", "gkh_address", "has_gkh_address", "gkh_floor_count_min", "gkh_floor_count_max", "has_gkh_floors", "floor_range", "floor_mid",
    "geom_type", "geom_part_count", "geom_complexity", "is_multipolygon", "centroid_lon", "centroid_lat",
]
KEPT_B = [
    "geometry_clean", "geom_type", "geom_part_count", "geom_complexity", "is_multipolygon", "centroid_lon", "centroid_lat", "geom_area_approx_m2",
    "subject", "district", "type", "locality", "type_street", "name_street", "number", "letter", "fraction", "housing", "building", "addr_full",
    "has_full_address", "purpose_of_building", "purpose_category", "stairs", "is_stairs_valid", "avg_floor_height", "avg_floor_height_clean",
    "is_industrial_height", "height", "is_height_valid", "height_from_stairs", "height_consistency_ratio", "heights_inconsistent",
    "height_source", "height_per_floor", "log_height", "floor_band",
]


def pruned(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns that df has, and the row id, by which sources are joined."""
    return df.select("row_id", *[c for c in names if c in df.columns])


@F.pandas_udf(T.StringType())
def repaired(wkt: pd.Series) -> pd.Series:
    """Geometries whose rings cross are made valid; those without area become null. Only doubtful ones change."""
    read = kernel.from_wkts(wkt)

    def fix(w, g, simple):
        if g is None or simple:
            return None if g is None else w
        g = kernel.repaired(g)
        return kernel.to_wkt(g) if g else None

    return pd.Series([fix(*x) for x in zip(wkt, read, kernel.are_simple(read))], dtype="object")


def with_geometry(df: DataFrame, wkt: str) -> DataFrame:
    """Rows with a valid geometry in the city's box, with geometry_clean and its measures in degrees."""
    df = once(df.withColumn("geometry_clean", repaired(F.col(wkt))), geom=G.parsed(F.col("geometry_clean"))).filter("geom is not null")
    lon, lat = G.centroid(F.col("geom"))
    df = once(df, centroid_lon=F.round(lon, 6), centroid_lat=F.round(lat, 6))
    df = df.filter(F.col("centroid_lon").between(*R.LONGITUDE) & F.col("centroid_lat").between(*R.LATITUDE))
    geom = F.col("geom")
    return df.withColumns(
        {
            "geom_type": G.kind(geom),
            "geom_part_count": G.part_count(geom),
            "geom_complexity": G.complexity(geom),
            "is_multipolygon": R.flag(F.size("geom") > 1),
            "geom_area_approx_m2": G.approx_m2(G.area(geom)),
        }
    ).drop("geom")


def clean_a(raw: DataFrame) -> DataFrame:
    """Source A: id, tags, geometry, area_sq_m, gkh_address and floor counts, with row_id in file order."""
    data = [c for c in raw.columns if c != "row_id"]
    df = keep_first_in_turn(raw, [data, *[[k] for k in ("id", "geometry") if k in data]], "row_id")
    # the scalar filters come before anything that reads geometries
    df = df.withColumn("area_sq_m", R.number(F.col("area_sq_m"))).filter(F.col("area_sq_m").between(*R.AREA))
    df = df.withColumn("tags_parsed", R.tags(F.col("tags")))
    df = df.withColumns({"tag_count": F.size("tags_parsed"), "primary_tag": F.coalesce(F.get("tags_parsed", F.lit(0)), F.lit("неизвестно"))})
    df = df.withColumn("category", R.tag_category(F.col("primary_tag"))).filter(~((F.col("category") == "Постройка/сооружение") & (F.col("area_sq_m") < 50)))
    low, high = (R.within(R.number(F.col(f"gkh_floor_count_{x}")), *R.FLOORS) for x in ("min", "max"))
    df = df.withColumns({"_low": low, "_high": high})
    low, high = R.ordered_pair(F.col("_low"), F.col("_high"))
    df = df.withColumns({"gkh_floor_count_min": low, "gkh_floor_count_max": high}).drop("_low", "_high")
    low, high = F.col("gkh_floor_count_min"), F.col("gkh_floor_count_max")
    df = df.withColumns({"has_gkh_floors": R.flag(low.isNotNull() | high.isNotNull()), "floor_range": high - low, "floor_mid": R.middle(low, high), "has_gkh_address": R.flag(F.col("gkh_address").isNotNull())})
    df = with_geometry(df, "geometry")
    df = df.withColumn("area_geom_ratio", F.try_divide("area_sq_m", F.nullif("geom_area_approx_m2", F.lit(0.0))))
    return pruned(df, KEPT_A)


def clean_b(raw: DataFrame) -> DataFrame:
    """Source B: split address, purpose, stairs, floor height, height and wkt, with row_id in file order."""
    data = [c for c in raw.columns if c != "row_id"]
    df = keep_first_in_turn(raw, [data, ["wkt"]], "row_id")
    numbers = {c: R.number(F.col(c)) for c in ("stairs", "avg_floor_height", "height")}
    df = df.withColumns(numbers)
    df = df.withColumns({"stairs": R.within(F.col("stairs"), *R.FLOORS), "avg_floor_height": R.within(F.col("avg_floor_height"), *R.FLOOR_HEIGHT), "height": R.within(F.col("height"), *R.HEIGHT)})
    floors, each, height = F.col("stairs"), F.col("avg_floor_height"), F.col("height")
    df = df.withColumns(
        {
            "is_stairs_valid": R.flag(floors.isNotNull()),
            "avg_floor_height_clean": R.within(each, *R.USUAL_FLOOR_HEIGHT),
            "is_industrial_height": R.flag((each > 6) & (each <= 15)),
            "is_height_valid": R.flag(height.isNotNull()),
            "height_from_stairs": R.height_from_floors(floors, each),
        }
    )
    df = df.withColumn("height_consistency_ratio", R.consistency_ratio(height, F.col("height_from_stairs")))
    df = df.withColumn("heights_inconsistent", R.flag(~F.col("height_consistency_ratio").between(*R.CONSISTENT)))
    text = [c for c in ("subject", "district", "type", "locality", "type_street", "name_street", "number", "letter", "fraction", "housing", "building") if c in data]
    # numbers that went through a spreadsheet come as 2.0
    df = df.withColumns({c: F.regexp_replace(R.tidy(F.col(c)), r"^(\d+)\.0$", "$1") for c in text})
    df = df.withColumns(
        {
            "height_source": R.height_source(height, floors, F.col("heights_inconsistent")),
            "purpose_category": R.purpose_category(F.col("purpose_of_building")),
            "addr_full": address_key(*[F.col(c) for c in ("name_street", "number", "housing", "building")]),
            "log_height": F.when(height > 0, F.log1p(height)),
            "height_per_floor": F.when(floors > 0, F.try_divide(height, floors)),
            "floor_band": R.floor_band(floors),
        }
    ).withColumn("has_full_address", R.flag(F.col("addr_full").isNotNull()))
    df = with_geometry(df, "wkt")
    return pruned(df.filter(F.col("geom_area_approx_m2").between(*R.AREA)), KEPT_B)
