"""Matching two sets of footprints: candidate pairs, scores, edges, components, refinement, representative choice, fusion."""

from __future__ import annotations

import math
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernel
from ..functions.address import normalised
from .graph import components
from .spatial import boxes_that_meet

#: Thresholds of edges, refinement and the choice between sources.
MARGIN, GAP = 0.03, 3.0


@F.pandas_udf(T.DoubleType())
def common_area(a: pd.Series, b: pd.Series) -> pd.Series:
    """Area that two geometries (WKT) share. Arrow batches; there is no built-in overlay."""
    return pd.Series(kernel.intersection_areas(kernel.from_wkts(a), kernel.from_wkts(b)), dtype="float64")


@F.pandas_udf(T.DoubleType())
def gap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([kernel.distance(kernel.from_wkt(x), kernel.from_wkt(y)) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def united(parts: pd.Series) -> pd.Series:
    """The union of each row's list of WKT."""
    read = iter(kernel.from_wkts(w for ws in parts for w in ws))
    out = kernel.unions([list(islice(read, len(ws))) for ws in parts])
    return pd.Series([kernel.to_wkt(g) if g else None for g in out], dtype="object")


def box_overlap() -> Column:
    """Common area of two axis-parallel rectangles with columns as boxes_that_meet() gives them."""
    width = F.least("a_xmax", "b_xmax") - F.greatest("a_xmin", "b_xmin")
    height = F.least("a_ymax", "b_ymax") - F.greatest("a_ymin", "b_ymin")
    return (F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))).cast("double")


def candidates(a: DataFrame, b: DataFrame, cell: float, overlap: Column | None = None) -> DataFrame:
    """Pairs with inter_area, areas and centroid distance; sides have idx, box, area, cx, cy and, without overlap, wkt."""
    carry = ["area", "px", "py"] + (["wkt"] if overlap is None else [])
    pairs = boxes_that_meet(a, b, cell)
    left = a.select(F.col("idx").alias("a_idx"), *[F.col(c).alias(f"{c}_a") for c in carry])
    right = b.select(F.col("idx").alias("b_idx"), *[F.col(c).alias(f"{c}_b") for c in carry])
    joined = pairs.join(left.hint("merge"), "a_idx").join(right.hint("merge"), "b_idx")
    shared = common_area("wkt_a", "wkt_b") if overlap is None else overlap
    dist = F.hypot(F.col("px_a") - F.col("px_b"), F.col("py_a") - F.col("py_b"))
    return joined.select("a_idx", "b_idx", shared.alias("inter_area"), "area_a", "area_b", dist.alias("centroid_dist"))


def or_zero(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def scored(pairs: DataFrame) -> DataFrame:
    """Overlap measures and the score of each pair."""
    inter, a, b = F.col("inter_area"), F.col("area_a"), F.col("area_b")
    out = pairs.withColumns({"iou": or_zero(inter, a + b - inter), "cover_a": or_zero(inter, a), "cover_b": or_zero(inter, b)})
    least, most = F.least("area_a", "area_b"), F.greatest("area_a", "area_b")
    out = out.withColumns(
        {
            "size_ratio": or_zero(least, most),
            "max_cover": F.greatest("cover_a", "cover_b"),
            "min_cover": F.least("cover_a", "cover_b"),
            "small_eq_radius": F.greatest(F.sqrt(least / math.pi), F.lit(1.0)),
        }
    )
    out = out.withColumn("centroid_dist_norm", F.col("centroid_dist") / F.col("small_eq_radius"))
    close = F.greatest(F.least(1 - F.col("centroid_dist_norm") / 3, F.lit(1.0)), F.lit(0.0))
    return out.withColumn("score", 0.45 * F.col("iou") + 0.25 * F.col("max_cover") + 0.20 * F.col("size_ratio") + 0.10 * close)


def passing(pairs: DataFrame) -> DataFrame:
    strong = "iou >= 0.18 or (max_cover >= 0.85 and size_ratio >= 0.20 and centroid_dist_norm <= 2)"
    weak = "score >= 0.40 and size_ratio >= 0.10 and centroid_dist_norm <= 3"
    return pairs.filter(f"({strong}) or ({weak})")


def ranks(pairs: DataFrame, *within: str) -> DataFrame:
    """Dense ranks by score on either side, within groups."""
    rank = lambda side: F.dense_rank().over(Window.partitionBy(*within, side).orderBy(F.desc("score")))
    return pairs.withColumns({"rank_a": rank("a_idx"), "rank_b": rank("b_idx")})


def best_edges(pairs: DataFrame, most: int = 2) -> DataFrame:
    return ranks(passing(pairs)).filter((F.col("rank_a") <= most) & (F.col("rank_b") <= most))


def node(side: str, idx: str) -> Column:
    """Nodes as numbers: those of A are even, those of B odd."""
    return F.col(idx) * 2 + (0 if side == "A" else 1)


def clusters(edges: DataFrame) -> DataFrame:
    """node, side, idx and cluster: the least node of the component."""
    pairs = edges.select(node("A", "a_idx").alias("src"), node("B", "b_idx").alias("dst"))
    return with_sides(components(pairs)).withColumnRenamed("component", "cluster")


def with_sides(nodes: DataFrame) -> DataFrame:
    return nodes.withColumns({"side": F.when(F.col("node") % 2 == 0, "A").otherwise("B"), "idx": F.floor(F.col("node") / 2)})


def component_types(members: DataFrame, by: list[str]) -> DataFrame:
    """Counts of each side, and the kind of component."""
    counts = members.groupBy(*by).agg(F.count_if(F.col("side") == "A").alias("n_A"), F.count_if(F.col("side") == "B").alias("n_B"), F.count("*").alias("n_nodes"))
    return counts.withColumn("comp_type", comp_type(F.col("n_A"), F.col("n_B")))


def comp_type(a: Column, b: Column, refined: bool = False) -> Column:
    """Refined groups of one side keep the names that the plain rules give them."""
    out = F.when((a == 1) & (b == 1), "1x1")
    if not refined:
        out = out.when((a == 0) | (b == 0), "single_source")
    return out.when(a == 1, "1xN").when(b == 1, "Nx1").otherwise("NxN")


def suspicious(kinds: DataFrame, overlaps: DataFrame) -> DataFrame:
    """kinds with suspicious; overlaps has cluster, iou, support_a and support_b of the sides' unions."""
    doubt = (F.col("iou") < 0.35) | (F.least("support_a", "support_b") < 0.55)
    flag = F.when(F.col("comp_type") == "1x1", F.lit(False)).when(F.col("n_nodes") >= 4, F.lit(True)).otherwise(F.coalesce(doubt, F.lit(False)))
    return kinds.join(overlaps, "cluster", "left").withColumn("suspicious", flag).drop("iou", "support_a", "support_b")


def refined_edges(edges: DataFrame) -> DataFrame:
    """Within each cluster, the edges that both sides rank first, or that are strong or cover well. Ranks are taken anew."""
    local = ranks(edges, "cluster")
    mutual = (F.col("rank_a") == 1) & (F.col("rank_b") == 1)
    strong = (F.col("score") >= 0.55) & (F.col("iou") >= 0.20) & (F.col("centroid_dist_norm") <= 1.5)
    covered = (F.col("max_cover") >= 0.85) & (F.col("size_ratio") >= 0.60)
    return local.filter(mutual | strong | covered)


def adjacent(members: DataFrame, near: Column) -> DataFrame:
    """Pairs src, dst of one side of a cluster that are near; members have cluster, side, node and what near reads as x_*, y_*."""
    columns = [c for c in members.columns if c not in ("cluster", "side")]
    x = members.select("cluster", "side", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = members.select("cluster", "side", *[F.col(c).alias(f"y_{c}") for c in columns])
    return x.join(y, ["cluster", "side"]).filter((F.col("x_node") < F.col("y_node")) & near).select(F.col("x_node").alias("src"), F.col("y_node").alias("dst"))


def buildings(members: DataFrame, kinds: DataFrame, kept: DataFrame, near: DataFrame) -> DataFrame:
    """node, side, idx, building (its least node), parent_cluster and split_from_parent.

    Clusters that aren't suspicious stay whole; the others fall into the components of kept and near edges.
    """
    doubtful = kinds.filter("suspicious").select("cluster")
    inside = members.join(doubtful, "cluster", "left_semi")
    edges = kept.select(node("A", "a_idx").alias("src"), node("B", "b_idx").alias("dst")).union(near.select("src", "dst"))
    parts = components(edges, nodes=inside.select("node")).withColumnRenamed("component", "building")
    split = inside.join(parts, "node")
    whole = members.join(doubtful, "cluster", "left_anti").withColumn("building", F.col("cluster"))
    out = whole.withColumn("split_from_parent", F.lit(0)).unionByName(split.withColumn("split_from_parent", F.lit(1)))
    return out.withColumnRenamed("cluster", "parent_cluster")


def representative(groups: DataFrame) -> DataFrame:
    """repr_source and the scores, from n_a, n_b, detail sums c_a and c_b, iou_ab, supports and the median area ratio of A."""
    n_a, n_b, c_a, c_b = (F.col(c) for c in ("n_a", "n_b", "c_a", "c_b"))
    total = c_a + c_b
    d_a = F.when(total > 0, c_a / total).otherwise(0.5)
    d_b = F.when(total > 0, c_b / total).otherwise(0.5)
    f_a, f_b = F.greatest(n_a - 1, F.lit(0)), F.greatest(n_b - 1, F.lit(0))
    fn = f_a + f_b + 1
    ratio = F.col("area_ratio_a")
    penalty = F.when(ratio > 0, F.least(F.abs(F.ln(ratio)), F.lit(2.0)) / 2).otherwise(0.0)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = (n_a > 0) & (n_b > 0)
    score_a = 0.35 * d_a + 0.30 * zero("support_a") + 0.20 * zero("iou_ab") + 0.10 * (1 - f_a / fn) + 0.05 * (1 - penalty)
    score_b = 0.35 * d_b + 0.30 * zero("support_b") + 0.20 * zero("iou_ab") + 0.10 * (1 - f_b / fn)
    out = groups.withColumns(
        {
            "score_a": F.when(both, score_a).when(n_a > 0, 1.0),
            "score_b": F.when(both, score_b).when(n_b > 0, 1.0),
            "detail_a": F.when(both, d_a),
            "detail_b": F.when(both, d_b),
        }
    )
    a, b = F.col("score_a"), F.col("score_b")
    source = F.when(n_a == 0, "B_only").when(n_b == 0, "A_only").when(a > b + MARGIN, "A").when(b > a + MARGIN, "B").when(c_a >= c_b, "A_tie").otherwise("B_tie")
    return out.withColumn("repr_source", source)


def mode_first(df: DataFrame, keys: list[str], value: str, order: str, out: str) -> DataFrame:
    """The most frequent value of each group that is neither null nor blank; of equals the one met first by order."""
    counts = df.filter(F.col(value).isNotNull() & (F.trim(F.col(value).cast("string")) != "")).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("n", (-F.col("at")).alias("at"))).alias(out))


def fused(members: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """One record a building from its members (node, side, idx, building) and the sides' cleaned rows (by idx, with wkt)."""
    members = members.withColumnRenamed("building", "building_id")  # B has a column building, a part of addresses
    ma = members.filter("side = 'A'").join(a, "idx").select("building_id", "idx", *[F.col(c).alias(f"{c}_A") for c in a.columns if c != "idx"])
    mb = members.filter("side = 'B'").join(b, "idx").select("building_id", "idx", *[F.col(c).alias(f"{c}_B") for c in b.columns if c != "idx"])
    ids = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.col(c).cast("string").alias("id")))), lambda s: s.getField("id")), ",")
    # members of a building are few: a cluster is bounded by ranks of two on either side and by the places around it
    ga = ma.groupBy("building_id").agg(
        F.count("*").alias("n_a"), F.sum("geom_complexity_A").alias("c_a"), F.median("area_geom_ratio_A").alias("area_ratio_a"), ids("id_A").alias("a_source_ids"),
        F.median("floor_mid_A").alias("floor_mid_A_median"), F.max("geom_complexity_A").alias("cx_a"), F.max("geom_part_count_A").alias("pc_a"), F.collect_list("wkt_A").alias("wkts_a"),
    )
    gb = mb.groupBy("building_id").agg(
        F.count("*").alias("n_b"), F.sum("geom_complexity_B").alias("c_b"), ids("idx").alias("b_source_ids"), F.median("height_B").alias("height_B_median"), F.median("stairs_B").alias("stairs"),
        F.median("avg_floor_height_clean_B").alias("avg_floor_height_clean"), F.max("geom_complexity_B").alias("cx_b"), F.max("geom_part_count_B").alias("pc_b"), F.collect_list("wkt_B").alias("wkts_b"),
    )
    ga = ga.withColumn("geom_a", united("wkts_a")).drop("wkts_a")
    gb = gb.withColumn("geom_b", united("wkts_b")).drop("wkts_b")
    parents = members.groupBy("building_id").agg(F.first("parent_cluster").alias("parent_cluster_id"), F.first("split_from_parent").alias("split_from_parent"))
    joined = parents.join(ga, "building_id", "left").join(gb, "building_id", "left")
    joined = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_a", "n_b", "c_a", "c_b")})
    shared = F.when(F.col("geom_a").isNotNull() & F.col("geom_b").isNotNull(), common_area("geom_a", "geom_b"))
    from ..functions import geometry as G

    size = lambda c: F.when(F.col(c).isNotNull(), G.area(G.parsed(F.col(c))))
    joined = joined.withColumns({"shared": shared, "size_a": size("geom_a"), "size_b": size("geom_b")})
    joined = joined.withColumns(
        {
            "iou_ab": F.try_divide("shared", F.col("size_a") + F.col("size_b") - F.col("shared")),
            "support_a": F.try_divide("shared", "size_a"),
            "support_b": F.try_divide("shared", "size_b"),
        }
    )
    out = representative(joined)
    from_a = F.startswith("repr_source", F.lit("A"))
    wkt = F.when(from_a, F.col("geom_a")).otherwise(F.col("geom_b"))
    shape = G.parsed(F.col("repr_geometry_wkt"))
    out = out.withColumn("repr_geometry_wkt", wkt)
    x, y = G.centroid(shape)
    out = out.withColumns({"repr_area_m2": G.area(shape), "repr_centroid_x": x, "repr_centroid_y": y, "comp_type": comp_type(F.col("n_a"), F.col("n_b"), True)})
    out = out.withColumns({"geom_complexity": F.when(from_a, F.col("cx_a")).otherwise(F.col("cx_b")), "geom_part_count": F.when(from_a, F.col("pc_a")).otherwise(F.col("pc_b"))})
    for name, rows, column in (("floor_band", mb, "floor_band_B"), ("is_height_valid", mb, "is_height_valid_B"), ("height_source", mb, "height_source_B"), ("purpose_category_B_mode", mb, "purpose_category_B"), ("category_A_mode", ma, "category_A")):
        out = out.join(mode_first(rows, ["building_id"], column, "idx", name), "building_id", "left")
    address = mode_first(ma.withColumn("address", normalised(F.col("gkh_address_A"))), ["building_id"], "address", "idx", "addr_norm")
    out = out.join(address, "building_id", "left")
    return out.drop("geom_a", "geom_b", "shared", "size_a", "size_b", "c_a", "c_b", "cx_a", "cx_b", "pc_a", "pc_b", "area_ratio_a").withColumn("n_nodes", F.col("n_a") + F.col("n_b"))
