"""The whole chain from two CSV files to predicted heights."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address
from ..functions import geometry as G
from ..operators import cleaning, features, learning, matching, profiling
from ..operators.ranks import sequential
from ..session import cut
from ..sources import files


def sided(clean: DataFrame) -> DataFrame:
    """Cleaned rows in metres, with idx (the row id of the scan), box, area, centre and wkt."""
    geom = G.projected(G.parsed(F.col(files.geometry_column(clean))))
    df = clean.withColumn("_g", geom).withColumnRenamed("row_id", "idx")
    x, y = G.centroid(F.col("_g"))
    return df.withColumns({"area": G.area(F.col("_g")), "px": x, "py": y, "wkt": G.written(F.col("_g"))}).select("*", *G.bounds(F.col("_g"))).drop("_g").filter("area > 0")


def matched(a: DataFrame, b: DataFrame, cell: float = 100.0) -> DataFrame:
    """Fused buildings from the two sides."""
    pairs = matching.scored(matching.candidates(a, b, cell))
    edges = cut(matching.best_edges(pairs))
    members = matching.clusters(edges)
    kinds = matching.component_types(members, ["cluster"]).filter("comp_type <> 'single_source'")
    inside = edges.withColumn("node", matching.node("A", "a_idx")).join(members.select("node", "cluster"), "node")
    sides = members.join(a.select(F.lit("A").alias("side"), "idx", "wkt", "area").union(b.select(F.lit("B").alias("side"), "idx", "wkt", "area")), ["side", "idx"])
    # only clusters of three nodes are judged by their unions
    three = sides.join(kinds.filter("n_nodes = 3").select("cluster"), "cluster", "left_semi")
    unions = three.groupBy("cluster").agg(matching.united(F.collect_list(F.when(F.col("side") == "A", F.col("wkt")))).alias("ga"), matching.united(F.collect_list(F.when(F.col("side") == "B", F.col("wkt")))).alias("gb"))
    unions = unions.withColumns({"s": matching.common_area("ga", "gb"), "x": G.area(G.parsed(F.col("ga"))), "y": G.area(G.parsed(F.col("gb")))})
    overlaps = unions.select("cluster", F.try_divide("s", F.col("x") + F.col("y") - F.col("s")).alias("iou"), F.try_divide("s", "x").alias("support_a"), F.try_divide("s", "y").alias("support_b"))
    kinds = cut(matching.suspicious(kinds, overlaps))
    doubtful = kinds.filter("suspicious").select("cluster")
    kept = matching.refined_edges(inside.join(doubtful, "cluster", "left_semi"))
    near = matching.adjacent(sides.join(doubtful, "cluster", "left_semi").select("cluster", "side", "node", "wkt"), matching.gap("x_wkt", "y_wkt") <= matching.GAP)
    out = matching.fused(matching.buildings(members, kinds, kept, near), a, b)
    return sequential(out.withColumnRenamed("building_id", "_node"), ["_node"], "building_id").drop("_node")


def run(spark: SparkSession, a_path: str, b_path: str, out: str, trees: int = 400) -> DataFrame:
    """Stages as Parquet under out, the model and its metadata, and predictions as CSV; returns the predictions."""
    a = address.parse_line(cleaning.clean_a(files.with_id(files.read_csv(spark, a_path))), "gkh_address")
    b = address.parse_parts(cleaning.clean_b(files.read_csv(spark, b_path)))
    a.write.mode("overwrite").parquet(f"{out}/cleaned_a")
    b.write.mode("overwrite").parquet(f"{out}/cleaned_b")
    a, b = (cut(sided(spark.read.parquet(f"{out}/cleaned_{s}"))) for s in "ab")
    matched(a, b).write.mode("overwrite").parquet(f"{out}/buildings")
    features.all_features(spark.read.parquet(f"{out}/buildings")).write.mode("overwrite").parquet(f"{out}/features")
    df = spark.read.parquet(f"{out}/features")
    return learned(spark, df, out, trees)


def learned(spark: SparkSession, df: DataFrame, out: str, trees: int = 400) -> DataFrame:
    """Selection, imputation, a model held out on a fifth of the labelled rows, and predictions for the rest."""
    target = features.TARGET
    labelled = df.filter(F.col(target).isNotNull())
    names = learning.select_features(labelled, features.CANDIDATES, target)
    rates = learning.null_rates(labelled, names)
    fill = learning.medians(labelled, [c for c in names if rates[c] > 0])
    flagged = [c for c in names if rates[c] > learning.FLAG_NULL]
    ready = learning.imputed(df, fill, flagged).na.fill(0.0, names)
    columns = names + [f"{c}_was_nan" for c in flagged]
    held = F.pmod(F.xxhash64("building_id"), F.lit(5)) == 0
    model = learning.fit(ready.filter(F.col(target).isNotNull() & ~held), "building_id", target, columns, trees=trees)
    score = learning.held_out_r2(model, ready.filter(F.col(target).isNotNull() & held), target)
    model.write().overwrite().save(f"{out}/model")
    files.write_metadata(spark, f"{out}/metadata", columns, fill, round(score, 4))
    result = learning.predicted(model, ready.filter(F.col(target).isNull()), "predicted_height_m").select("building_id", "predicted_height_m")
    files.write_csv(result, f"{out}/predictions")
    return result


#: How many labels diagnostics need, and the columns beside the prediction.
LEAST_LABELS = 10
SHOWN = ["building_id", "src_a_id", "src_b_id", "repr_centroid_x", "repr_centroid_y", "centroid_lon", "centroid_lat", features.TARGET]


def aligned(df: DataFrame, columns: list[str], fill: dict[str, float]) -> DataFrame:
    """df with the model's columns: missing ones are null, flags say what was, and medians or zeros fill what is null."""
    flags = [c for c in columns if c.endswith("_was_nan") and c not in df.columns]
    flagged = [c.removesuffix("_was_nan") for c in flags]
    names = [c for c in columns if c not in flags]
    lacking = [c for c in {*names, *flagged} if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("double") for c in lacking})
    return learning.imputed(df, fill, flagged).na.fill(0.0, names)


def predict(spark: SparkSession, buildings: DataFrame, model: str, out: str) -> tuple[DataFrame, DataFrame | None]:
    """Predictions for all rows of a table of features by the model and metadata that learned() has saved, written as CSV; and,
    with more than LEAST_LABELS labels, how well they fit these."""
    meta = files.read_metadata(spark, f"{model}/metadata")
    ready = aligned(buildings, meta["features"], meta["impute_medians"])
    loaded = PipelineModel.load(f"{model}/model")
    shown = [c for c in SHOWN if c in buildings.columns]
    result = learning.predicted(loaded, ready, "predicted_height_m").select(*shown, "predicted_height_m")
    files.write_csv(result, out)
    labelled = result.filter(F.col(features.TARGET).isNotNull()) if features.TARGET in shown else None
    enough = labelled is not None and labelled.limit(LEAST_LABELS + 1).count() > LEAST_LABELS
    return result, profiling.fit_quality(labelled, features.TARGET, "predicted_height_m") if enough else None
