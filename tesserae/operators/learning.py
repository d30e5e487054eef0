"""Selection of features, imputation, augmentation, and a random forest for missing values."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .forest import Forest
from .ranks import quantiles

#: Thresholds of selection, and weights of rare heights.
MOST_CORRELATED, MOST_NULL, FLAG_NULL = 0.95, 0.80, 0.05
RARE, COPIES, NOISE = 50.0, 3, 0.1

#: Of two features that say the same, the one named earlier here stays.
PREFERRED = [
    "area_m2", "log_area", "area_floor_product", "log_area_floor_product",
    "mean_height_100m", "std_height_100m", "count_nbrs_100m", "kde_150m",
    "avg_floor_height", "bbox_fill_ratio", "floor_height_ratio", "area_per_section",
    "log_perimeter", "convexity", "median_height_100m", "height_range_100m", "kde_100m", "kde_200m",
]

#: Features that augmentation scales.
SCALED = {
    "area_m2", "log_area", "perimeter_m", "npi", "bbox_length", "bbox_width",
    "bbox_ratio", "bbox_fill_ratio", "total_vertices", "geom_parts",
    "area_floor_product", "log_area_floor_product",
}


def correlation(x: Column, y: Column) -> Column:
    """Pearson's, null where either side has no spread."""
    pair = x.isNotNull() & y.isNotNull()
    a, b = F.when(pair, x.cast("double")), F.when(pair, y.cast("double"))
    return F.when((F.stddev_pop(a) > 0) & (F.stddev_pop(b) > 0), F.covar_pop(a, b) / (F.stddev_pop(a) * F.stddev_pop(b)))


def correlations(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float | None]:
    """All pairs in one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    if not pairs:
        return {}
    row = df.agg(*[correlation(F.col(a), F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    return {p: row[i] for i, p in enumerate(pairs)}


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    if not columns:
        return {}
    found = {c: quantiles(df, c, [0.5]) for c in columns}
    return {c: q[0] for c, q in found.items() if q}


def null_rates(df: DataFrame, columns: list[str]) -> dict[str, float]:
    if not columns:
        return {}
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def drop_leaking(df: DataFrame, columns: list[str], target: str) -> list[str]:
    middle = medians(df, columns)
    row = df.agg(*[correlation(F.coalesce(F.col(c).cast("double"), F.lit(middle.get(c))), F.col(target)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is None or abs(row[c]) <= MOST_CORRELATED]


def drop_collinear(found: dict[tuple[str, str], float | None], columns: list[str], preferred: list[str] = PREFERRED) -> list[str]:
    """Of every pair that is too close, the less preferred goes, also where the other is gone by then."""
    rank = lambda c: preferred.index(c) if c in preferred else 999
    gone = {a if rank(a) > rank(b) else b for (a, b), r in found.items() if r is not None and abs(r) > MOST_CORRELATED}
    return [c for c in columns if c not in gone]


def select_features(df: DataFrame, columns: list[str], target: str) -> list[str]:
    columns = drop_leaking(df, columns, target)
    columns = drop_collinear(correlations(df, columns), columns)
    rates = null_rates(df, columns)
    return [c for c in columns if rates[c] <= MOST_NULL]


def imputed(df: DataFrame, fill: dict[str, float], flagged: list[str]) -> DataFrame:
    """Flags of missing values come first, then the medians."""
    df = df.withColumns({f"{c}_was_nan": F.col(c).isNull().cast("int") for c in flagged})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fill.items()})


def hash_noise(key: Column, copy: Column, name: str) -> Column:
    """A number in [1 - NOISE, 1 + NOISE) that depends on the row, the copy and the feature alone."""
    u = F.pmod(F.xxhash64(key, copy, F.lit(name)), F.lit(1 << 20)) / float(1 << 20)
    return 1 - NOISE + 2 * NOISE * u


def augmented(df: DataFrame, key: str, target: str, columns: list[str]) -> DataFrame:
    """df with COPIES noisy copies of the rows with rare targets."""
    copies = df.filter(F.col(target) > RARE).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    scaled = {c: F.col(c) * hash_noise(F.col(key), F.col("_copy"), c) for c in columns if c in SCALED}
    return df.unionByName(copies.withColumns(scaled).drop("_copy") if scaled else copies.drop("_copy"))


def weight(target: Column) -> Column:
    return F.when(target > 100, 8.0).when(target > 50, 5.0).when(target > 30, 2.0).otherwise(1.0)


def forest(columns: list[str], trees: int = 400, depth: int = 30, seed: int = 42) -> Pipeline:
    """The deepest trees that Spark allows stand for unlimited ones; there is no out-of-bag score, so hold rows out."""
    rf = Forest(featuresCol="features", labelCol="log_target", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="error"), rf])


def fit(df: DataFrame, key: str, target: str, columns: list[str], **options) -> PipelineModel:
    train = augmented(df, key, target, columns).withColumns({"log_target": F.log1p(target), "weight": weight(F.col(target))})
    return forest(columns, **options).fit(train)


def predicted(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    return model.transform(spread(df)).withColumn(out, F.greatest(F.expm1("prediction"), F.lit(0.0))).drop("features", "prediction")


def importances(model: PipelineModel, columns: list[str], df: DataFrame, most: int = 20) -> DataFrame:
    values = [(c, float(v)) for c, v in zip(columns, model.stages[-1].featureImportances.toArray())]
    return df.sparkSession.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(most)


def held_out_r2(model: PipelineModel, df: DataFrame, target: str) -> float:
    scored = model.transform(df.withColumn("log_target", F.log1p(target)))
    return RegressionEvaluator(labelCol="log_target", predictionCol="prediction", metricName="r2").evaluate(scored)
