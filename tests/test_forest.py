"""The forest: its trees are those of plain Python, the whole is like Spark ML's, and its work does not grow with the depth."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tesserae.functions import trees
from tesserae.operators.forest import Forest
from tesserae.plans import tables


@pytest.fixture(scope="module")
def parts(spark, small):
    df = spark.read.parquet(f"{small}/part.parquet").selectExpr("p_partkey", "double(p_size) size", "double(p_partkey % 100) place", "double(length(p_type)) kind", "double(1 + p_partkey % 2) w")
    df = df.withColumn("label", F.col("size") / 10 + F.sin(F.col("place") / 15) * 3 + F.pmod(F.xxhash64("p_partkey"), F.lit(100)) / 200)
    return VectorAssembler(inputCols=["size", "place", "kind"], outputCol="features").transform(df).cache()


class Held:
    """As a broadcast."""

    def __init__(self, value):
        self.value = value


def guesses(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("p_partkey").collect()])


def plain_tree(bins, n, w, s, depth, least):
    """A function of bins: nested splits by the least sum of squares."""
    best, mean = (0.0,), s.sum() / w.sum()
    for f in range(bins.shape[1]) if depth else ():
        for cut in np.unique(bins[:, f])[:-1]:
            left = bins[:, f] <= cut
            if n[left].sum() >= least and n[~left].sum() >= least:
                gain = s[left].sum() ** 2 / w[left].sum() + s[~left].sum() ** 2 / w[~left].sum() - s.sum() ** 2 / w.sum()
                best = max(best, (gain, f, cut), key=lambda b: b[0])
    if best[0] <= 1e-12:
        return lambda row: mean
    _, f, cut = best
    left = bins[:, f] <= cut
    a, b = (plain_tree(bins[k], n[k], w[k], s[k], depth - 1, least) for k in (left, ~left))
    return lambda row: a(row) if row[f] <= cut else b(row)


@pytest.mark.parametrize("depth, least", [(30, 5), (3, 1), (0, 1)])
def test_tree(depth, least):
    """a tree makes the splits that looking at each one alone makes, and leaves cells out that no row was drawn of."""
    rng = np.random.default_rng(3)
    bins = np.unique(rng.integers(0, 12, (400, 3)).astype(np.uint8), axis=0)
    n = rng.poisson(1.5, len(bins)).astype(float)
    w = n * rng.choice([1.0, 8.0], len(bins))
    s = w * (bins[:, 0] + rng.normal(size=len(bins)))
    tree, gains = trees.grown(bins, np.stack([n, w, s]), rng, depth, least, 3, 0.0, 15.0)
    k = n > 0
    want = plain_tree(bins[k], n[k], w[k], s[k], depth, least)
    assert np.allclose(trees.value(tree, bins), [want(b) for b in bins])
    assert (gains.sum() > 0) == (depth > 0)


def test_edges():
    """Few values have a bin each; many have bins of equal weight, however they are summed up."""
    assert trees.edges(*trees.condensed(np.array([3.0, 1, 2, 2]), np.ones(4)), 4) == [1.5, 2.5]
    v = np.random.default_rng(1).normal(size=50000)
    whole = trees.edges(*trees.condensed(v, np.ones(len(v)), len(v)), 32)
    parts = [trees.condensed(p, np.ones(len(p))) for p in np.split(v, 5)]
    assert len(whole) == 31 and np.allclose(trees.edges(*trees.condensed(*map(np.concatenate, zip(*parts))), 32), whole, atol=0.01)


def test_like_spark_ml(spark, parts):
    """predictions and importances are those of Spark ML's forest, but for the draws."""
    options = {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 5, "seed": 42, "weightCol": "w"}
    ours, theirs = Forest(**options).fit(parts), RandomForestRegressor(featureSubsetStrategy="sqrt", **options).fit(parts)
    a, b = guesses(ours, parts), guesses(theirs, parts)
    spread = np.std([r.label for r in parts.collect()])
    assert np.abs(a - b).max() < 0.15 * spread and abs((a - b).mean()) < 0.02 * spread
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.03)


def test_order_and_file(spark, parts, tmp_path):
    """The same rows give the same forest however they are dealt out, in chunks and tasks of any size; it can be saved and read."""
    model = Pipeline(stages=[Forest(numTrees=9, maxDepth=30, seed=1)]).fit(parts)
    want = guesses(model, parts)
    dealt = parts.orderBy(F.rand(5)).repartition(7)
    assert np.array_equal(guesses(Forest(numTrees=9, maxDepth=30, seed=1).fit(dealt), parts), want)
    assert not np.array_equal(guesses(Forest(numTrees=9, maxDepth=30, seed=2).fit(parts), parts), want)
    model.write().overwrite().save(str(tmp_path / "model"))
    read = PipelineModel.load(str(tmp_path / "model"))
    assert np.allclose(guesses(read, parts), want, rtol=1e-12)
    assert read.stages[-1].getNumTrees() == 9 and read.stages[-1].featureImportances == model.stages[-1].featureImportances


def test_odd_rows(spark, parts):
    """A constant label, one row, and rows without weight; no rows, and labels that are no numbers, are errors."""
    grow = Forest(numTrees=4, maxDepth=30, weightCol="w")
    assert np.allclose(guesses(grow.fit(parts.withColumn("label", F.lit(0.1))), parts), 0.1)
    one = parts.filter("p_partkey = 5")
    assert set(guesses(grow.fit(one), parts)) <= {one.first().label}
    none = parts.withColumn("w", F.when(F.col("p_partkey") == 5, 1.0).otherwise(0.0))
    assert set(guesses(grow.fit(none), parts)) <= {one.first().label}
    for bad in (parts.filter("false"), parts.withColumn("label", F.lit(float("nan"))), parts.withColumn("w", F.lit(0.0)), parts.withColumn("w", F.lit(-1.0))):
        with pytest.raises(Exception):
            grow.fit(bad)


def jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_importance_in_few_jobs(spark, small, parts):
    """the whole forest takes as many jobs as one of single splits; by levels each takes a job at least."""
    flat = jobs(spark, "flat", lambda: Forest(numTrees=2, maxDepth=1).fit(parts))
    deep = jobs(spark, "deep", lambda: Forest(numTrees=400, maxDepth=30).fit(parts))
    assert abs(deep - flat) <= 2
    assert jobs(spark, "rf_importance", lambda: tables.QUERIES["rf_importance"](spark, small)) <= flat + 2


def test_predict_in_few_jobs(spark, small, parts):
    """the whole forest takes as many jobs as one of single splits."""
    flat = jobs(spark, "one split", lambda: Forest(numTrees=2, maxDepth=1).fit(parts))
    assert jobs(spark, "rf_predict", lambda: tables.QUERIES["rf_predict"](spark, small)) <= flat + 2


@pytest.mark.parametrize("ahead, known", [(1 << 17, 1 << 20), (500, 10)])
def test_predictions_in_batches(spark, ahead, known, monkeypatch):
    """rows get the mean of all trees in their order, in batches of any size, and where bins make no number as well."""
    monkeypatch.setattr(trees, "AHEAD", ahead)
    monkeypatch.setattr(trees, "KNOWN", known)
    rng = np.random.default_rng(2)
    for width in (2, 40):
        cuts = [np.linspace(0, 1, 31)] * width
        bins = rng.integers(0, 32, (2000, width)).astype(np.uint8)
        grown = [trees.grown(bins, np.stack([np.ones(2000), np.ones(2000), rng.normal(size=2000)]), rng, 30, 5, 2, 0.0, 5.0)[0] for _ in range(3)]
        predict = trees.predictor(cuts, [Held(grown[:1]), Held(grown[1:])], 3)
        x = rng.random((2500, width))
        batches = np.split(x, [100, 100, 900, 1700])
        got = list(predict.func(pa.FixedSizeListArray.from_arrays(pa.array(b.ravel()), width).cast(pa.list_(pa.float64())) for b in batches))
        assert [len(g) for g in got] == [len(b) for b in batches]
        want = sum(trees.value(t, trees.binned(x, cuts)) for t in grown) / 3
        assert np.allclose(np.concatenate([g.to_numpy() for g in got]), want, rtol=1e-12)
