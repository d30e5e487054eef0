"""What large tables ask for: no broadcast of rows whose number is unknown, columns computed once, batches that give what single rows give."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.functions import geometry as G
from tesserae.functions import kernel
from tesserae.operators import ranks
from tesserae.plans import more_tables, tables  # noqa: F401


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def geometries(n: int) -> list:
    """Rectangles, crossing rings and rings with holes on a coarse grid, where sides often touch; one without sides, and nulls."""
    rnd, out = random.Random(7), [None, [[np.zeros((4, 2))]]]
    while len(out) < n:
        x, y, w, h = rnd.randint(0, 6), rnd.randint(0, 6), rnd.randint(1, 6), rnd.randint(1, 6)
        points = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)] if len(out) % 3 else [(rnd.randint(-6, 6), rnd.randint(-6, 6)) for _ in range(rnd.randint(3, 8))]
        hole = [np.array([(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)], float)] * (len(out) % 5 == 0)
        out.append([[np.array(points + points[:1], float), *hole]])
    return out


@pytest.mark.parametrize("batch", [1 << 18, 300])
def test_common_areas_together(monkeypatch, batch):
    """many pairs in one go have the areas that each has alone."""
    monkeypatch.setattr(kernel, "BATCH", batch)
    a = geometries(300)
    b = random.Random(1).sample(a, len(a))
    sided = [x is not None and y is not None and len(kernel.sides(x)) > 0 and len(kernel.sides(y)) > 0 for x, y in zip(a, b)]
    want = [kernel.intersection_area(x, y) if ok else 0.0 for x, y, ok in zip(a, b, sided)]
    assert np.allclose(kernel.intersection_areas(a, b), want, atol=1e-9) and sum(w > 0 for w in want) > 100
    texts = [g and kernel.to_wkt(g) for g in a] + ["POINT (1 2)", "polygon((0 0,1 0,1 1,0 0))", " POLYGON ((0 0, 1e0 0, 1 1, 0 0))", "POLYGON ((0 0, 1 0, 0 0))"]
    same = [(x is None) == (y is None) and (x is None or all(np.array_equal(r, s) for p, q in zip(x, y) for r, s in zip(p, q))) for x, y in zip(kernel.from_wkts(texts), map(kernel.from_wkt, texts))]
    assert all(same)


@pytest.mark.parametrize("name", ["kde_radius", "knn_distance", "neighbour_stats"])
def test_cells_are_not_broadcast(spark, small, name):
    """F7, F8, F9: rows dealt to cells don't go through the driver, however small Spark takes them to be."""
    assert "Broadcast" not in plan(tables.QUERIES[name](spark, small))


def test_geometry_is_read_once(spark, small):
    """the text of a geometry is read once a row, and repaired once, by several tasks although the file is one."""
    df = tables.QUERIES["city_box"](spark, small)
    assert plan(df).count("ArrowEvalPython [repaired") == 1 and plan(df).count("from_json(") == 1
    assert "RoundRobinPartitioning" in plan(df)
    assert str(G.parsed(F.col("w"))).count("from_json") == 1
    simple = [True if g is None else kernel.is_simple(g) for g in geometries(200) if g is None or len(kernel.sides(g))]
    assert kernel.are_simple([g for g in geometries(200) if g is None or len(kernel.sides(g))]) == simple


def test_quantiles_in_parts(spark, small, monkeypatch):
    """beyond the bound no task sorts or counts all values, and the result is the same."""
    want = tables.QUERIES["consistency_error"](spark, small).collect()
    monkeypatch.setattr(ranks, "SORTABLE", 100)
    df = tables.QUERIES["consistency_error"](spark, small)
    assert "percentile" not in plan(df) and df.collect() == want


def test_unions_together():
    """many unions in one go have the rings that each has alone."""
    a = geometries(300)
    lists = list(zip(a, random.Random(1).sample(a, len(a))))
    for x, y in zip(kernel.unions(lists), map(kernel.union, lists)):
        assert (x is None) == (y is None)
        if x is not None:
            assert [[r.shape for r in p] for p in x] == [[r.shape for r in p] for p in y]
            assert all(np.allclose(r, s) for p, q in zip(x, y) for r, s in zip(p, q))


def test_shapes_together():
    """many areas in one go are those that each has alone, and so are what shapes are made of."""
    a = geometries(200)
    assert np.allclose(kernel.areas(a), [kernel.area(g) for g in a], atol=1e-9)
    texts = [g and kernel.to_wkt(g) for g in a] + ["POLYGON ((0 0, 1.2.3 0, 1 1, 0 0))"]
    got = kernel.shapes(texts)
    assert got[0] == (None,) * 5 and got[-1] == (None,) * 5
    assert all((s[0] is None) == (g is None or kernel.area(g) <= 0) for g, s in zip(a, got))
    assert kernel.shapes(["POLYGON ((0 0, 4 0, 4 2, 0 2, 0 0))"]) == [(4.0, 2.0, 2.0, 1.0, 1.0)]
