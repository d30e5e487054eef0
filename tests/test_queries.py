"""Every query with SQL gives the rows that DuckDB gives; the others keep what they promise."""

import os

import duckdb
import pytest

from tesserae.operators import learning
from tesserae.plans import more_tables, tables  # noqa: F401


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(small):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{small}/{f}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(tables.SQL))
def test_same_rows(spark, duck, small, name):
    df = tables.QUERIES[name](spark, small)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(tables.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == plain(result.fetchall(), columns)
    assert got


def test_known_counts(spark, small):
    """Candidates, edges and components of the smallest footprints."""
    assert tables.QUERIES["spatial_join_rect"](spark, small).count() == 228
    assert tables.QUERIES["edges_top2"](spark, small).count() == 122
    kinds = {r.comp_type: r["count"] for r in tables.QUERIES["component_types"](spark, small).groupBy("comp_type").count().collect()}
    assert kinds == {"1x1": 34, "1xN": 5, "Nx1": 3, "NxN": 19}


def test_joins_are_equi_joins(spark, small):
    plan = tables.QUERIES["spatial_join_rect"](spark, small)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_only(spark, small):
    p = tables.QUERIES["rf_predict"](spark, small).collect()
    assert len(p) == 200 and all(r.predicted >= 0 for r in p)
    i = tables.QUERIES["rf_importance"](spark, small).collect()
    assert abs(sum(r.importance for r in i) - 1) < 1e-6
    q = sorted(tables.QUERIES["normal_plot"](spark, small).collect(), key=lambda r: r["rank"])
    assert all(a.theoretical <= b.theoretical and a.error <= b.error for a, b in zip(q, q[1:]))
    s = tables.QUERIES["hash_sample"](spark, small)
    assert s.collect() == tables.QUERIES["hash_sample"](spark, small).collect()


@pytest.mark.parametrize("name", ["rf_predict", "rf_importance"])
def test_whole_forests(spark, small, name, monkeypatch):
    """The queries grow the forest of learning's defaults."""
    grown, forest = [], learning.forest

    def kept(*args, **options):
        pipeline = forest(*args, **options)
        rf = pipeline.getStages()[-1]
        grown.append((rf.getNumTrees(), rf.getMaxDepth()))
        return pipeline

    monkeypatch.setattr(learning, "forest", kept)
    tables.QUERIES[name](spark, small)
    assert grown == [(400, 30)]
