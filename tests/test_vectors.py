"""Values worked out by hand from the rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tesserae.functions import address, kernel
from tesserae.functions import geometry as G
from tesserae.functions import rules as R
from tesserae.operators import cleaning, dedupe, graph, learning, matching


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_one_line_addresses(spark):
    rows = {
        "г. Санкт-Петербург, ул. Ленина, д. 10, к. 2, лит. А": "г санкт петербург ул ленина 10 корп2 лита",
        "Невский проспект, 28": "г санкт петербург 28",
        "пер. Гривцова, д. 4": "г санкт петербург 4",
        "ул. Ленина 10 5": "г санкт петербург ул ленина 10 корп5",
        "наб. реки Фонтанки (двор), дом 3б": "г санкт петербург наб реки фонтанки 3 литб",
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in rows], "line string")
    assert {r.line: r.addr_norm for r in address.parse_line(df, "line").collect()} == rows


def test_split_addresses(spark):
    rows = [("улица", "Ленина", "10А", "2", "г санкт петербург ул ленина 10 корп2 лита"), ("линия", "5-я", "7", None, "г санкт петербург линия 5-я 7"), (None, None, None, None, "г санкт петербург")]
    df = spark.createDataFrame([r[:4] for r in rows], "type_street string, name_street string, number string, housing string")
    assert [r.addr_norm for r in address.parse_parts(df).collect()] == [r[4] for r in rows]
    r = one(spark, a=address.normalised(F.lit("г. Санкт-Петербург, ул. Ёлочная, д. 5, корп. 2, ")), b=address.normalised(F.lit(" ,.- ")))
    assert r.a == "санкт-петербург, елочная, 5, корпус 2" and r.b is None


def test_categories(spark):
    r = one(spark, a=R.tag_category(F.lit("нежилое здание")), b=R.tag_category(F.lit(" Гараж")), c=R.tag_category(F.lit("торговля")), d=R.purpose_category(F.lit("Нежилое")), e=R.purpose_category(F.lit(None).cast("string")))
    assert tuple(r) == ("Жилое", "Постройка/сооружение", "Прочее", "Жилое", "Неизвестно")
    bands = {1.5: "3-4", 10.0: "10-12", 0.0: "unknown", 26.0: "26+", 1.0: "1", 2.0: "2", 5.0: "5"}
    for v, name in bands.items():
        assert one(spark, b=R.floor_band(F.lit(v))).b == name
    r = one(spark, a=R.tags(F.lit("['жилое здание', \"дом, угол\"]")), b=R.tags(F.lit("[a, 'b' ,]")), c=R.tags(F.lit(None).cast("string")))
    assert r.a == ["жилое здание", "дом, угол"] and r.b == ["a", "b"] and r.c == []
    r = one(spark, a=R.number(F.lit("5d")), b=R.number(F.lit("nan")), c=R.number(F.lit(" 2.50 ")), d=R.number(F.lit("1e3")))
    assert tuple(r) == (None, None, 2.5, 1000.0)


def test_heights(spark):
    cases = [(5.0, 3.0, 15.0, 15.0, 1.0, 0, "height_consistent"), (5.0, None, 30.0, 15.0, 2.0, 1, "height_inconsistent"), (None, 3.0, 12.0, None, None, 0, "height_consistent"), (9.0, 3.0, None, 27.0, None, 0, "stairs_only"), (None, None, None, None, None, 0, "unknown")]
    df = spark.createDataFrame([c[:3] for c in cases], "floors double, each double, height double")
    df = df.withColumn("expected", R.height_from_floors(F.col("floors"), F.col("each"))).withColumn("ratio", R.consistency_ratio(F.col("height"), F.col("expected")))
    df = df.withColumn("bad", R.flag(~F.col("ratio").between(*R.CONSISTENT)))
    assert [tuple(r) for r in df.select("*", R.height_source(F.col("height"), F.col("floors"), F.col("bad"))).collect()] == cases


def test_scores(spark):
    df = spark.createDataFrame([(1, 1, 50.0, 100.0, 100.0, 5.0), (2, 2, 20.0, 400.0, 100.0, 8.0)], "a_idx long, b_idx long, inter_area double, area_a double, area_b double, centroid_dist double")
    a, b = matching.scored(df).orderBy("a_idx").collect()
    assert (round(a.iou, 6), round(a.small_eq_radius, 6), round(a.centroid_dist_norm, 6), round(a.score, 6)) == (0.333333, 5.641896, 0.886227, 0.545459)
    assert (round(b.iou, 6), b.size_ratio, round(b.score, 6)) == (0.041667, 0.25, 0.171485)
    assert [r.a_idx for r in matching.passing(matching.scored(df)).collect()] == [1]


SQUARE = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
ELL = "POLYGON ((0 0, 10 0, 10 5, 5 5, 5 10, 0 10, 0 0))"
HOLED = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2))"


def test_native_measures(spark):
    df = spark.createDataFrame([(SQUARE,), (ELL,), (HOLED,), (f"MULTIPOLYGON (({SQUARE[9:-1]}), ((20 0, 22 0, 22 2, 20 2, 20 0)))".replace("MULTIPOLYGON (((0", "MULTIPOLYGON (((0"),), ("POINT (1 2)",), (None,)], "w string")
    g = F.col("g")
    x, y = G.centroid(g)
    out = df.withColumn("g", G.parsed(F.col("w"))).select(G.area(g), G.perimeter(g), x, y, G.complexity(g), G.part_count(g)).collect()
    assert tuple(out[0]) == (100.0, 40.0, 5.0, 5.0, 5, 1)
    assert out[1][0] == 75.0 and out[1][1] == 40.0 and out[1][4] == 7 and abs(out[1][2] - 25 / 6) < 1e-9
    assert out[2][0] == 96.0 and out[2][1] == 48.0 and out[2][4] == 5 and abs(out[2][2] - (500 - 12) / 96) < 1e-9
    assert out[4][0] is None and out[5][0] is None and out[4][4] == 0
    r = one(spark, m=G.approx_m2(F.lit(1e-10)), npi=G.compactness(F.lit(100.0), F.lit(40.0)))
    assert abs(r.m - 0.619607) < 1e-6 and abs(r.npi - 1.570796) < 1e-6
    e, n = G.utm(F.lit(33.0), F.lit(60.0))
    r = one(spark, e=e, n=n)
    assert abs(r.e - 500000) < 1e-6 and abs(r.n - 6651411.19) < 0.01  # on the middle meridian


def test_overlay():
    square, ell, holed = map(kernel.from_wkt, (SQUARE, ELL, HOLED))
    assert kernel.area(square) == pytest.approx(100) and kernel.area(ell) == pytest.approx(75) and kernel.area(holed) == pytest.approx(96)
    assert kernel.intersection_area(square, ell) == pytest.approx(75)
    assert kernel.intersection_area(holed, kernel.from_wkt("POLYGON ((3 3, 6 3, 6 6, 3 6, 3 3))")) == pytest.approx(8)
    assert kernel.hull_area(ell) == pytest.approx(87.5)
    length, width, ratio, fill, convexity = kernel.shape(ELL)
    assert (length, width, ratio) == pytest.approx((10, 10, 1)) and fill == pytest.approx(0.75) and convexity == pytest.approx(75 / 87.5)
    assert kernel.shape("POINT (1 1)") == (None,) * 5 and kernel.shape(None) == (None,) * 5
    bow = kernel.from_wkt("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))")
    assert not kernel.is_simple(bow) and kernel.is_simple(square)
    fixed = kernel.repaired(bow)
    assert kernel.area(fixed) == pytest.approx(2) and all(kernel.is_simple([p]) for p in fixed)
    both = kernel.union([square, None, kernel.from_wkt("POLYGON ((5 5, 15 5, 15 15, 5 15, 5 5))")])
    assert len(both) == 1 and kernel.area(both) == pytest.approx(175) and len(both[0][0]) == 9
    apart = kernel.union([square, kernel.from_wkt("POLYGON ((20 0, 22 0, 22 2, 20 2, 20 0))")])
    assert len(apart) == 2 and kernel.area(apart) == pytest.approx(104) and kernel.from_wkt(kernel.to_wkt(apart))
    assert kernel.distance(square, kernel.from_wkt("POLYGON ((13 14, 20 14, 20 20, 13 14))")) == pytest.approx(5)
    assert kernel.distance(square, ell) == 0


def test_overlay_of_turned_rectangles():
    rnd = random.Random(3)

    def rect(cx, cy, w, h, turn):
        c, s = math.cos(turn), math.sin(turn)
        p = [(cx + x * c - y * s, cy + x * s + y * c) for x, y in ((-w, -h), (w, -h), (w, h), (-w, h), (-w, -h))]
        return kernel.from_wkt("POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in p) + "))")

    def clipped(a, b):
        """Sutherland-Hodgman for convex shapes."""
        out = a[0][0][:-1].tolist()
        ring = b[0][0].tolist()
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            side = lambda p: (x2 - x1) * (p[1] - y1) - (y2 - y1) * (p[0] - x1)  # noqa: E731, B023
            new = []
            for p, q in zip(out, out[1:] + out[:1]):
                if side(p) >= 0:
                    new.append(p)
                if (side(p) >= 0) != (side(q) >= 0):
                    t = side(p) / (side(p) - side(q))
                    new.append([p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])])
            out = new
        x, y = out[0] if out else (0, 0)
        return sum((p[0] - x) * (q[1] - y) - (q[0] - x) * (p[1] - y) for p, q in zip(out, out[1:] + out[:1])) / 2

    for _ in range(60):
        a = rect(330000 + rnd.uniform(0, 5), 6640000 + rnd.uniform(0, 5), rnd.uniform(1, 6), rnd.uniform(1, 6), rnd.uniform(0, 3))
        b = rect(330000 + rnd.uniform(0, 5), 6640000 + rnd.uniform(0, 5), rnd.uniform(1, 6), rnd.uniform(1, 6), rnd.uniform(0, 3))
        shared = kernel.intersection_area(a, b)
        assert shared == pytest.approx(clipped(a, b), abs=1e-5) and shared == pytest.approx(kernel.intersection_area(b, a), abs=1e-5)
        assert kernel.area(kernel.union([a, b])) == pytest.approx(kernel.area(a) + kernel.area(b) - shared, abs=1e-5)


def test_dedupe(spark):
    df = spark.createDataFrame([(0, None, "x"), (1, None, "y"), (2, "a", "y"), (3, "a", "x"), (4, None, "x")], "row_id long, k string, v string")
    assert sorted(r.row_id for r in dedupe.keep_first(df, ["k"], "row_id").collect()) == [0, 2]
    assert sorted(r.row_id for r in dedupe.keep_first_in_turn(df, [["k", "v"], ["v"]], "row_id").collect()) == [0, 1]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {n: root(n) for n in parent}


def test_flags_before_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double")
    assert [(r.a, r.a_was_nan) for r in learning.imputed(df, {"a": 2.0}, ["a"]).collect()] == [(1.0, 0), (2.0, 1), (3.0, 0)]
    assert learning.drop_collinear({("area_m2", "x"): 0.99, ("x", "y"): -0.97, ("y", "z"): 0.5}, ["area_m2", "x", "y", "z"]) == ["area_m2", "z"]


def test_repair_column(spark):
    df = spark.createDataFrame([(SQUARE,), ("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))",), ("LINESTRING (0 0, 1 1)",), ("bad",), (None,)], "w string")
    a, b, *rest = [r[0] for r in df.select(cleaning.repaired("w")).collect()]
    assert a == SQUARE and b.startswith("MULTIPOLYGON") and rest == [None, None, None]
