"""More operators as queries over the driver's tables: rules, features, geometry and profiles, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import address
from ..functions import geometry as G
from ..functions import rules as R
from ..operators import cleaning, features, learning, matching, profiling, spatial
from ..operators.ranks import sequential
from ..session import spread
from .tables import PAIRS, RECTANGLES, query, rectangles, rounded


def pick(values: list, at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (at % len(values)).cast("int"))


def listed(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


TAGS = ["жилой дом", "нежилое здание", "Офисный центр", "жилой комплекс", "комплекс", "склад", "спортивный зал", "гараж", "торговля", "бизнес-центр", "строение", None]
TAG_LABELS = ["Жилое", "Жилое", "Нежилое", "Жилое", "Комплекс", "Промышленное", "Социальное", "Постройка/сооружение", "Прочее", "Прочее", "Постройка/сооружение", "Прочее"]
EXPLORED_LABELS = ["Жилое", "Жилое", "Прочее", "Жилое", "Комплекс", "Прочее", "Социальное", "Прочее", "Коммерческое", "Коммерческое", "Постройка/сооружение", "Прочее"]
PURPOSES = ["Жилое", "Нежилое", "Многоквартирный дом", "Индивидуальный дом", "офис", "Торговый центр", "склад", "производство", "Медицинский центр", "гараж", "Хозяйственный блок", "иное", None]
PURPOSE_LABELS = ["Жилое", "Жилое", "Жилое", "ИЖС", "Нежилое", "Коммерческое", "Складское", "Промышленное", "Социальное", "Гараж", "Хозяйственное", "Прочее", "Неизвестно"]


@query(
    f"""SELECT p_partkey, {listed(TAG_LABELS)}[1 + p_partkey % 12] AS tag_label, {listed(EXPLORED_LABELS)}[1 + p_partkey % 12] AS explored_label, {listed(PURPOSE_LABELS)}[1 + p_partkey % 13] AS purpose_label,
  {listed(TAG_LABELS)}[1 + p_partkey % 12] = 'Постройка/сооружение' AND p_size < 25 AS dropped FROM part"""
)
def category_lists(table):
    """The real lists of categories, and the rule that drops small outbuildings."""
    tag, purpose = pick(TAGS, F.col("p_partkey")), pick(PURPOSES, F.col("p_partkey"))
    df = table("part").select("p_partkey", "p_size", R.tag_category(tag).alias("tag_label"), R.explored_category(tag).alias("explored_label"), R.purpose_category(purpose).alias("purpose_label"))
    return df.select("p_partkey", "tag_label", "explored_label", "purpose_label", ((F.col("tag_label") == "Постройка/сооружение") & (F.col("p_size") < 25)).alias("dropped"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN -1 WHEN f = 1 THEN 0 WHEN f = 2 THEN 1 WHEN f <= 4 THEN 2 WHEN f = 5 THEN 3 WHEN f <= 9 THEN 4 WHEN f <= 16 THEN 5 WHEN f <= 25 THEN 6 ELSE 7 END AS code
FROM (SELECT p_partkey, p_size - 2 AS f FROM part)"""
)
def band_codes(table):
    """Codes of bands from numbers of floors with a fraction, where no band is given."""
    floors = F.when(F.col("p_partkey") % 7 > 0, F.col("p_size") - 2 + F.when(F.col("p_size") > 2, 0.5).otherwise(0.0))
    return table("part").select("p_partkey", R.band_code(floors).alias("code"))


@query("SELECT c_custkey, n_name AS city, 'a|' || n_name || '|b c' AS tags FROM customer JOIN nation ON c_nationkey = n_nationkey")
def explored_parts(table):
    """City before the first comma, and tags, as the exploratory notebooks read them."""
    df = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    line = F.concat(F.lit(" "), "n_name", F.lit(" , ул. Ленина, 1"))
    tags = F.concat(F.lit(" ['a', \""), "n_name", F.lit("\", , 'b c']"))
    return df.select("c_custkey", R.city_part(line).alias("city"), F.array_join(R.explored_tags(tags), "|").alias("tags"))


@query(
    """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'спб, ленина, ' || s_suppkey WHEN 1 THEN 'садовая ' || s_suppkey || ' корпус 2' WHEN 2 THEN 'ель ' || lower(s_name) END AS light,
  s_suppkey || '|b' AS ids FROM supplier"""
)
def light_address(table):
    """The light form of addresses that fused records carry, and lists of ids."""
    k = F.col("s_suppkey").cast("string")
    text = F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("г. СПб,  ул. Ленина, д. "), k)).when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("улица Садовая дом "), k, F.lit(" корп. 2 ,")))
    text = text.when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("Город Ёль "), "s_name")).otherwise(" .,- ")
    ids = F.array_join(address.id_list(F.concat(F.lit(" "), k, F.lit(", ,b,"))), "|")
    return table("supplier").select("s_suppkey", address.normalised(text).alias("light"), ids.alias("ids"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN p_name END AS tidy, CASE WHEN p_partkey % 4 > 0 THEN least(greatest(p_size - 5, 0), 30) END AS clipped,
  CASE WHEN p_size % 3 > 0 THEN p_retailprice / (p_size % 3) END AS ratio, CASE WHEN p_size BETWEEN 25 AND 60 THEN p_size / 10.0 END AS usual, (p_size > 60 OR p_size BETWEEN 1 AND 9)::INT AS industrial, p_size % 2 = 0 AS kept FROM part"""
)
def scalar_rules(table):
    """Tidy text, clipping, ratios to what may be zero, usual and industrial floor heights."""
    k, size = F.col("p_partkey"), F.col("p_size")
    text = F.when(k % 5 == 3, " nan ").when(k % 5 == 4, pick(["None", "", "  "], k)).otherwise(F.concat(F.lit(" "), "p_name", F.lit("  ")))
    each = F.when(size < 10, 7.0).otherwise((size / 10).cast("double"))
    usual, industrial = R.within(F.when(size >= 25, size / 10).cast("double"), *R.USUAL_FLOOR_HEIGHT), R.flag((each > 6) & (each <= 15))
    return table("part").select(
        "p_partkey", R.tidy(text).alias("tidy"), R.clipped(F.when(k % 4 > 0, size - 5), 0, 30).alias("clipped"),
        F.try_divide("p_retailprice", F.nullif((size % 3).cast("double"), F.lit(0.0))).alias("ratio"), usual.alias("usual"), industrial.alias("industrial"), (size % 2 == 0).alias("kept"),
    )


@query(
    """WITH p AS (SELECT *, p_partkey % 6 AS k FROM part),
s AS (SELECT *, CASE WHEN k > 0 THEN least(greatest(p_size * 3 - 10, 1), 100) END AS floors, CASE WHEN k <> 1 THEN least(greatest(p_size / 4.0, 2), 15) END AS each FROM p)
SELECT p_partkey AS building_id, floors AS stairs_clean, each AS avg_floor_height, CASE WHEN k <> 2 THEN least(greatest(p_size - 3, 1), 100) END::DOUBLE AS floor_mid_A, floors * each AS height_from_stairs,
  [2, 4, 5, -1, 0, 7][1 + k] AS floor_band_enc, [0, 1, 5, -1, -1, 3][1 + k] AS purpose_B_enc, [0, 3, 4, -1, -1, -1][1 + k] AS category_A_enc, [2, 2, 1, 0, 0, 0][1 + k] AS height_source_enc,
  (k = 0)::INT AS is_residential, (coalesce(each, 3) > 4)::INT AS is_industrial_height, (k <> 5)::INT AS has_height, (p_partkey % 3 > 0)::INT + (p_partkey % 2 > 0)::INT AS n_sources,
  CASE WHEN k <> 4 THEN 0.25 ELSE 0 END::DOUBLE AS iou_ab_clean, CASE WHEN k > 1 THEN k / (k + 2.0) END AS detail_ratio, coalesce(each, 3) / 3 AS floor_height_ratio,
  p_retailprice * coalesce(floors, 1) AS area_floor_product, round(ln(1 + p_retailprice * coalesce(floors, 1)), 9) AS log_area_floor_product FROM s"""
)
def category_features(table):
    """The features of categories, floors and sources that the model takes."""
    k, size = F.col("p_partkey") % 6, F.col("p_size")
    df = table("part").select(
        F.col("p_partkey").alias("building_id"), F.col("p_retailprice").alias("area_m2"), F.when(k > 0, size * 3 - 10).alias("stairs"), F.when(k != 1, size / 4).alias("avg_floor_height_clean"),
        F.when(k != 2, (size - 3).cast("double")).alias("floor_mid_A_median"), pick(["3-4", "6-9", "10-16", "x", "1", "26+"], k).alias("floor_band"),
        pick(["Жилое", "Нежилое", "Прочее", "x", None, "Социальное"], k).alias("purpose_category_B_mode"), pick(["Жилое", "Промышленное", "Социальное", "x", None, "ИЖС"], k).alias("category_A_mode"),
        pick(["height_consistent", "direct", "calculated", "stairs_only", None, "missing"], k).alias("height_source"), F.when(k != 5, 1.0).alias(features.TARGET),
        (F.col("p_partkey") % 3).alias("n_a"), (F.col("p_partkey") % 2).alias("n_b"), F.when(k != 4, 0.25).alias("iou_ab"), F.when(k > 1, k).alias("detail_a"), F.when(k > 0, 2.0).alias("detail_b"),
    )
    names = ["stairs_clean", "avg_floor_height", "floor_mid_A", "height_from_stairs", "floor_band_enc", "purpose_B_enc", "category_A_enc", "height_source_enc", "is_residential", "is_industrial_height", "has_height", "n_sources"]
    names += ["iou_ab_clean", "detail_ratio", "floor_height_ratio", "area_floor_product", "log_area_floor_product"]
    return rounded(features.categorical(df).select("building_id", *names), "log_area_floor_product", digits=9)


@query(
    """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(coalesce(x, m), l_extendedprice) AS b FROM (SELECT *, CASE WHEN l_linenumber > 1 THEN l_extendedprice * 2 END AS x FROM lineitem),
  (SELECT median(l_extendedprice * 2) FILTER (WHERE l_linenumber > 1) AS m FROM lineitem))
SELECT 'l_quantity' AS name, abs(a) <= 0.95 AS kept FROM c UNION ALL SELECT 'copy', abs(b) <= 0.95 FROM c UNION ALL SELECT 'double', false UNION ALL SELECT 'constant', true"""
)
def leakage_filter(table):
    """Features that say the target: null ones are filled by medians before, constants stay."""
    df = table("lineitem").select("l_quantity", F.when(F.col("l_linenumber") > 1, F.col("l_extendedprice") * 2).alias("copy"), (F.col("l_extendedprice") * 2).alias("double"), F.lit(1.0).alias("constant"), "l_extendedprice")
    names = df.columns[:-1]
    kept = learning.drop_leaking(df, names, "l_extendedprice")
    return df.sparkSession.createDataFrame([(c, c in kept) for c in names], "name string, kept boolean")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1)::BIGINT AS at FROM orders")
def sequential_keys(table):
    """Rows numbered in an order, without one task for all."""
    return sequential(table("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "at").select("o_orderkey", "at")


@query(
    f"""WITH r AS ({RECTANGLES}), d AS (SELECT key, sqrt(pow((x0 + x1) / 2 - 328800, 2) + pow((y0 + y1) / 2 - 6641000, 2)) AS dist, CASE WHEN key % 4 > 0 THEN v END AS v FROM r),
q AS (SELECT quantile_cont(dist, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM d),
z AS (SELECT d.*, CASE WHEN dist <= e[2] THEN 0 WHEN dist <= e[3] THEN 1 WHEN dist <= e[4] THEN 2 WHEN dist <= e[5] THEN 3 ELSE 4 END AS zone FROM d, q)
SELECT key, round(dist, 5) AS dist_to_center, round(avg(v) OVER (PARTITION BY zone), 6) AS mean_height_by_zone FROM z"""
)
def zone_means(table):
    """Distance to the centre, and the zone's mean joined back to every row."""
    df = rectangles(table).select("key", F.hypot(F.col("px") - features.CENTRE[0], F.col("py") - features.CENTRE[1]).alias("dist"), F.when(F.col("key") % 4 > 0, F.col("v")).alias("v"))
    zones = features.quantile_zones(df, "dist")
    means = zones.groupBy("zone").agg(F.avg("v").alias("mean_height_by_zone"))
    out = zones.join(means, "zone", "left").select("key", F.round("dist", 5).alias("dist_to_center"), "mean_height_by_zone")
    return rounded(out, "mean_height_by_zone")


LON, LAT = "28.95 + (p_partkey % 28) / 10.0", "59.35 + (p_partkey % 13) / 10.0"  # beside the limits of the box


@query(
    f"""SELECT key, 'Polygon' AS geom_type, 5 AS geom_complexity, round(lon, 4) AS lon, round(lat, 4) AS lat, round(side * side, 10) * 111320 * 55660 BETWEEN 20 AND 100000 AS fits
FROM (SELECT p_partkey AS key, {LON} AS lon, {LAT} AS lat, (1 + p_size) / 20000.0 AS side FROM part) WHERE key % 11 > 0 AND lon > 28.99 AND lon < 31.51 AND lat > 59.39 AND lat < 60.41"""
)
def city_box(table):
    """Null geometries and those outside the city's box go; areas in square degrees become metres."""
    lon, lat, half = F.expr(LON), F.expr(LAT), F.expr("(1 + p_size) / 40000.0")
    wkt = F.when(F.col("p_partkey") % 11 > 0, G.written(G.rectangle(*[c.cast("double") for c in (lon - half, lat - half, lon + half, lat + half)])))
    df = cleaning.with_geometry(spread(table("part").select("p_partkey", "p_size")).select(F.col("p_partkey").alias("key"), wkt.alias("wkt")), "wkt")
    return df.select("key", "geom_type", "geom_complexity", F.round("centroid_lon", 4).alias("lon"), F.round("centroid_lat", 4).alias("lat"), F.col("geom_area_approx_m2").between(*R.AREA).alias("fits"))


def diamond(x: Column, y: Column, half: Column) -> Column:
    """WKT of a square that stands on a corner."""
    points = [(x - half, y), (x, y - half), (x + half, y), (x, y + half), (x - half, y)]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat_ws(" ", a.cast("double").cast("string"), b.cast("double").cast("string")) for a, b in points]), F.lit("))"))


@query(
    """SELECT p_partkey, round(greatest(sqrt(2) * h - abs(dx + dy) / sqrt(2), 0) * greatest(sqrt(2) * h - abs(dx - dy) / sqrt(2), 0), 6) AS common,
  round(4 * h * h - greatest(sqrt(2) * h - abs(dx + dy) / sqrt(2), 0) * greatest(sqrt(2) * h - abs(dx - dy) / sqrt(2), 0), 6) AS whole, round(sqrt(2) * h, 6) AS length, round(sqrt(2) * h, 6) AS width, 1.0 AS convexity
FROM (SELECT p_partkey, 4 + p_size % 5 AS h, p_partkey % 9 AS dx, (p_partkey * 3) % 7 AS dy FROM part)"""
)
def turned_overlay(table):
    """Squares on their corners: what two have in common, their union, and the smallest rectangle around one."""
    k, h = F.col("p_partkey"), 4 + F.col("p_size") % 5
    a, b = diamond(F.lit(100) + F.lit(0), F.lit(100) + F.lit(0), h), diamond(100 + k % 9, 100 + (k * 3) % 7, h)
    df = spread(table("part").select("p_partkey", "p_size")).select("p_partkey", a.alias("a"), b.alias("b"))
    df = df.withColumns({"common": matching.common_area("a", "b"), "u": matching.united(F.array("a", "b")), "s": features.shape("a")})
    out = df.select("p_partkey", "common", G.area(G.parsed(F.col("u"))).alias("whole"), F.col("s.bbox_length").alias("length"), F.col("s.bbox_width").alias("width"), F.col("s.convexity").alias("convexity"))
    return rounded(out, "common", "whole", "length", "width", "convexity")


@query(f"WITH {PAIRS} SELECT a_idx, b_idx, round(area_a + area_b - inter, 4) AS whole FROM p")
def united_area(table):
    """The area of the union of each pair of footprints."""
    df = rectangles(table).withColumn("wkt", G.written(G.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])))
    a, b = (df.filter(f"side = {s}").select(F.col("idx").alias(f"{c}_idx"), F.col("wkt").alias(f"{c}_wkt")) for s, c in ((0, "a"), (1, "b")))
    pairs = spatial.boxes_that_meet(df.filter("side = 0"), df.filter("side = 1"), 32.0).select("a_idx", "b_idx")
    both = pairs.join(a.hint("merge"), "a_idx").join(b.hint("merge"), "b_idx").withColumn("u", matching.united(F.array("a_wkt", "b_wkt")))
    return rounded(both.select("a_idx", "b_idx", G.area(G.parsed(F.col("u"))).alias("whole")), "whole", digits=4)


@query(
    """SELECT reason, count(*)::BIGINT AS n FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN 'Self-intersection' WHEN 1 THEN 'Not readable' WHEN 2 THEN 'No area' ELSE 'Valid Geometry' END AS reason FROM part) GROUP BY reason"""
)
def validity_reasons(table):
    """Why geometries are not valid."""
    x = F.col("p_partkey").cast("string")
    line = lambda *points: F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat(x, F.lit(f"{a} {b}")) for a, b in points]), F.lit("))"))
    texts = [line((1, 0), (5, 4), (5, 0), (1, 2), (1, 0)), F.concat(F.lit("CIRCLE "), x), line((1, 0), (5, 0), (3, 0), (1, 0)), line((1, 0), (5, 0), (5, 4), (1, 0)), line((1, 0), (5, 0), (5, 4), (1, 4), (1, 0))]
    wkt = F.get(F.array(*texts), (F.col("p_partkey") % 5).cast("int"))
    return table("part").select(profiling.validity(wkt).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""WITH g AS (SELECT p_partkey % 9 AS k, {LON} AS x, {LAT} AS y, (1 + p_size) / 10.0 AS s FROM part)
SELECT count(*) FILTER (WHERE k > 0)::BIGINT AS n, count(*) FILTER (WHERE k = 1)::BIGINT AS n_unread, count(*) FILTER (WHERE k > 1)::BIGINT AS n_polygon, 0::BIGINT AS n_multi, 1 AS most_parts,
  round(min(s * s) FILTER (WHERE k > 1), 6) AS least_area, round(max(s * s) FILTER (WHERE k > 1), 6) AS most_area, round(min(x) FILTER (WHERE k > 1), 4) AS west, round(max(x) FILTER (WHERE k > 1), 4) AS east,
  round(min(y) FILTER (WHERE k > 1), 4) AS south, round(max(y) FILTER (WHERE k > 1), 4) AS north, count(*) FILTER (WHERE k > 1 AND x > 28.95 AND x < 31.55 AND y > 59.35 AND y < 60.45)::BIGINT AS n_inside FROM g"""
)
def geometry_facts(table):
    """One row about a column of geometries."""
    lon, lat, half = F.expr(LON), F.expr(LAT), F.expr("(1 + p_size) / 20.0")
    wkt = G.written(G.rectangle(*[c.cast("double") for c in (lon - half, lat - half, lon + half, lat + half)]))
    k = F.col("p_partkey") % 9
    shifted = F.when(k == 1, "nothing").when(k > 1, wkt)
    out = profiling.geometry_profile(table("part").select(shifted.alias("wkt")), "wkt")
    return rounded(rounded(out, "least_area", "most_area"), "west", "east", "south", "north", digits=4)


@query(
    """SELECT 'o_orderstatus' AS "column", count(o_orderstatus)::BIGINT AS count, count(DISTINCT o_orderstatus)::BIGINT AS "unique", (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
  (SELECT count(*) FROM orders GROUP BY o_orderstatus ORDER BY count(*) DESC LIMIT 1)::BIGINT AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS least, NULL::DOUBLE AS q1, NULL::DOUBLE AS median, NULL::DOUBLE AS q3, NULL::DOUBLE AS most FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), count(DISTINCT o_custkey), (SELECT o_custkey::VARCHAR FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey::VARCHAR LIMIT 1), (SELECT count(*) FROM orders GROUP BY o_custkey ORDER BY count(*) DESC LIMIT 1),
  round(avg(o_custkey), 6), round(stddev_samp(o_custkey), 6), min(o_custkey), quantile_cont(o_custkey, 0.25), median(o_custkey), quantile_cont(o_custkey, 0.75), max(o_custkey) FROM orders"""
)
def describe_columns(table):
    """Counts, tops and moments of columns of any type."""
    return rounded(profiling.describe_all(table("orders"), ["o_orderstatus", "o_custkey"]), "mean", "std")


@query(
    """SELECT 0 AS at, 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey)::BIGINT AS n_filled FROM customer UNION ALL SELECT 1, 'c_name', 'string', count(c_name) FROM customer UNION ALL SELECT 2, 'c_nationkey', 'int', count(c_nationkey) FROM customer
UNION ALL SELECT 3, 'c_acctbal', 'double', count(c_acctbal) FROM customer UNION ALL SELECT 4, 'c_mktsegment', 'string', count(c_mktsegment) FROM customer"""
)
def table_info(table):
    return profiling.info(table("customer"))


@query("SELECT CASE WHEN l_quantity < 2 THEN 0 WHEN l_quantity < 6 THEN 1 WHEN l_quantity < 10 THEN 2 WHEN l_quantity < 26 THEN 3 ELSE 4 END AS bin, count(*)::BIGINT AS n FROM lineitem WHERE l_quantity BETWEEN 1 AND 41 GROUP BY 1")
def hist_edges(table):
    """Counts between given edges, the last closed."""
    return profiling.histogram_edges(table("lineitem"), "l_quantity", [1, 2, 6, 10, 26, 41])


@query(
    """WITH l AS (SELECT log10(o_totalprice) AS v FROM orders WHERE o_totalprice > 0), b AS (SELECT min(v) AS lo, max(v) AS hi FROM l)
SELECT least(floor((v - lo) / ((hi - lo) / 20)), 19)::INT AS bin, count(*)::BIGINT AS n FROM l, b GROUP BY 1"""
)
def hist_log(table):
    return profiling.log_histogram(table("orders"), "o_totalprice", 20)


@query(
    """WITH d AS (SELECT (l_linenumber * 5 - l_quantity)::DOUBLE AS d FROM lineitem WHERE l_linenumber < 7 AND l_tax > 0.01)
SELECT count(*)::BIGINT AS n, count(*) FILTER (WHERE d < 0)::BIGINT AS n_reversed, count(*) FILTER (WHERE d = 0)::BIGINT AS n_equal, count(*) FILTER (WHERE d > 5)::BIGINT AS n_wide, min(d) AS low, quantile_cont(d, 0.25) AS q1, median(d) AS median,
  quantile_cont(d, 0.75) AS q3, round(avg(d), 6) AS mean, max(d) AS high, round(stddev_samp(d), 6) AS std FROM d"""
)
def gap_facts(table):
    """How far apart the lower and the upper of two values are."""
    df = table("lineitem").select(F.when(F.col("l_tax") > 0.01, F.col("l_quantity")).alias("low"), F.when(F.col("l_linenumber") < 7, F.col("l_linenumber") * 5).alias("high"))
    return rounded(profiling.gap_analysis(df, "low", "high").withColumnsRenamed({}), "mean", "std").select("n", "n_reversed", "n_equal", "n_wide", "low", "q1", "median", "q3", "mean", "high", "std")


@query(
    """WITH t AS (SELECT *, l_quantity BETWEEN 2 AND 40 AND l_linenumber < 6 AS train FROM lineitem)
SELECT 'train' AS name, count(*) FILTER (WHERE train)::BIGINT AS n FROM t UNION ALL SELECT 'predict', count(*) FILTER (WHERE NOT train) FROM t UNION ALL SELECT 'train_with_tax', count(*) FILTER (WHERE train AND l_tax > 0) FROM t"""
)
def training_counts(table):
    """How many rows a model could learn from, and how many are to be predicted."""
    df = table("lineitem").withColumn("geometry", F.when(F.col("l_linenumber") < 6, "POLYGON EMPTY"))
    return profiling.training_estimate(df, "l_quantity", (2, 40), "geometry", {"tax": F.col("l_tax") > 0})


@query(
    """WITH t AS (SELECT p_partkey AS cluster, 1 + p_partkey % 3 AS a, 1 + p_size % 2 AS b, CASE WHEN p_partkey % 7 > 0 THEN p_size / 50.0 END AS iou, (p_partkey % 10) / 10.0 AS sa FROM part)
SELECT cluster, CASE WHEN a = 1 AND b = 1 THEN '1x1' WHEN a = 1 THEN '1xN' WHEN b = 1 THEN 'Nx1' ELSE 'NxN' END AS comp_type,
  CASE WHEN a = 1 AND b = 1 THEN false WHEN a + b >= 4 THEN true ELSE coalesce(iou < 0.35 OR least(sa, 0.9) < 0.55, false) END AS suspicious FROM t"""
)
def suspicious_clusters(table):
    """Clusters that are split again: those of four nodes or more, or of three that overlap little."""
    k = F.col("p_partkey")
    df = table("part").select(k.alias("cluster"), (1 + k % 3).alias("n_A"), (1 + F.col("p_size") % 2).alias("n_B"), F.when(k % 7 > 0, F.col("p_size") / 50).alias("iou"), ((k % 10) / 10).alias("support_a"), F.lit(0.9).alias("support_b"))
    kinds = df.select("cluster", (F.col("n_A") + F.col("n_B")).alias("n_nodes"), matching.comp_type(F.col("n_A"), F.col("n_B")).alias("comp_type"))
    return matching.suspicious(kinds, df.select("cluster", "iou", "support_a", "support_b")).select("cluster", "comp_type", "suspicious")
