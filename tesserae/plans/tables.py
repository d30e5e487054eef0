"""The operators as queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address
from ..functions import geometry as G
from ..functions import rules as R
from ..operators import dedupe, features, learning, matching, profiling, spatial
from ..operators.ranks import quantiles
from ..session import cut

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (table, ...) by its name; table("part") reads a table."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# rectangles from part: even keys are side A, odd ones side B
RECTANGLES = """
  SELECT p_partkey AS key, p_partkey // 2 AS idx, p_partkey % 2 AS side, x0, y0, x0 + w AS x1, y0 + h AS y1, (w * h)::DOUBLE AS area, p_retailprice AS v FROM (
    SELECT *, ((p_partkey // 2) % 100) * 9 + (p_partkey * 7) % 5 AS x0, ((p_partkey // 2) // 100) * 9 + (p_partkey * 3) % 4 AS y0,
      5 + p_partkey % 11 AS w, 5 + p_partkey % 7 AS h FROM part)
"""
PAIRS = f"""
r AS ({RECTANGLES}),
p AS (
  SELECT a.idx AS a_idx, b.idx AS b_idx, a.area AS area_a, b.area AS area_b,
    (greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0))::DOUBLE AS inter,
    sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2)) AS dist
  FROM r a, r b WHERE a.side = 0 AND b.side = 1 AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1),
m AS (
  SELECT *, inter / (area_a + area_b - inter) AS iou, greatest(inter / area_a, inter / area_b) AS mc, least(area_a, area_b) / greatest(area_a, area_b) AS sr,
    dist / greatest(sqrt(least(area_a, area_b) / pi()), 1) AS dn FROM p),
s AS (SELECT *, 0.45 * iou + 0.25 * mc + 0.2 * sr + 0.1 * greatest(least(1 - dn / 3, 1), 0) AS score FROM m),
f AS (SELECT *, round(score, 9) AS rs FROM s WHERE iou >= 0.18 OR (mc >= 0.85 AND sr >= 0.2 AND dn <= 2) OR (score >= 0.4 AND sr >= 0.1 AND dn <= 3)),
k AS (SELECT *, dense_rank() OVER (PARTITION BY a_idx ORDER BY rs DESC) AS ra, dense_rank() OVER (PARTITION BY b_idx ORDER BY rs DESC) AS rb FROM f),
e AS (SELECT * FROM k WHERE ra <= 2 AND rb <= 2)
"""
COMPONENTS = f"""
{PAIRS},
g AS (SELECT a_idx * 2 AS x, b_idx * 2 + 1 AS y FROM e UNION SELECT b_idx * 2 + 1, a_idx * 2 FROM e),
reach(x, y) AS (SELECT DISTINCT x, x FROM g UNION SELECT reach.x, g.y FROM reach JOIN g ON reach.y = g.x),
c AS (SELECT x AS node, min(y) AS cluster FROM reach GROUP BY x)
"""


def rectangles(table) -> DataFrame:
    j = F.floor(F.col("p_partkey") / 2)
    k = F.col("p_partkey")
    x0, y0 = (j % 100) * 9 + (k * 7) % 5, F.floor(j / 100) * 9 + (k * 3) % 4
    df = table("part").select(k.alias("key"), j.alias("idx"), (k % 2).alias("side"), x0.alias("xmin"), y0.alias("ymin"), (5 + k % 11).alias("w"), (5 + k % 7).alias("h"), F.col("p_retailprice").alias("v"))
    df = df.withColumns({"xmax": F.col("xmin") + F.col("w"), "ymax": F.col("ymin") + F.col("h")})
    df = df.withColumns({c: F.col(c).cast("double") for c in spatial.BOX})
    return df.withColumns({"area": (F.col("w") * F.col("h")).cast("double"), "px": (F.col("xmin") + F.col("xmax")) / 2, "py": (F.col("ymin") + F.col("ymax")) / 2})


def pairs_of(table) -> DataFrame:
    df = rectangles(table)
    found = matching.boxes_that_meet(df.filter("side = 0"), df.filter("side = 1"), 32.0)
    area = lambda s: ((F.col(f"{s}_xmax") - F.col(f"{s}_xmin")) * (F.col(f"{s}_ymax") - F.col(f"{s}_ymin"))).alias(f"area_{s}")
    mid = lambda s, c: (F.col(f"{s}_{c}min") + F.col(f"{s}_{c}max")) / 2
    # boxes carry all that a rectangle is, so no join brings the sides back
    dist = F.sqrt((mid("a", "x") - mid("b", "x")) ** 2 + (mid("a", "y") - mid("b", "y")) ** 2)
    return matching.scored(found.select("a_idx", "b_idx", matching.box_overlap().alias("inter_area"), area("a"), area("b"), dist.alias("centroid_dist")))


def edges_of(table) -> DataFrame:
    # scores that are equal on paper may differ in the last digit between engines; ranks take them as equal
    return matching.best_edges(pairs_of(table).withColumn("score", F.round("score", 9)))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1")
def clean_dedupe_first(table):
    return dedupe.keep_first(table("events"), ["user_id", "event_type"], "event_id").select("event_id", "user_id", "event_type")


@query(
    """WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1)
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS m FROM a) WHERE m = 1"""
)
def clean_dedupe_in_turn(table):
    return dedupe.keep_first_in_turn(table("orders"), [["o_custkey", "o_orderstatus", "o_orderpriority"], ["o_custkey"]], "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 5 AND 40 THEN l_quantity END AS quantity, (l_quantity BETWEEN 5 AND 40)::INT AS has_quantity,
  (l_tax > 0.04)::INT AS high_tax FROM lineitem WHERE l_extendedprice BETWEEN 20 AND 100000"""
)
def clean_range_null(table):
    df = table("lineitem").filter(F.col("l_extendedprice").between(*R.AREA))
    df = df.withColumn("quantity", R.within(F.col("l_quantity"), 5, 40))
    return df.select("l_orderkey", "l_linenumber", "quantity", R.flag(F.col("quantity").isNotNull()).alias("has_quantity"), R.flag(F.col("l_tax") > 0.04).alias("high_tax"))


@query(
    """WITH t AS (SELECT p_partkey, nullif(p_size, 7) AS a, CASE WHEN p_partkey % 9 > 0 THEN (p_partkey % 50)::INT END AS b FROM part),
s AS (SELECT p_partkey, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) ELSE a END AS low, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN greatest(a, b) ELSE b END AS high FROM t)
SELECT p_partkey, low, high, high - low AS gap, coalesce((low + high) / 2, high, low)::DOUBLE AS middle FROM s"""
)
def clean_minmax_swap(table):
    df = table("part").select("p_partkey", F.nullif("p_size", F.lit(7)).alias("a"), F.when(F.col("p_partkey") % 9 > 0, (F.col("p_partkey") % 50).cast("int")).alias("b"))
    low, high = R.ordered_pair(F.col("a"), F.col("b"))
    df = df.select("p_partkey", low.alias("low"), high.alias("high"))
    return df.select("*", (F.col("high") - F.col("low")).alias("gap"), R.middle(F.col("low"), F.col("high")).cast("double").alias("middle"))


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, nullif(l_quantity, 13) AS floors, CASE WHEN l_tax > 0.02 THEN 2.5 + l_tax * 10 END AS each, CASE WHEN l_linenumber < 6 THEN l_extendedprice / 300 END AS height FROM lineitem),
h AS (SELECT *, floors * coalesce(each, 3.0) AS expected FROM t),
c AS (SELECT *, CASE WHEN expected > 0 THEN height / expected END AS ratio FROM h),
i AS (SELECT *, coalesce(ratio NOT BETWEEN 0.6 AND 1.4, false)::INT AS inconsistent FROM c)
SELECT l_orderkey, l_linenumber, expected, ratio, inconsistent,
  CASE WHEN height IS NOT NULL AND inconsistent = 0 THEN 'height_consistent' WHEN height IS NOT NULL THEN 'height_inconsistent' WHEN floors IS NOT NULL THEN 'stairs_only' ELSE 'unknown' END AS source,
  height / floors AS per_floor, round(ln(1 + height), 9) AS log_height FROM i"""
)
def ratio_consistency(table):
    df = table("lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_quantity", F.lit(13.0)).alias("floors"), F.when(F.col("l_tax") > 0.02, 2.5 + F.col("l_tax") * 10).alias("each"), F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice") / 300).alias("height"))
    df = df.withColumn("expected", R.height_from_floors(F.col("floors"), F.col("each")))
    df = df.withColumn("ratio", R.consistency_ratio(F.col("height"), F.col("expected"))).withColumn("inconsistent", R.flag(~F.col("ratio").between(*R.CONSISTENT)))
    df = df.withColumns({"source": R.height_source(F.col("height"), F.col("floors"), F.col("inconsistent")), "per_floor": F.try_divide("height", "floors"), "log_height": F.log1p("height")})
    return rounded(df, "log_height", digits=9).drop("floors", "each", "height")


@query(
    """SELECT band, count(*)::BIGINT AS n, sum(code)::BIGINT AS codes FROM (SELECT *, CASE band WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3-4' THEN 2 WHEN '5' THEN 3 WHEN '6-9' THEN 4 WHEN '10-12' THEN 5 WHEN '13-16' THEN 5 WHEN '17-25' THEN 6 WHEN '26+' THEN 7 ELSE -1 END AS code FROM (
  SELECT CASE WHEN p_size IS NULL OR p_size - 1 <= 0 THEN 'unknown' WHEN p_size - 1 = 1 THEN '1' WHEN p_size - 1 = 2 THEN '2' WHEN p_size - 1 <= 4 THEN '3-4' WHEN p_size - 1 <= 5 THEN '5' WHEN p_size - 1 <= 9 THEN '6-9'
    WHEN p_size - 1 <= 12 THEN '10-12' WHEN p_size - 1 <= 16 THEN '13-16' WHEN p_size - 1 <= 25 THEN '17-25' ELSE '26+' END AS band FROM part)) GROUP BY band"""
)
def band_binning(table):
    df = table("part").select(R.floor_band(F.col("p_size") - 1).alias("band"))
    return df.withColumn("code", R.encoded(F.col("band"), R.FLOOR_BAND_CODES)).groupBy("band").agg(F.count("*").alias("n"), F.sum("code").alias("codes"))


@query(
    """SELECT label, count(*)::BIGINT AS n FROM (SELECT CASE WHEN contains(lower(trim(p_type)), 'steel') THEN 'metal' WHEN contains(lower(trim(p_type)), 'stee') OR contains(lower(trim(p_type)), 'brass') THEN 'alloy'
  WHEN contains(lower(trim(p_type)), 'e') THEN 'other-e' ELSE 'none' END AS label FROM part) GROUP BY label"""
)
def category_ordered_contains(table):
    rules = [(("steel",), "metal"), (("stee", "brass"), "alloy"), (("e",), "other-e")]
    return table("part").select(R.first_match(F.col("p_type"), rules, "none").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


@query(
    """WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
SELECT p_partkey, array_to_string(w, '|') AS tags, len(w)::INT AS tag_count, w[1] AS primary_tag FROM t"""
)
def tags_parse(table):
    text = F.concat(F.lit("['"), F.array_join(F.split("p_name", " "), "', '"), F.lit("']"))
    df = table("part").select("p_partkey", R.tags(text).alias("t"))
    return df.select("p_partkey", F.array_join("t", "|").alias("tags"), F.size("t").alias("tag_count"), F.coalesce(F.get("t", F.lit(0)), F.lit("неизвестно")).alias("primary_tag"))


@query(
    r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(translate(lower(text), 'ё', 'е'), '\([^)]*\)', ' ', 'g'), '[,.;]+', ' ', 'g'), '[\s\x0B]+', ' ', 'g'))) AS clean_md5 FROM documents"""
)
def text_normalise(table):
    return table("documents").select("doc_id", F.md5(address.clean_text(F.col("text")).cast("binary")).alias("clean_md5"))


@query(
    """SELECT c_custkey, 'г санкт петербург ул имени ' || ['ада', 'бор', 'вера'][1 + c_custkey % 3] || ' ' || (1 + c_custkey % 90) || CASE WHEN c_custkey % 4 > 0 THEN ' корп' || (c_custkey % 4) ELSE '' END
  || CASE c_custkey % 5 WHEN 0 THEN ' лита' WHEN 1 THEN ' литб' ELSE '' END AS addr_norm FROM customer"""
)
def token_extract(table):
    k = F.col("c_custkey")
    name = F.get(F.array(*map(F.lit, ("Ада", "Бор", "Вера"))), k % 3)
    house = (1 + k % 90).cast("string")
    line = F.concat(F.lit("г. СПб, "), F.lit("ул. имени "), name, F.lit(", д. "), house, F.when(k % 5 == 1, "Б").otherwise(""), F.when(k % 4 > 0, F.concat(F.lit(", к. "), (k % 4).cast("string"))).otherwise(""), F.when(k % 5 == 0, ", лит. А (двор)").otherwise(""))
    return address.parse_line(table("customer").select("c_custkey", line.alias("line")), "line").select("c_custkey", "addr_norm")


@query(
    """SELECT s_suppkey, 'г санкт петербург ' || ['ул', 'линия', 'пр-кт'][1 + s_suppkey % 3] || ' ' || lower(s_name) || CASE WHEN s_suppkey > 0 THEN ' ' || s_suppkey || '/2' || CASE WHEN s_nationkey > 0 THEN ' корп' || s_nationkey ELSE '' END || CASE WHEN s_suppkey % 2 = 1 THEN ' лита' ELSE '' END ELSE '' END AS addr_norm
FROM supplier"""
)
def split_address(table):
    k = F.col("s_suppkey")
    df = table("supplier").select(
        "s_suppkey", F.get(F.array(*map(F.lit, ("улица", "Линия", "пр-т"))), k % 3).alias("type_street"), F.concat(F.lit(" "), "s_name").alias("name_street"),
        F.concat(k.cast("string"), F.when(k % 2 == 1, "А").otherwise("")).alias("number"), F.lit("2").alias("fraction"), F.col("s_nationkey").cast("string").alias("housing"),
    )
    return address.parse_parts(df).select("s_suppkey", "addr_norm")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 OR c_nationkey > 4 THEN concat_ws(' ', n_name, CASE WHEN c_custkey % 3 > 0 THEN c_custkey::VARCHAR END, CASE WHEN c_nationkey > 4 THEN 'к' || c_nationkey END) END AS addr_full,
  coalesce(n_name, '') || '_' || coalesce(c_mktsegment, '') AS eda_key FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def key_concat(table):
    df = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    number = F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey").cast("string"))
    housing = F.when(F.col("c_nationkey") > 4, F.col("c_nationkey").cast("string"))
    eda = F.concat_ws("_", *[F.coalesce(c, F.lit("")) for c in ("n_name", "c_mktsegment")])
    return df.select("c_custkey", address.address_key(F.col("n_name"), number, housing, F.lit(None).cast("string")).alias("addr_full"), eda.alias("eda_key"))


@query(f"""SELECT key, area, (2 * (x1 - x0 + y1 - y0))::DOUBLE AS perimeter, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy, 5 AS points, round(2 * pi() * sqrt(area) / (2 * (x1 - x0 + y1 - y0)), 6) AS npi, 'Polygon' AS kind, x0::DOUBLE AS xmin, y1::DOUBLE AS ymax FROM ({RECTANGLES})""")
def rect_measures(table):
    df = rectangles(table).withColumn("g", G.parsed(G.written(G.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))))
    g = F.col("g")
    x, y = G.centroid(g)
    df = df.select("key", G.area(g).alias("area"), G.perimeter(g).alias("perimeter"), x.alias("cx"), y.alias("cy"), G.complexity(g).alias("points"), G.kind(g).alias("kind"), *[c for c in G.bounds(g) if "xmin" in str(c) or "ymax" in str(c)])
    return rounded(df.withColumn("npi", G.compactness(F.col("area"), F.col("perimeter"))), "npi", "cx", "cy", "area", "perimeter").select("key", "area", "perimeter", "cx", "cy", "points", "npi", "kind", "xmin", "ymax")


def _utm_sql() -> str:
    n = G.FLATTENING / (2 - G.FLATTENING)
    radius = G.AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    a = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    term = lambda f, g: " + ".join(f"{v:.17e} * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, v in enumerate(a, 1))
    return f"""WITH t AS (SELECT p_partkey, 29 + (p_partkey % 250) / 100 AS lon, 59.4e0 + (p_partkey % 97) / 100 AS lat FROM part),
e AS (SELECT *, {2 * n**0.5 / (1 + n):.17e} AS e, sin(radians(lat)) AS s, radians(lon - 33) AS d FROM t),
u AS (SELECT *, sinh(atanh(s) - e * atanh(e * s)) AS q FROM e),
v AS (SELECT *, atan2(q, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + q * q)) AS eta FROM u)
SELECT p_partkey, round(500000 + {0.9996 * radius:.17e} * (eta + {term("cos", "sinh")}), 3) AS east, round({0.9996 * radius:.17e} * (xi + {term("sin", "cosh")}), 3) AS north FROM v"""


@query(_utm_sql())
def utm_project(table):
    k = F.col("p_partkey")
    x, y = G.utm(29 + (k % 250) / 100, 59.4 + (k % 97) / 100)
    return table("part").select("p_partkey", F.round(x, 3).alias("east"), F.round(y, 3).alias("north"))


@query(f"WITH {PAIRS} SELECT a_idx, b_idx FROM p")
def spatial_join_rect(table):
    df = rectangles(table)
    return spatial.boxes_that_meet(df.filter("side = 0"), df.filter("side = 1"), 32.0).select("a_idx", "b_idx")


@query(f"WITH {PAIRS} SELECT a_idx, b_idx, inter AS inter_area, round(iou, 6) AS iou, round(mc, 6) AS max_cover, round(sr, 6) AS size_ratio, round(dn, 6) AS centroid_dist_norm, round(score, 6) AS score FROM s")
def pair_scores(table):
    df = pairs_of(table).select("a_idx", "b_idx", "inter_area", "iou", "max_cover", "size_ratio", "centroid_dist_norm", "score")
    return rounded(df, "iou", "max_cover", "size_ratio", "centroid_dist_norm", "score")


@query(f"WITH {PAIRS} SELECT a_idx, b_idx, round(score, 6) AS score, ra::INT AS rank_a, rb::INT AS rank_b FROM e")
def edges_top2(table):
    return rounded(edges_of(table).select("a_idx", "b_idx", "score", "rank_a", "rank_b"), "score")


@query(f"WITH RECURSIVE {COMPONENTS} SELECT node, cluster FROM c")
def components(table):
    return matching.clusters(edges_of(table)).select("node", "cluster")


@query(
    f"""WITH RECURSIVE {COMPONENTS},
n AS (SELECT cluster, count(*) FILTER (WHERE node % 2 = 0) AS n_a, count(*) FILTER (WHERE node % 2 = 1) AS n_b FROM c GROUP BY cluster)
SELECT cluster, n_a::BIGINT AS n_a_nodes, n_b::BIGINT AS n_b_nodes, CASE WHEN n_a = 1 AND n_b = 1 THEN '1x1' WHEN n_a = 1 THEN '1xN' WHEN n_b = 1 THEN 'Nx1' ELSE 'NxN' END AS comp_type FROM n"""
)
def component_types(table):
    return matching.component_types(matching.clusters(edges_of(table)), ["cluster"]).select("cluster", F.col("n_A").alias("n_a_nodes"), F.col("n_B").alias("n_b_nodes"), "comp_type")


def in_clusters(table) -> tuple[DataFrame, DataFrame]:
    edges = cut(edges_of(table))
    members = matching.clusters(edges)
    return edges.withColumn("node", matching.node("A", "a_idx")).join(members.select("node", "cluster"), "node"), members


@query(
    f"""WITH RECURSIVE {COMPONENTS},
w AS (SELECT e.*, c.cluster, dense_rank() OVER (PARTITION BY c.cluster, a_idx ORDER BY rs DESC) AS la, dense_rank() OVER (PARTITION BY c.cluster, b_idx ORDER BY rs DESC) AS lb FROM e JOIN c ON c.node = a_idx * 2)
SELECT cluster, a_idx, b_idx FROM w WHERE (la = 1 AND lb = 1) OR (score >= 0.55 AND iou >= 0.2 AND dn <= 1.5) OR (mc >= 0.85 AND sr >= 0.6)"""
)
def refine_edges(table):
    return matching.refined_edges(in_clusters(table)[0]).select("cluster", "a_idx", "b_idx")


@query(
    f"""WITH RECURSIVE {COMPONENTS},
d AS (SELECT c.node, c.cluster, r.x0, r.y0, r.x1, r.y1, c.node % 2 AS s FROM c JOIN r ON r.idx = c.node // 2 AND r.side = c.node % 2)
SELECT a.node AS src, b.node AS dst FROM d a, d b WHERE a.cluster = b.cluster AND a.s = b.s AND a.node < b.node
  AND pow(greatest(a.x0 - b.x1, b.x0 - a.x1, 0), 2) + pow(greatest(a.y0 - b.y1, b.y0 - a.y1, 0), 2) <= 9"""
)
def adjacent_members(table):
    members = in_clusters(table)[1]
    boxes = rectangles(table).select(F.when(F.col("side") == 0, "A").otherwise("B").alias("side"), "idx", *spatial.BOX)
    across = lambda c: F.greatest(F.col(f"x_{c}min") - F.col(f"y_{c}max"), F.col(f"y_{c}min") - F.col(f"x_{c}max"), F.lit(0.0))
    return matching.adjacent(members.join(boxes, ["side", "idx"]).drop("idx"), F.hypot(across("x"), across("y")) <= matching.GAP)


@query(
    f"""WITH {PAIRS},
o AS (SELECT a_idx, b_idx, iou, inter / area_a AS sa, inter / area_b AS sb, 5 + a_idx % 4 AS ca, 5 + b_idx % 3 AS cb, 1.0 + (a_idx % 5) / 10 AS ar FROM e),
v AS (SELECT *, 0.35 * ca / (ca + cb) + 0.3 * sa + 0.2 * iou + 0.1 + 0.05 * (1 - least(abs(ln(ar)), 2) / 2) AS va, 0.35 * cb / (ca + cb) + 0.3 * sb + 0.2 * iou + 0.1 AS vb FROM o)
SELECT a_idx, b_idx, round(va, 6) AS score_a, round(vb, 6) AS score_b, CASE WHEN va > vb + 0.03 THEN 'A' WHEN vb > va + 0.03 THEN 'B' WHEN ca >= cb THEN 'A_tie' ELSE 'B_tie' END AS repr_source FROM v"""
)
def repr_choice(table):
    e = edges_of(table)
    groups = e.select(
        "a_idx", "b_idx", F.lit(1).alias("n_a"), F.lit(1).alias("n_b"), (5 + F.col("a_idx") % 4).alias("c_a"), (5 + F.col("b_idx") % 3).alias("c_b"),
        F.col("iou").alias("iou_ab"), F.col("cover_a").alias("support_a"), F.col("cover_b").alias("support_b"), (1.0 + (F.col("a_idx") % 5) / 10).alias("area_ratio_a"),
    )
    return rounded(matching.representative(groups).select("a_idx", "b_idx", "score_a", "score_b", "repr_source"), "score_a", "score_b")


@query(
    """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS lead FROM orders GROUP BY 1, 2),
m AS (SELECT o_custkey, arg_max(o_orderpriority, row(n, -lead)) AS mode FROM c GROUP BY 1)
SELECT o.o_custkey, round(median(o_totalprice), 6) AS median, max(o_totalprice) AS most, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids, any_value(mode) AS mode FROM orders o JOIN m ON o.o_custkey = m.o_custkey GROUP BY 1"""
)
def group_median_mode(table):
    orders = table("orders")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",")
    stats = orders.groupBy("o_custkey").agg(F.round(F.median("o_totalprice"), 6).alias("median"), F.max("o_totalprice").alias("most"), ids.alias("ids"))
    return stats.join(matching.mode_first(orders, ["o_custkey"], "o_orderpriority", "o_orderkey", "mode"), "o_custkey", "left")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def left_lookup(table):
    return table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_members(table):
    return table("customer").join(table("orders").filter("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    """SELECT l_returnflag, count(*)::BIGINT AS n, sum(w)::BIGINT AS weights FROM (
  SELECT l_returnflag, CASE WHEN l_quantity > 100 THEN 8 WHEN l_quantity > 50 THEN 5 WHEN l_quantity > 30 THEN 2 ELSE 1 END AS w, l_quantity FROM (SELECT l_returnflag, l_quantity * 1.2 AS l_quantity FROM lineitem)
  CROSS JOIN range(0, 4) AS t(k) WHERE k = 0 OR l_quantity > 50) GROUP BY 1"""
)
def union_augment(table):
    df = table("lineitem").select("l_orderkey", "l_returnflag", (F.col("l_quantity") * 1.2).alias("q"), F.col("l_extendedprice").alias("area_m2"))
    out = learning.augmented(df, "l_orderkey", "q", ["area_m2"]).withColumn("w", learning.weight(F.col("q")))
    return out.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("w").cast("long").alias("weights"))


NEAR = f"""WITH r AS ({RECTANGLES}), c AS (SELECT key AS idx, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, CASE WHEN key % 4 > 0 THEN v END AS v FROM r),
n AS (SELECT a.idx, b.idx AS other, b.v, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS dist FROM c a JOIN c b ON a.idx <> b.idx AND abs(a.x - b.x) <= 40 AND abs(a.y - b.y) <= 40)"""


def centres(table) -> DataFrame:
    return rectangles(table).select(F.col("key").alias("idx"), F.col("px").alias("x"), F.col("py").alias("y"), F.when(F.col("key") % 4 > 0, F.col("v")).alias("v"))


@query(f"{NEAR} SELECT idx, round(min(dist), 6) AS nearest FROM n GROUP BY idx")
def knn_distance(table):
    return rounded(spatial.nearest_distance(centres(table), 20.0), "nearest")


@query(
    f"""{NEAR} SELECT c.idx, round(count(*) FILTER (WHERE dist <= 10) / (pi() * 100), 9) AS kde_10, round(count(*) FILTER (WHERE dist <= 20) / (pi() * 400), 9) AS kde_20, round(count(*) FILTER (WHERE dist <= 30) / (pi() * 900), 9) AS kde_30,
  round(count(*) FILTER (WHERE dist <= 40) / (pi() * 1600), 9) AS kde_40 FROM c LEFT JOIN n ON c.idx = n.idx GROUP BY c.idx"""
)
def kde_radius(table):
    points = centres(table)
    out = spatial.densities(spatial.within_radius(points, 40.0), points, [10.0, 20.0, 30.0, 40.0])
    return rounded(out, "kde_10", "kde_20", "kde_30", "kde_40", digits=9)


@query(
    f"""{NEAR} SELECT c.idx, round(avg(n.v), 6) AS mean_value, round(median(n.v), 6) AS median_value, round(CASE WHEN count(n.v) >= 4 THEN quantile_cont(n.v, 0.75) END, 6) AS p75_value, round(stddev_pop(n.v), 5) AS std_value, round(max(n.v) - min(n.v), 6) AS range_value, count(n.idx)::BIGINT AS n_neighbours
FROM c LEFT JOIN n ON c.idx = n.idx AND dist <= 20 GROUP BY c.idx"""
)
def neighbour_stats(table):
    points = centres(table)
    out = spatial.neighbour_statistics(spatial.within_radius(points, 20.0, "v"), points, "v", 20.0)
    return rounded(rounded(out, "mean_value", "median_value", "p75_value", "range_value"), "std_value", digits=5)


@query(
    """WITH q AS (SELECT quantile_cont(p_retailprice, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM part),
z AS (SELECT CASE WHEN p_retailprice <= e[2] THEN 0 WHEN p_retailprice <= e[3] THEN 1 WHEN p_retailprice <= e[4] THEN 2 WHEN p_retailprice <= e[5] THEN 3 ELSE 4 END AS zone, CASE WHEN p_partkey % 3 > 0 THEN p_size END AS s FROM part, q)
SELECT zone, count(*)::BIGINT AS n, round(avg(s), 6) AS mean FROM z GROUP BY zone"""
)
def qcut_zone_mean(table):
    df = features.quantile_zones(table("part"), "p_retailprice")
    return df.groupBy("zone").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("p_partkey") % 3 > 0, F.col("p_size"))), 6).alias("mean"))


def gaps(table) -> DataFrame:
    return table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("a"), F.when(F.col("l_tax") > 0.07, F.col("l_discount")).alias("b"), F.col("l_extendedprice").alias("c"))


@query(
    """WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN l_quantity END AS a, CASE WHEN l_tax > 0.07 THEN l_discount END AS b FROM lineitem),
m AS (SELECT median(a) AS ma, median(b) AS mb FROM g)
SELECT l_orderkey, l_linenumber, coalesce(a, ma) AS a, coalesce(b, mb) AS b, (a IS NULL)::INT AS a_was_nan, (b IS NULL)::INT AS b_was_nan FROM g, m"""
)
def impute_flags(table):
    df = gaps(table).drop("c")
    rates = learning.null_rates(df, ["a", "b"])
    return learning.imputed(df, learning.medians(df, ["a", "b"]), [c for c in ("a", "b") if rates[c] > learning.FLAG_NULL])


@query(
    """WITH g AS (SELECT avg((l_linenumber = 1)::INT) AS a, avg((NOT l_tax > 0.07)::INT) AS b, 0.0 AS c FROM lineitem)
SELECT name, round(rate, 6) AS rate, rate <= 0.8 AS kept FROM (UNPIVOT g ON a, b, c INTO NAME name VALUE rate)"""
)
def null_rate_select(table):
    df = gaps(table)
    rates = learning.null_rates(df, ["a", "b", "c"])
    rows = [(c, round(r, 6), r <= learning.MOST_NULL) for c, r in rates.items()]
    return df.sparkSession.createDataFrame(rows, "name string, rate double, kept boolean")


@query(
    """SELECT x, y, round(r, 6) AS r, abs(r) > 0.95 AS close FROM (
  SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, corr(l_quantity, l_extendedprice) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'double_quantity', corr(l_quantity, 2 * l_quantity + l_tax) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'double_quantity', corr(l_extendedprice, 2 * l_quantity + l_tax) FROM lineitem UNION ALL SELECT 'l_quantity', 'constant', NULL UNION ALL SELECT 'l_extendedprice', 'constant', NULL UNION ALL SELECT 'double_quantity', 'constant', NULL)"""
)
def corr_filter(table):
    df = table("lineitem").select("l_quantity", "l_extendedprice", (2 * F.col("l_quantity") + F.col("l_tax")).alias("double_quantity"), F.lit(1.0).alias("constant"))
    found = learning.correlations(df, df.columns)
    rows = [(a, b, None if r is None else round(r, 6), None if r is None else abs(r) > learning.MOST_CORRELATED) for (a, b), r in found.items()]
    return df.sparkSession.createDataFrame(rows, "x string, y string, r double, close boolean")


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, count(*)::BIGINT AS n FROM lineitem")
def linear_trend(table):
    out = profiling.trend(table("lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), "n")


@query()
def rf_predict(table):
    """A forest for prices from size and kind; a fifth of the parts has no price to learn from. All parts are predicted."""
    df = table("part").select("p_partkey", F.col("p_size").cast("double").alias("size"), (F.col("p_partkey") % 1000).cast("double").alias("place"), F.length("p_type").cast("double").alias("kind"), F.col("p_retailprice").alias("price"))
    df = df.withColumn("price", F.when(F.col("p_partkey") % 5 > 0, F.col("price")))
    model = learning.fit(df.filter("price is not null"), "p_partkey", "price", ["size", "place", "kind"])
    return learning.predicted(model, df, "predicted").select("p_partkey", "predicted")


@query()
def rf_importance(table):
    df = table("part").select("p_partkey", F.col("p_size").cast("double").alias("size"), (F.col("p_partkey") % 1000).cast("double").alias("place"), F.col("p_retailprice").alias("price"))
    model = learning.fit(df, "p_partkey", "price", ["size", "place"])
    return learning.importances(model, ["size", "place"], df)


@query(
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 60)), 59)::INT AS bin, count(*)::BIGINT AS n FROM orders, b GROUP BY 1"""
)
def hist_bins(table):
    return profiling.histogram(table("orders"), "o_totalprice", 60)


ERRORS = "SELECT row_number() OVER () AS k, l_quantity AS actual, l_extendedprice / 1500 AS guess FROM lineitem"


def errors(table) -> DataFrame:
    return table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("actual"), (F.col("l_extendedprice") / 1500).alias("guess"))


@query(
    f"""WITH e AS ({ERRORS}), r(range, low, high) AS (VALUES (0, 0.0::DOUBLE, 6.0::DOUBLE), (1, 6, 12), (2, 12, 20), (3, 20, 30), (4, 30, 50), (5, 50, 200), (6, 200, 300))
SELECT range, low, high, round(coalesce(avg(abs(guess - actual)), 0), 6) AS mae, count(actual)::BIGINT AS n FROM r LEFT JOIN e ON actual >= low AND actual < high GROUP BY ALL"""
)
def mae_ranges(table):
    return rounded(profiling.error_ranges(errors(table), "actual", "guess", [0, 6, 12, 20, 30, 50, 200, 300]), "mae")


@query(f"WITH e AS ({ERRORS}) SELECT round(avg(abs(actual - guess)), 6) AS mae, round(1 - sum(pow(actual - guess, 2)) / (var_pop(actual) * count(*)), 6) AS r2 FROM e")
def fit_quality(table):
    return rounded(profiling.fit_quality(errors(table), "actual", "guess"), "mae", "r2")


@query(
    f"""WITH e AS ({ERRORS}), q AS (SELECT unnest(quantile_cont(guess, [{", ".join(f"{i}/30::DOUBLE" for i in range(31))}])) AS edge FROM e),
b AS (SELECT any_value(actual) AS actual, count(*) AS bin FROM e JOIN q ON guess >= edge GROUP BY k)
SELECT bin::INT AS bin, median(actual) AS median, count(*)::BIGINT AS n FROM b GROUP BY 1 HAVING count(*) >= 6"""
)
def binned_median_error(table):
    return profiling.binned_median(errors(table), "guess", "actual")


@query(
    """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
u AS (SELECT 'lang' AS column, count(*) FILTER (WHERE lang IS NULL) AS m, count(*) AS n FROM j UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL), count(*) FROM j UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM j)
SELECT "column", m::BIGINT AS n_missing, round(m * 100 / n, 6) AS pct_missing, round(100 - m * 100 / n, 6) AS pct_filled FROM u"""
)
def missing_profile(table):
    df = table("documents").select("doc_id", "lang").join(table("labels"), "doc_id", "left")
    return rounded(profiling.missing_profile(df, ["lang", "quality", "toxic"]), "pct_missing", "pct_filled")


@query(
    """WITH j AS (SELECT l.quality, l.toxic, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT ((lang IS NOT NULL)::INT + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT)::INT AS n_filled, count(*)::BIGINT AS n_rows FROM j GROUP BY 1"""
)
def filled_counts(table):
    return profiling.filled_counts(table("documents").select("doc_id", "lang").join(table("labels"), "doc_id", "left"), ["lang", "quality", "toxic"])


@query(
    """SELECT 'both' AS name, count(*) FILTER (WHERE l_quantity > 40 AND l_discount > 0.05)::BIGINT AS n FROM lineitem UNION ALL SELECT 'either', count(*) FILTER (WHERE l_quantity > 40 OR l_discount > 0.05) FROM lineitem
UNION ALL SELECT 'equal', count(*) FILTER (WHERE l_quantity = l_linenumber) FROM lineitem"""
)
def condition_counts(table):
    q, d = F.col("l_quantity") > 40, F.col("l_discount") > 0.05
    return profiling.condition_counts(table("lineitem"), {"both": q & d, "either": q | d, "equal": F.col("l_quantity") == F.col("l_linenumber")})


@query(
    """WITH t AS (SELECT *, nullif(event_type, 'error') AS kind FROM events)
SELECT a.check AS "check", n_failed::BIGINT AS n_failed, round(n_failed * 100 / n, 6) AS pct, CASE WHEN n_failed = 0 THEN 'ok' WHEN n_failed * 100 / n < 5 THEN 'warn' ELSE 'bad' END AS status FROM (
  SELECT 'no_user' AS check, count(*) FILTER (WHERE user_id IS NULL) AS n_failed, count(*) AS n FROM t UNION ALL SELECT 'negative', count(*) FILTER (WHERE value < 0), count(*) FROM t
  UNION ALL SELECT 'large', count(*) FILTER (WHERE value > 90), count(*) FROM t UNION ALL SELECT 'rare_user', count(*) FILTER (WHERE user_id % 40 = 0), count(*) FROM t) a"""
)
def quality_scorecard(table):
    checks = {"no_user": F.col("user_id").isNull(), "negative": F.col("value") < 0, "large": F.col("value") > 90, "rare_user": F.col("user_id") % 40 == 0}
    return rounded(profiling.scorecard(table("events"), checks), "pct")


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def value_counts(table):
    return profiling.value_counts(table("documents"), "source")


@query(
    """WITH c AS (SELECT nullif(lang, 'fr') AS v, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY v IS NULL, n DESC, v) AS k FROM c)
SELECT CASE WHEN v IS NULL THEN 'missing' WHEN k <= 1 THEN v ELSE 'other' END AS label, sum(n)::BIGINT AS n FROM r GROUP BY 1"""
)
def value_counts_other(table):
    return profiling.top_with_rest(table("documents").select(F.nullif("lang", F.lit("fr")).alias("lang")), "lang", 1)


@query("SELECT count(DISTINCT user_id)::BIGINT AS users, count(DISTINCT event_type)::BIGINT AS kinds, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS names FROM events")
def nunique(table):
    return table("events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("kinds"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("names"))


@query("SELECT user_id, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def having_gt1(table):
    return table("events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).filter("n > 1")


@query(
    """SELECT count(l_extendedprice)::BIGINT AS n, min(l_extendedprice) AS low, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(median(l_extendedprice), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99, round(avg(l_extendedprice), 4) AS mean, max(l_extendedprice) AS high, round(stddev_samp(l_extendedprice), 4) AS std FROM lineitem"""
)
def summary_stats(table):
    out = profiling.summary(table("lineitem"), "l_extendedprice")
    return rounded(rounded(out, "q1", "median", "q3", "p95", "p99"), "mean", "std", digits=4)


@query(
    """WITH q AS (SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS m, quantile_cont(o_totalprice, 0.75) AS q3, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderpriority, any_value(n)::BIGINT AS n, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3, min(o_totalprice) AS whisker_low, max(o_totalprice) AS whisker_high
FROM orders JOIN q ON g = o_orderpriority WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1"""
)
def box_by_group(table):
    return rounded(profiling.box_plot(table("orders"), "o_totalprice", "o_orderpriority"), "q1", "median", "q3")


@query("SELECT l_suppkey, round(avg(l_quantity), 6) AS mean, median(l_quantity) AS median, min(l_quantity) AS low, max(l_quantity) AS high, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 5")
def grouped_stats(table):
    by = table("lineitem").groupBy("l_suppkey")
    return by.agg(F.round(F.avg("l_quantity"), 6).alias("mean"), F.median("l_quantity").alias("median"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.count("*").alias("n")).filter("n >= 5")


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey)::BIGINT AS rank, round(row_number() OVER (ORDER BY o_totalprice, o_orderkey) / (count(*) OVER ()), 9) AS ecdf FROM orders")
def ecdf(table):
    return rounded(profiling.ecdf(table("orders"), "o_totalprice", "o_orderkey"), "ecdf", digits=9)


@query()
def normal_plot(table):
    return profiling.normal_plot(errors(table).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), (F.col("actual") - F.col("guess")).alias("error")), "error", "key")


@query("(SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20) UNION ALL (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20)")
def topk_bottomk(table):
    o = table("orders")
    take = lambda side, order: o.orderBy(order, "o_orderkey").limit(20).select(F.lit(side).alias("side"), "o_orderkey", "o_totalprice")
    return take("top", F.desc("o_totalprice")).unionByName(take("bottom", F.asc("o_totalprice")))


@query(
    """WITH g AS (SELECT count(*) AS n FROM (SELECT md5(text) AS k FROM documents) GROUP BY k)
SELECT sum(n)::BIGINT AS n_rows, count(*)::BIGINT AS n_keys, (sum(n) - count(*))::BIGINT AS n_dropped, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS n_repeated FROM g"""
)
def dup_counts(table):
    return dedupe.duplicate_counts(table("documents").select(F.md5(F.col("text").cast("binary")).alias("k")), ["k"])


@query(
    """WITH t AS (SELECT l_quantity * 3 AS a, l_extendedprice / 1000 AS b FROM lineitem), d AS (SELECT abs(a - b) AS abs_diff, abs(a - b) / greatest(b, 0.01) AS rel FROM t)
SELECT round(median(abs_diff), 6) AS median_abs, round(quantile_cont(rel, 0.95), 6) AS p95_rel, count(*) FILTER (WHERE rel <= 0.1)::BIGINT AS within_10, count(*) FILTER (WHERE rel <= 0.4)::BIGINT AS within_40 FROM d"""
)
def consistency_error(table):
    t = table("lineitem").select((F.col("l_quantity") * 3).alias("a"), (F.col("l_extendedprice") / 1000).alias("b"))
    d = t.select(F.abs(F.col("a") - F.col("b")).alias("abs_diff"), (F.abs(F.col("a") - F.col("b")) / F.greatest("b", F.lit(0.01))).alias("rel"))
    at = lambda c, share: F.round(F.lit((quantiles(d, c, [share]) or [None])[0]).cast("double"), 6)
    return d.agg(at("abs_diff", 0.5).alias("median_abs"), at("rel", 0.95).alias("p95_rel"), F.count_if(F.col("rel") <= 0.1).alias("within_10"), F.count_if(F.col("rel") <= 0.4).alias("within_40"))


@query(r"""SELECT count(*) FILTER (WHERE NOT regexp_matches(v, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'))::BIGINT AS n_text, count(*)::BIGINT AS n FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_size || 'd' ELSE p_size::VARCHAR END AS v FROM part)""")
def non_numeric(table):
    v = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("d"))).otherwise(F.col("p_size").cast("string"))
    df = table("part").select(v.alias("v"), R.number(v).alias("n"))
    return df.agg(F.count_if(F.col("n").isNull() & F.col("v").isNotNull()).alias("n_text"), F.count("*").alias("n"))


@query("WITH c AS (SELECT quantile_cont(p_retailprice, 0.95) AS p FROM part) SELECT p_partkey, least(p_retailprice, p) AS price_capped FROM part, c")
def capped_values(table):
    return profiling.capped(table("part"), "p_retailprice").select("p_partkey", F.col("p_retailprice_capped").alias("price_capped"))


@query()
def hash_sample(table):
    """A report over a sample of fixed size, which is the feature."""
    return profiling.sampled(table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 8000)


@query(
    f"""WITH r AS ({RECTANGLES}) SELECT key, greatest(x1 - x0, y1 - y0)::DOUBLE AS length, least(x1 - x0, y1 - y0)::DOUBLE AS width, round(greatest(x1 - x0, y1 - y0) / least(x1 - x0, y1 - y0), 6) AS ratio, 1.0::DOUBLE AS fill, 1.0::DOUBLE AS convexity FROM r"""
)
def shape_measures(table):
    df = rectangles(table).select("key", features.shape(G.written(G.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))).alias("s"))
    out = df.select("key", F.col("s.bbox_length").alias("length"), F.col("s.bbox_width").alias("width"), F.col("s.bbox_ratio").alias("ratio"), F.col("s.bbox_fill_ratio").alias("fill"), F.col("s.convexity").alias("convexity"))
    return rounded(out, "length", "width", "ratio", "fill", "convexity")


@query(f"WITH {PAIRS} SELECT a_idx, b_idx, round(inter, 4) AS inter_area FROM p")
def polygon_overlay(table):
    df = rectangles(table).withColumn("wkt", G.written(G.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])))
    return rounded(matching.candidates(df.filter("side = 0"), df.filter("side = 1"), 32.0).select("a_idx", "b_idx", "inter_area"), "inter_area", digits=4)
