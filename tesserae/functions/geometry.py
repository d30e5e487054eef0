"""Polygons as nested arrays: parts, rings (the outline first), closed lists of points. Native column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<struct<x: double, y: double>>>>"

#: The WGS 84 ellipsoid, the zone's middle meridian, scale and false easting.
AXIS, FLATTENING, MERIDIAN, SCALE, EASTING = 6378137.0, 1 / 298.257223563, 33.0, 0.9996, 500000.0
#: Metres of a degree of latitude, and of longitude as taken here.
LAT_M, LON_M = 111320.0, 55660.0


def parsed(wkt: Column) -> Column:
    """Polygons and multipolygons from WKT; null for anything else."""
    text = F.upper(F.trim(wkt))
    body = F.regexp_replace(text, r"^(MULTI)?POLYGON\s*Z?\s*", "")
    pairs = F.regexp_replace(body, r"(-?[0-9.]+(?:E[+-]?[0-9]+)?)\s+(-?[0-9.]+(?:E[+-]?[0-9]+)?)(?:\s+-?[0-9.E+-]+)?", '{"x":$1,"y":$2}')
    listed = F.translate(pairs, "()", "[]")
    json = F.when(F.startswith(text, F.lit("POLYGON")), F.concat(F.lit("["), listed, F.lit("]"))).when(F.startswith(text, F.lit("MULTIPOLYGON")), listed)
    ok = lambda g: F.forall(g, lambda p: (F.size(p) > 0) & F.forall(p, lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1))))
    # as an item of an array the text is read once; each mention of from_json() reads it anew
    return F.get(F.transform(F.array(F.from_json(json, GEOMETRY)), lambda g: F.when(ok(g) & (F.size(g) > 0), g)), F.lit(0))


def written(geom: Column) -> Column:
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p.getField("x"), p.getField("y"))), ", "), F.lit(")"))
    polygon = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))
    one = F.concat(F.lit("POLYGON "), polygon(F.get(geom, F.lit(0))))
    return F.when(F.size(geom) == 1, one).when(F.size(geom) > 1, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(geom, polygon), ", "), F.lit(")")))


def summed(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + value(x))


def segments(ring: Column) -> Column:
    n = F.size(ring) - 1
    return F.arrays_zip(F.slice(ring, 1, n).alias("a"), F.slice(ring, 2, n).alias("b"))


def over_ring(ring: Column, value) -> Column:
    """Sum over a ring's sides of value(x1, y1, x2, y2)."""
    n = F.size(ring) - 1
    sides = F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: value(a.getField("x"), a.getField("y"), b.getField("x"), b.getField("y")))
    return summed(sides, lambda v: v)


def ring_area(ring: Column) -> Column:
    """Signed. Taken from the first point, which keeps digits where coordinates are large."""
    o = F.get(ring, F.lit(0))
    return over_ring(ring, lambda x, y, u, v: (x - o.getField("x")) * (v - o.getField("y")) - (u - o.getField("x")) * (y - o.getField("y"))) / 2


def over_rings(geom: Column, value) -> Column:
    """Outlines count, holes are taken off."""
    polygon = lambda p: value(F.get(p, F.lit(0))) - summed(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), value)
    return summed(geom, polygon)


def area(geom: Column) -> Column:
    return over_rings(geom, lambda r: F.abs(ring_area(r)))


def perimeter(geom: Column) -> Column:
    length = lambda r: over_ring(r, lambda x, y, u, v: F.hypot(u - x, v - y))
    return summed(geom, lambda p: summed(p, length))


def centroid(geom: Column) -> tuple[Column, Column]:
    """The centre of area."""
    start = F.get(F.get(F.get(geom, F.lit(0)), F.lit(0)), F.lit(0))
    ox, oy = start.getField("x"), start.getField("y")

    def moment(pick):
        cross = lambda x, y, u, v: ((x - ox) * (v - oy) - (u - ox) * (y - oy)) * pick(x - ox, y - oy, u - ox, v - oy) / 6
        return over_rings(geom, lambda r: F.signum(ring_area(r)) * over_ring(r, cross))

    size = area(geom)
    return ox + F.try_divide(moment(lambda x, y, u, v: x + u), size), oy + F.try_divide(moment(lambda x, y, u, v: y + v), size)


def part_count(geom: Column) -> Column:
    return F.size(geom)


def complexity(geom: Column) -> Column:
    """Points of all outlines, closing ones included; 0 for no geometry."""
    return F.coalesce(F.aggregate(geom, F.lit(0), lambda a, p: a + F.size(F.get(p, F.lit(0)))), F.lit(0))


def kind(geom: Column) -> Column:
    return F.when(F.size(geom) > 1, "MultiPolygon").when(F.size(geom) == 1, "Polygon")


def bounds(geom: Column) -> list[Column]:
    points = F.flatten(F.transform(geom, lambda p: F.get(p, F.lit(0))))
    xs, ys = F.transform(points, lambda p: p.getField("x")), F.transform(points, lambda p: p.getField("y"))
    return [F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")]


def approx_m2(degrees2: Column) -> Column:
    return F.round(degrees2, 10) * LAT_M * LON_M


def compactness(size: Column, length: Column) -> Column:
    return F.try_divide(2 * math.pi * F.sqrt(size), length)


def utm(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing of zone 36 by the Krueger series to the third order (under a millimetre in the zone)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    e = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    across = F.radians(lon - MERIDIAN)
    xi = F.atan2(t, F.cos(across))
    eta = F.atanh(F.sin(across) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EASTING + SCALE * radius * east, SCALE * radius * north


def projected(geom: Column) -> Column:
    def move(p: Column) -> Column:
        x, y = utm(p.getField("x"), p.getField("y"))
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(geom, lambda p: F.transform(p, lambda r: F.transform(r, move)))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))))
