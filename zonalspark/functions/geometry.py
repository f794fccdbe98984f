"""Planar and spherical geometry of rings as higher-order column expressions.

A ring is array<struct<x, y>>, closed: its last point is its first. A polygon is
an array of rings, the outer one first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH = 6371008.8
RING = "array<struct<x:double,y:double>>"


def edges(ring: Column) -> Column:
    """array<struct<x1, y1, x2, y2>> of neighbouring points."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, F.greatest(n - 1, F.lit(0))), F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def _sum(array: Column, f) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, e: acc + f(e))


def signed_area(ring: Column) -> Column:
    """Shoelace; positive if counter-clockwise."""
    return _sum(edges(ring), lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2


def polygon_area(rings: Column) -> Column:
    """The outer ring's area less those of the holes."""
    areas = F.transform(rings, lambda r: F.abs(signed_area(r)))
    return F.greatest(2 * F.get(areas, F.lit(0)) - _sum(areas, lambda a: a), F.lit(0.0))


def geodesic_area(ring: Column) -> Column:
    """Square metres of a ring in degrees on the sphere, unsigned."""
    rad = F.radians
    return F.abs(_sum(edges(ring), lambda e: rad(e["x2"] - e["x1"]) * (2 + F.sin(rad(e["y1"])) + F.sin(rad(e["y2"]))))) * EARTH * EARTH / 2


def centroid(ring: Column) -> Column:
    """struct(x, y) weighted by the shoelace; the mean of the points if the area is 0."""
    a = signed_area(ring)
    cross = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]

    def middle(k: str) -> Column:
        weighted = _sum(edges(ring), lambda e: (e[f"{k}1"] + e[f"{k}2"]) * cross(e)) / F.nullif(6 * a, F.lit(0.0))
        plain = F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + p[k]) / F.size(ring)
        return F.coalesce(weighted, plain).alias(k)

    return F.struct(middle("x"), middle("y"))


def within(x: Column, y: Column, rings: Column) -> Column:
    """Ray casting over all rings: an odd number of crossings; points on an edge belong to one side only."""
    def crosses(e):
        spans = (e["y1"] > y) != (e["y2"] > y)
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(F.flatten(F.transform(rings, edges)), F.lit(0), lambda acc, e: acc + crosses(e)) % 2 == 1


def point_line_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance to the line through a and b, or to a if they coincide."""
    d = F.hypot(bx - ax, by - ay)
    return F.when(d == 0, F.hypot(px - ax, py - ay)).otherwise(F.abs((bx - ax) * (ay - py) - (ax - px) * (by - ay)) / F.nullif(d, F.lit(0.0)))


def bounds(points: Column) -> Column:
    """struct(min_x, min_y, max_x, max_y) of a ring."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def vertex_count(polygons: Column) -> Column:
    """Points of all rings of all polygons."""
    return F.aggregate(F.flatten(polygons), F.lit(0), lambda acc, r: acc + F.size(r))
