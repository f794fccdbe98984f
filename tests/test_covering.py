"""Points in polygons by cells that hold only the edges inside of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from zonalspark.operators import vector

SCHEMA = "id int, rings array<array<struct<x:double,y:double>>>"


def star(rng, x, y, r, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(x + r * rng.uniform(0.3, 1) * math.cos(t), y + r * rng.uniform(0.3, 1) * math.sin(t)) for t in angles]
    return ring + ring[:1]


def frame(spark, polygons):
    return spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]) for i, rings in polygons], SCHEMA)


def within(x, y, rings):
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                n += 1
    return n % 2 == 1


@pytest.mark.parametrize("cell", [0.5, 1.0, 3.7])
def test_same_answers_as_ray_casting(spark, cell):
    rng = random.Random(int(cell * 10))
    polygons = [(i, [star(rng, rng.uniform(-6, 6), rng.uniform(-6, 6), rng.uniform(0.2, 4), rng.randrange(3, 30))]) for i in range(25)]
    polygons += [(30, [star(rng, 0, 0, 9, 60), [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]])]  # with a hole on the lines of cells
    polygons += [(31, [[(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0)]]), (31, [[(3.0, 3.0), (5.0, 3.0), (5.0, 5.0), (3.0, 5.0), (3.0, 3.0)]])]  # two parts that overlap
    polygons += [(32, [[(0.0, 0.0), (7.4, 7.4), (0.0, 7.4), (0.0, 0.0)]]), (33, [[(0.0, 7.4), (7.4, 0.0), (7.4, 7.4), (0.0, 7.4)]])]  # edges through the corners of cells
    points = [(rng.uniform(-10, 10), rng.uniform(-10, 10)) for _ in range(1500)] + [(x / 2 + 0.001, y / 2) for x in range(-12, 12) for y in range(-12, 12)] + [(float(x), y + 0.123) for x in range(-9, 9) for y in range(-9, 9)]
    df = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(points)], "k int, x double, y double")
    got = {r["k"]: r["id"] for r in vector.points_in_polygons(df, frame(spark, polygons), cell).collect()}
    want = {k: max((i for i, rings in polygons if within(x, y, rings)), default=None) for k, (x, y) in enumerate(points)}
    assert got == want and len(set(want.values())) > 10


def test_rows_by_cell_are_bounded_by_edges(spark):
    """A large polygon: cells inside have no edges, those of the border only their own, and each edge is in the cells that it passes."""
    n = 400
    ring = [(100 * math.cos(2 * math.pi * k / n), 100 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    cells = vector.covering(frame(spark, [(1, [ring + ring[:1]])]), 5.0).withColumn("n", F.size("edges")).collect()
    assert len(cells) == len({(r["cx"], r["cy"]) for r in cells})
    inner = [r for r in cells if r["n"] == 0]
    assert all(r["inside"] for r in inner) and len(inner) == sum(all((5 * (x + i)) ** 2 + (5 * (y + j)) ** 2 < 99.9**2 for i in (0, 1) for j in (0, 1)) for x in range(-21, 21) for y in range(-21, 21))
    assert sum(r["n"] for r in cells) < 2 * n and max(r["n"] for r in cells) < 12


def test_inner_join_and_empty(spark):
    polygons = frame(spark, [(1, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])])
    points = spark.createDataFrame([(1, 0.5, 0.25), (2, 9.0, 9.0), (3, None, 1.0)], "k int, x double, y double")
    assert [tuple(r) for r in vector.points_in_polygons(points, polygons, 1.0, how="inner").collect()] == [(1, 0.5, 0.25, 1)]
    assert {r["k"]: r["id"] for r in vector.points_in_polygons(points, polygons.limit(0), 1.0).collect()} == {1: None, 2: None, 3: None}
