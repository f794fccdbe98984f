"""Coverages: shared borders stay shared after simplification."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from zonalspark.operators import topology, vector

SCHEMA = "zone int, polygons array<array<array<struct<x:double,y:double>>>>"


def tiling(rng, n, rough):
    """n * n zones with rough borders that neighbours share; the middle one has an island in its hole."""
    node = {(i, j): (i + rng.uniform(-0.2, 0.2), j + rng.uniform(-0.2, 0.2)) for i in range(n + 1) for j in range(n + 1)}
    border = {}

    def path(a, b):
        key = min((a, b), (b, a))
        if key not in border:
            (ax, ay), (bx, by) = node[key[0]], node[key[1]]
            inner = [((ax + (bx - ax) * t / 12) + rng.uniform(-rough, rough), (ay + (by - ay) * t / 12) + rng.uniform(-rough, rough)) for t in range(1, 12)]
            border[key] = [node[key[0]], *inner, node[key[1]]]
        return border[key] if key[0] == a else border[key][::-1]

    out = {}
    for i in range(n):
        for j in range(n):
            corners = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1), (i, j)]
            ring = [p for a, b in zip(corners, corners[1:]) for p in path(a, b)[:-1]]
            out[i * n + j] = [[ring + ring[:1]]]
    middle = n // 2 * n + n // 2
    x, y = n // 2 + 0.5, n // 2 + 0.5
    from math import cos, pi, sin

    island = [(x + 0.12 * cos(t * pi / 10) + rng.uniform(-rough, rough) / 8, y + 0.12 * sin(t * pi / 10)) for t in range(20)]
    island += island[:1]
    out[middle][0].append(island[::-1])
    out[n * n] = [[island]]
    return out


def frame(spark, zones):
    shape = lambda polygons: [[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in polygons]
    return spark.createDataFrame([(z, shape(p)) for z, p in zones.items()], SCHEMA)


def plain(df):
    return {r["zone"]: [[[(p["x"], p["y"]) for p in ring] for ring in rings] for rings in r["polygons"]] for r in df.collect()}


def sides(zones):
    """Directed edges with their zone; shared borders are there once in each direction."""
    return [((a, b), z) for z, polygons in zones.items() for rings in polygons for ring in rings for a, b in zip(ring, ring[1:])]


def neighbours(zones):
    at = {}
    for (a, b), z in sides(zones):
        at.setdefault(min((a, b), (b, a)), set()).add(z)
    return {(p, q) for own in at.values() for p in own for q in own if p != q}


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def crossed(zones):
    edges = sorted({min((a, b), (b, a)) for (a, b), _ in sides(zones)})
    turn = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return [(e, f) for e, f in itertools.combinations(edges, 2) if not set(e) & set(f) and turn(*e, f[0]) * turn(*e, f[1]) <= 0 and turn(*f, e[0]) * turn(*f, e[1]) <= 0]


@pytest.mark.parametrize("rough, tolerance", [(0.02, 0.05), (0.06, 0.03), (0.05, 0.4)])
def test_no_gap_and_no_overlap(spark, rough, tolerance):
    rng = random.Random(int(100 * rough))
    zones = tiling(rng, 4, rough)
    if crossed(zones):  # a start without crossings, so that none may come
        zones = tiling(random.Random(77), 4, rough / 3)
    assert not crossed(zones)
    got = plain(topology.simplify_coverage(frame(spark, zones), tolerance, "zone"))
    assert set(got) == set(zones) and neighbours(got) == neighbours(zones)
    assert all(len(got[z]) == len(zones[z]) and [len(r) for r in got[z]] == [len(r) for r in zones[z]] for z in zones)
    edges = [e for e, _ in sides(got)]
    assert len(edges) == len(set(edges))
    # what has no other side is the outline: all else cancels, so the zones' areas are the outline's
    alone = [(a, b) for a, b in edges if (b, a) not in set(edges)]
    assert sum(area(r) for p in got.values() for rings in p for r in rings) == pytest.approx(sum(a[0] * b[1] - b[0] * a[1] for a, b in alone) / 2)
    assert all(area(rings[0]) > 0 for p in got.values() for rings in p) and not crossed(got)
    points = lambda zones: sum(len(r) for p in zones.values() for rings in p for r in rings)
    assert points(got) < (0.5 if tolerance > rough else 0.95) * points(zones)
    for ring in (r for p in got.values() for rings in p for r in rings):
        assert ring[0] == ring[-1] and len(ring) >= 4
    kept = {p for polygons in zones.values() for rings in polygons for ring in rings for p in ring}
    assert all(p in kept for polygons in got.values() for rings in polygons for ring in rings for p in ring)


def test_a_thin_zone_does_not_collapse_and_its_neighbours_keep_its_border(spark):
    thin = [(0, 0), (1, 0.01), (2, 0), (1, -0.01), (0, 0)]
    above = [(0, 0), (1, 0.01), (2, 0), (2, 1), (0, 1), (0, 0)]
    below = [(0, -1), (2, -1), (2, 0), (1, -0.01), (0, 0), (0, -1)]
    zones = {1: [[[(float(x), float(y)) for x, y in thin[::-1]]]], 2: [[[(float(x), float(y)) for x, y in above]]], 3: [[[(float(x), float(y)) for x, y in below]]]}
    got = plain(topology.simplify_coverage(frame(spark, zones), 0.5, "zone"))
    assert neighbours(got) == neighbours(zones) and abs(area(got[1][0][0])) == pytest.approx(0.02)


def test_crossings_against_every_pair(spark):
    rng = random.Random(3)
    lines = {i: [(rng.randrange(12) / 2, rng.randrange(12) / 2) for _ in range(rng.choice([2, 2, 3]))] for i in range(40)}
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in p]) for i, p in lines.items()], "arc int, now array<struct<x:double,y:double>>")
    turn = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    sign = lambda v: (v > 0) - (v < 0)
    span = lambda e, f, k: max(e[0][k], e[1][k]) >= min(f[0][k], f[1][k]) and max(f[0][k], f[1][k]) >= min(e[0][k], e[1][k])

    def meet(e, f):
        shared = sum(p == q for p in e for q in f)
        if not (span(e, f, 0) and span(e, f, 1)):
            return False
        if shared:
            return shared == 2
        return sign(turn(*e, f[0])) * sign(turn(*e, f[1])) <= 0 and sign(turn(*f, e[0])) * sign(turn(*f, e[1])) <= 0

    pieces = [(i, k, e) for i, p in lines.items() for k, e in enumerate(zip(p, p[1:]))]
    want = {(a[0], b[0]) for a, b in itertools.combinations(pieces, 2) if meet(a[2], b[2])}
    assert {tuple(r) for r in topology.crossings(df, 0.7).collect()} == want


def test_arcs_of_boxes(spark):
    box = lambda x, y: [[(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0), (x, y)]]
    zones = {1: [box(0.0, 0.0)], 2: [box(1.0, 0.0)], 3: [box(5.0, 5.0)]}
    cut = topology.arcs(topology.rings_of(frame(spark, zones), "zone"), "zone")
    assert cut.select("arc").distinct().count() == 4 and {r["zone"]: r["count"] for r in cut.groupBy("zone").count().collect()} == {1: 2, 2: 2, 3: 1}
    same = vector.adjacency(frame(spark, zones).select("zone", F.explode("polygons").alias("rings")))
    assert {tuple(r) for r in same.collect()} == {(1, 2), (2, 1)}
    assert plain(topology.simplify_coverage(frame(spark, {}), 0.1, "zone")) == {}
