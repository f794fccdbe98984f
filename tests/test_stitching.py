"""Outlines of regions: rings by stitching in a task and by list ranking, holes, slivers and lobes."""

import random

import pytest
from pyspark.sql import functions as F

from zonalspark.functions import geometry
from zonalspark.operators import vector

SCHEMA = "zone int, region int, rings array<array<struct<x:double,y:double>>>"


def box(x, y, w=1.0, h=1.0):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def frame(spark, rows):
    shape = lambda rings: [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    return spark.createDataFrame([(i, region, shape(rings)) for i, (region, rings) in enumerate(rows)], SCHEMA)


def canonical(ring):
    ring = [tuple(p) if isinstance(p, tuple) else (p["x"], p["y"]) for p in ring][:-1]
    k = ring.index(min(ring))
    return tuple(ring[k:] + ring[:k]) if ring.count(min(ring)) == 1 else tuple(min(ring[i:] + ring[:i] for i in range(len(ring)) if ring[i] == min(ring)))


@pytest.mark.parametrize("seed", [1, 2])
def test_list_ranking_equals_stitching_on_random_tilings(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(3), [box(x, y)]) for x in range(14) for y in range(14)]
    edges = vector.outline(vector.turned(frame(spark, rows)), "region")
    want = set()
    for region in range(3):
        own = [tuple(r) for r in edges.filter(f"region = {region}").select("x1", "y1", "x2", "y2").collect()]
        want |= {(region, canonical(r)) for r in vector.stitch(own)}
    got = [(r["region"], canonical(r["ring"])) for r in vector.ranked_rings(edges, "region").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    # lobes that touch at a corner are apart: no outer ring is at a point twice but for holes that touch it
    split = vector.dissolve(vector.turned(frame(spark, rows)), group=60)
    whole = vector.dissolve(vector.turned(frame(spark, rows)))
    assert {(r["region"], canonical(r["ring"])) for r in split.collect()} == {(r["region"], canonical(r["ring"])) for r in whole.collect()} == want


def test_a_long_ring_takes_a_logarithm_of_rounds(spark, monkeypatch):
    n = 5000
    edges = spark.range(n).select(F.lit(1).alias("region"), *(f((F.col("id") + k) % n * 2 * 3.141592653589793 / n).alias(f"{a}{k + 1}") for k in (0, 1) for a, f in (("x", F.cos), ("y", F.sin))))
    rounds = []
    plain = vector.written
    monkeypatch.setattr(vector, "written", lambda df, kind: rounds.append(kind) or plain(df, kind))
    got = vector.ranked_rings(edges, "region").collect()
    assert len(got) == 1 and len(got[0]["ring"]) == n + 1 and rounds.count("rank") <= 16
    xy = [(p["x"], p["y"]) for p in got[0]["ring"]]
    assert xy[0] == xy[-1] and all((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2 < (7 / n) ** 2 for a, b in zip(xy, xy[1:]))


def test_what_closes_no_ring_is_left_out(spark):
    edges = [(1, *a, *b) for r in (box(0, 0),) for a, b in zip(r, r[1:])] + [(1, 5.0, 5.0, 6.0, 5.0), (1, 6.0, 5.0, 7.0, 5.0), (2, 0.0, 0.0, 1.0, 0.0)]
    df = spark.createDataFrame([tuple(map(float, e)) for e in edges], "region double, x1 double, y1 double, x2 double, y2 double")
    assert [(r["region"], canonical(r["ring"])) for r in vector.ranked_rings(df, "region").collect()] == [(1.0, canonical(box(0.0, 0.0)))]
    assert vector.ranked_rings(df.limit(0), "region").count() == 0


def test_dissolve_with_slivers_holes_and_a_lobe_apart(spark):
    """Sizes in degrees: boxes of a tenth are some square kilometres, slivers less than two."""
    t, s = 0.1, 0.005
    rows = [(1, [box(0, 0, t, t)]), (1, [box(t, 0, t, t)]), (1, [box(5 * t, 0, t, t)]), (1, [box(9 * t, 0, s, s)])]  # two that meet, a lobe, a sliver
    rows += [(2, [box(0, 2 * t, 3 * t, 3 * t), box(t, 3 * t, t, t)[::-1], box(2.5 * t, 2.2 * t, s, s)[::-1]])]  # a hole, and a sliver of one
    rows += [(3, [box(0, 9 * t, s, s)]), (3, [box(t, 9 * t, s / 2, s / 2)])]  # all of it small: the largest stays
    for group in (vector.GROUP, 2):
        out = vector.dissolve_polygons(frame(spark, rows)) if group == vector.GROUP else None
        if out is None:
            plain = vector.dissolve
            vector.dissolve = lambda *a, **k: plain(*a, **k | {"group": 2})
            try:
                out = vector.dissolve_polygons(frame(spark, rows))
            finally:
                vector.dissolve = plain
        got = sorted((r["region"], len(r["rings"]), round(r["flat"], 6)) for r in out.withColumn("flat", geometry.polygon_area(F.col("rings"))).collect())
        assert got == [(1, 1, round(t * t, 6)), (1, 1, round(2 * t * t, 6)), (2, 2, round(8 * t * t, 6)), (3, 1, round(s * s, 6))]
