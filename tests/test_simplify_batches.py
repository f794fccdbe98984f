"""Simplification of many rings together, and of one ring for many tolerances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from test_operators import _plain_simplify

from zonalspark.functions import geometry
from zonalspark.operators import vector
from zonalspark.plans import vector as queries

FOLDER = "/root/testdata/sf0.001"
TOLERANCES = (0.0, 0.02, 0.1, 0.4)


def _rings(n: int) -> list[list[tuple[float, float]]]:
    """Rings of 1 to 70 points; every third with places on a lattice, which are the same distance from a chord."""
    rng = np.random.RandomState(3)
    out = []
    for i in range(n):
        size = rng.randint(1, 70)
        xy = rng.rand(size, 2) if i % 3 else rng.randint(0, 4, (size, 2)) / 4
        out.append([tuple(p) for p in xy.tolist()])
        out[-1].append(out[-1][0])
    return out


def _short(ring, tolerance):
    want = _plain_simplify(ring, tolerance)
    return ring if len(ring) < 5 or len(want) < 4 else want


def _frame(spark, rings):
    rows = [(i, r and [{"x": x, "y": y} for x, y in r], TOLERANCES[i % 4]) for i, r in enumerate(rings)]
    return spark.createDataFrame(rows, f"id int, ring {geometry.RING}, tolerance double")


def test_sweep_is_a_simplification_for_each_tolerance(spark):
    rings = _rings(150)
    df = vector.tolerance_sweep(_frame(spark, rings), TOLERANCES)
    got = {r["tolerance"]: (r["points_before"], r["points_after"]) for r in df.collect()}
    before = sum(map(len, rings))
    assert got == {t: (before, sum(len(_short(r, t)) for r in rings)) for t in TOLERANCES}
    assert len({after for _, after in got.values()}) > 2


def test_sweep_cuts_a_ring_once(spark):
    plan = vector.tolerance_sweep(_frame(spark, _rings(3)), TOLERANCES)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


@pytest.mark.parametrize("points", [1, 60, 10**6])
def test_rings_of_a_batch_are_cut_together(monkeypatch, points):
    monkeypatch.setattr(vector, "POINTS", points)
    rings = _rings(60)
    rings[5], rings[6], rings[59] = [], None, None
    # without Spark's workers, which have their own modules
    given = pa.array([r if r is None else [{"x": x, "y": y} for x, y in r] for r in rings], pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    seen = 0
    for some, points, xy, ends in vector._together(given):
        survives = vector.survival(xy, ends[:-1], ends[1:] - 1, np.zeros(len(ends) - 1))
        for t in TOLERANCES:
            limits = np.full(len(ends) - 1, t)
            keep, counts = vector._stay(xy, ends, survives, limits)
            for k, ring in enumerate(rings[some]):
                got = [(p["x"], p["y"]) for p, stays in zip(points[ends[k] : ends[k + 1]].to_pylist(), keep[ends[k] : ends[k + 1]], strict=True) if stays]
                assert got == _short(ring or [], t) and counts[k] == len(got)
        seen += len(ends) - 1
    assert seen == len(rings)


def test_rings_that_are_empty_or_null_stay(spark):
    rings = _rings(40)
    rings[3], rings[4] = [], None
    df = _frame(spark, rings)
    got = {r["id"]: r["ring"] and [(p["x"], p["y"]) for p in r["ring"]] for r in vector.simplify(df).collect()}
    assert got == {i: None if r is None else _short(r, TOLERANCES[i % 4]) for i, r in enumerate(rings)} | {3: []}
    assert vector.simplify(df).schema == df.schema and vector.simplify(df.filter("false")).count() == 0


def test_a_line_without_a_number_or_with_any_tolerance():
    line = np.array([(0, 0), (1, 2), (2, np.nan), (3, 1), (4, 0)], float)
    assert vector.douglas_peucker(line, 0.1).tolist() == [True, False, False, False, True]  # as argmax takes the first nan
    line[2] = (2, -1)
    assert vector.douglas_peucker(line, float("inf")).tolist() == [True, False, False, False, True]
    assert vector.douglas_peucker(line, float("nan")).tolist() == [True, False, False, False, True]
    assert vector.douglas_peucker(line, -1.0).all()


def test_rings_are_made_in_all_tasks(spark):
    assert queries._zigzag(spark, FOLDER).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
