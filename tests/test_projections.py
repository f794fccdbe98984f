"""Projections: the same as expressions and step by step over a table, and no value is computed twice."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from zonalspark import plans
from zonalspark.functions import krovak, tiles

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan()


@pytest.mark.parametrize("name", ["reprojected_points", "projected_points"])
def test_a_value_of_a_projection_is_written_once(spark, name):
    text = _plan(plans.queries()[name](spark, FOLDER)).toString().upper()
    assert text.count("ATAN2(") + text.count("HYPOT(") < 40


def test_compiled_methods_stay_small(spark):
    df = plans.queries()["reprojected_points"](spark, FOLDER)
    df.collect()
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenString(_plan(df))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_vectors_are_dealt_to_tasks(spark):
    assert "Exchange" in _plan(plans.queries()["reprojected_points"](spark, FOLDER)).toString()


@pytest.mark.parametrize("epsg", [3857, 5514, 32633])
def test_a_table_is_projected_as_expressions_are(spark, epsg):
    places = [(k, 12.1 + k % 7, 48.6 + k % 5 / 2) for k in range(35)] + [(35, None, 49.0), (36, 15.0, None)]
    df = spark.createDataFrame(places, "`a.b` int, x double, y double")
    for route in ((4326, epsg), (4326, epsg, 4326)):
        x, y = F.col("x"), F.col("y")
        got = tiles.projected(df, x, y, *route, names=("u", "v"))
        assert got.columns == ["a.b", "x", "y", "u", "v"]
        u, v = tiles.project(x, y, *route[:2])
        want = df.select("`a.b`", u.alias("u"), v.alias("v"))
        if len(route) == 3:
            want = want.select("`a.b`", *(c.alias(k) for k, c in zip("uv", tiles.project(F.col("u"), F.col("v"), *route[1:]), strict=True)))
        want = {r[0]: r[1:] for r in want.collect()}
        for k, px, py, u, v in got.collect():
            assert (u, v) == (pytest.approx(want[k][0], abs=1e-8), pytest.approx(want[k][1], abs=1e-8)) or None in (px, py)
            if None in (px, py):
                assert (u, v) == want[k]
            elif len(route) == 3:
                assert (u, v) == (pytest.approx(px, abs=3e-8), pytest.approx(py, abs=3e-8))


def test_steps_end_at_any_number(spark, monkeypatch):
    df = spark.createDataFrame([(14.4378, 50.0755)], "x double, y double")
    seen = []
    for together in (1, 3, 14, 100):
        monkeypatch.setattr(krovak, "TOGETHER", together)
        seen.append(tuple(tiles.projected(df, F.col("x"), F.col("y"), 4326, 5514, names=("u", "v")).select("u", "v").first()))
    assert all(s == pytest.approx(seen[0], abs=1e-6) for s in seen)
