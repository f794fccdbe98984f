"""Small fixtures with known results, and cases at the edges."""

from __future__ import annotations

import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalspark.functions import colour, formats
from zonalspark.functions.tdist import p_value, p_value_sql
from zonalspark.operators import compare, hist, regress, vector, zonal
from zonalspark.operators.grid import Grid
from zonalspark.params import Query
from zonalspark.sources import files, sinks


def _series(spark, values, first=2017):
    return spark.createDataFrame([(1, first + i, v, 1) for i, v in enumerate(values)], "g int, year int, value double, n int")


def test_zonal_two_by_two(spark):
    cells = spark.createDataFrame([(1, 1, 5, 0.2), (1, 1, 5, 0.4), (1, 2, 5, None), (1, 0, 5, 0.9), (1, 1, 5, float("nan"))], "year int, zone int, class int, value double")
    row = zonal.zonal_stats(cells).collect()
    assert len(row) == 1 and tuple(row[0])[:4] == (1, 1, 5, 2)
    assert tuple(row[0])[4:] == pytest.approx((0.3, 0.1, 0.2, 0.4))
    assert zonal.merge_partials(zonal.zonal_partials(cells)).collect()[0]["std_pop"] == pytest.approx(0.1)


def test_trend_of_a_line(spark):
    line = _series(spark, [0.5 + 0.01 * i for i in range(9)])
    row = regress.trend_table(line.withColumnRenamed("value", "mean"), ("g",)).collect()[0]
    assert row["ols_slope"] == pytest.approx(0.01) and row["theilsen_slope"] == pytest.approx(0.01) and row["ols_r2"] == pytest.approx(1)
    assert row["ols_pvalue"] is None and not row["flagged"]


@pytest.mark.parametrize(("values", "fitted", "influence"), [([0.5] * 9, True, True), ([0.1, 0.2, 0.4], False, False), ([0.1, 0.2, 0.4, 0.3], True, False)])
def test_trend_of_few_or_equal_years(spark, values, fitted, influence):
    row = regress.trend_table(_series(spark, values).withColumnRenamed("value", "mean"), ("g",)).collect()[0]
    assert row["n_years"] == len(values) and not row["flagged"]
    assert (row["ols_slope"] is not None) == fitted and (row["most_influential_year"] is not None) == influence
    if len(set(values)) == 1:
        assert row["ols_r2"] is None and row["ols_pvalue"] is None


def test_outlier_is_flagged(spark):
    row = regress.trend_table(_series(spark, [0.5, 0.501, 0.5, 0.502, 0.501, 0.5, 0.502, 0.501, 0.9]).withColumnRenamed("value", "mean"), ("g",)).collect()[0]
    assert row["flagged"] and row["most_influential_year"] == 2025


@pytest.mark.parametrize(("t", "df", "p"), [(2.365, 7, 0.04997), (3.499, 7, 0.01001), (0.0, 7, 1.0), (2.086, 20, 0.05)])
def test_p_values(spark, t, df, p):
    assert spark.range(1).select(F.expr(p_value_sql(f"{t}e0", df))).first()[0] == pytest.approx(p, abs=1e-5)


def test_p_values_of_any_df(spark):
    cases = [(t, df) for t in (0.0, 0.3, 2.1, -2.1, 9.0) for df in (1, 2, 3, 4, 5, 8, 29, 30)]
    rows = spark.createDataFrame(cases, "t double, df int").select("t", "df", p_value("t", "df").alias("p")).collect()
    want = spark.range(1).select(*(F.expr(p_value_sql(f"({t}e0)", df)) for t, df in cases)).first()
    assert [r["p"] for r in rows] == pytest.approx(list(want), abs=1e-12)
    many = spark.createDataFrame([(1.984, 100), (1.962, 1000), (2.0, 0), (None, 5)], "t double, df int").select(p_value("t", "df")).collect()
    assert many[0][0] == pytest.approx(0.05, abs=1e-4) and many[1][0] == pytest.approx(0.05, abs=1e-4) and many[2][0] is None and many[3][0] is None


def test_long_series_have_a_p_value(spark):
    rows = [(1, 1950 + i, 0.5 + 0.001 * i + (0.01 if i % 2 else -0.01), 1) for i in range(70)]
    got = regress.ols(spark.createDataFrame(rows, "g int, year int, value double, n int"), ("g",)).first()
    assert got["n_years"] == 70 and 0 <= got["p"] < 1e-6


def test_histogram_of_keys_without_counts(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.9), ("a", 5.0), ("b", 7.0), ("c", None)], "k string, value double")
    got = hist.histogram(df, 0.0, 1.0, 4, keys=("k",)).orderBy("k", "bin").collect()
    assert [(r["k"], r["bin"], r["count"], r["share"]) for r in got] == [(k, b, n, n / 2) for k in "abc" for b, n in enumerate([1, 0, 0, 1] if k == "a" else [0] * 4)]
    table = {r["k"]: r for r in hist.percentile_table(df, (0.0, 1.0, 4), key="k").collect()}
    assert set(table) == {"a", "b"} and table["a"]["valid"] == 3 and table["a"]["max"] == 5 and table["b"]["p50"] is None


def test_merged_variance_keeps_its_digits(spark):
    cells = spark.createDataFrame([(1, 1, 5, i % 3, 1e8 + i * 0.001) for i in range(9)], "year int, zone int, class int, block int, value double")
    merged = zonal.merge_partials(zonal.zonal_partials(cells, ("year", "zone", "class", "block"))).first()
    assert merged["std_pop"] == pytest.approx(0.001 * (60 / 9) ** 0.5, rel=1e-4)


def _square(x, y, side):
    return [[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]


def test_scanline_against_every_pixel(spark):
    rng = np.random.RandomState(4)
    shapes = [_square(1.03, 0.52, 2.2), [[(0.1, 0.2), (4.9, 2.3), (2.2, 4.8), (1.9, 1.7), (0.1, 0.2)]]]
    for _ in range(6):
        ring = [tuple(p) for p in (rng.rand(7, 2) * 6 - 0.5).tolist()]
        shapes.append([[*ring, ring[0]], [(1.0, 1.0), (1.5, 1.0), (1.5, 1.5), (1.0, 1.5), (1.0, 1.0)]])
    grid = Grid(0.0, 5.0, 0.25, 0.25, 20, 20)
    rows = [(i, i, [[{"x": x, "y": y} for x, y in ring] for ring in s]) for i, s in enumerate(shapes)]
    df = spark.createDataFrame(rows, "id int, ord int, rings array<array<struct<x:double,y:double>>>")
    got = {(r["row"], r["col"]): r["value"] for r in vector.rasterize(df, grid).collect()}
    want = {}
    for i, s in enumerate(shapes):
        for row in range(20):
            for col in range(20):
                x, y = grid.x0 + (col + 0.5) * grid.dx, grid.y0 - (row + 0.5) * grid.dy
                crossings = sum(1 for ring in s for (x1, y1), (x2, y2) in zip(ring, ring[1:]) if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
                if crossings % 2:
                    want[row, col] = i
    assert got == want


def test_points_that_share_an_id_keep_their_own_polygon(spark):
    df = spark.createDataFrame([(7, [[{"x": x, "y": y} for x, y in r] for r in _square(0.0, 0.0, 1.0)]), (9, [[{"x": x, "y": y} for x, y in r] for r in _square(0.5, 0.5, 2.0)])], "id int, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 0.2, 0.2), (1, 0.7, 0.7), (1, 9.0, 9.0), (1, 0.2, 0.2)], "point_id int, x double, y double")
    assert sorted((r["x"], r["id"]) for r in vector.points_in_polygons(points, df, 0.5).collect()) == [(0.2, 7), (0.2, 7), (0.7, 9), (9.0, None)]
    assert vector.points_in_polygons(points, df, 0.5, how="inner").count() == 3


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, -0.1, 1.1)], "value double")
    assert [r["count"] for r in hist.histogram(df, 0.0, 1.0, 2).orderBy("bin").collect()] == [1, 2]
    stats = hist.range_stats(df, 0.0, 1.0).first()
    assert (stats["below"], stats["above"]) == (1, 1)


def test_percentiles_without_rows(spark):
    empty = spark.createDataFrame([], "value double")
    assert all(r["value"] is None for r in hist.percentiles(hist.histogram(empty, 0.0, 1.0, 10)).collect())


def test_ranks_and_boards(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 1, 2.0), (3, 1, 1.0), (4, 1, None)], "zone int, region int, value double")
    assert [(r["zone"], r["region_rank"], r["region_n"]) for r in compare.ranks(df).orderBy("zone").collect()] == [(1, 1, 3), (2, 1, 3), (3, 3, 3)]
    for n, half in ((1, 0), (2, 1), (3, 1), (9, 4), (10, 5), (12, 5)):
        zones = spark.createDataFrame([(i, 1, float(i)) for i in range(n)], "zone int, region int, value double")
        sides = [r["side"] for r in compare.leaderboard(zones).collect()]
        assert sides.count("best") == sides.count("worst") == half


def test_median_of_others(spark):
    values = [1.0, 2.0, 4.0, 10.0, None]
    df = spark.createDataFrame([(i, 1, v) for i, v in enumerate(values)] + [(9, 2, 3.0)], "zone int, region int, value double")
    got = {r["zone"]: r["median_others"] for r in compare.region_median_of_others(df).collect()}
    for i in range(5):
        assert got[i] == np.median([v for k, v in enumerate(values) if k != i and v is not None])
    assert got[9] is None


def test_dominant_and_other(spark):
    shares = spark.createDataFrame([(1, 2020, "A", 0.4), (1, 2020, "F", 0.4), (1, 2020, "G", 0.2), (1, 2020, "U", None)], "zone int, year int, bucket string, share double")
    assert compare.dominant(shares).first()["dominant"] == "F"
    counts = spark.createDataFrame([(1, "F", i, 10 - i) for i in range(8)], "zone int, bucket string, raster_id int, n long")
    got = {r["item"]: r["n"] for r in compare.top_and_other(counts).collect()}
    assert len(got) == 7 and got["Other"] == 4 + 3


@pytest.mark.parametrize(("t", "text"), [(0.0, "#b54836"), (0.5, "#ffffff"), (1.0, "#326ea8"), (-1.0, "#b54836"), (2.0, "#326ea8")])
def test_ramp(spark, t, text):
    assert spark.range(1).select(F.lower(colour.to_hex(colour.change_colour(F.lit(t))))).first()[0] == text


def test_short_names():
    names = formats.short_names(["Permanent crops a", "Permanent crops b", "Permanent crops c"])
    assert list(names.values()) == ["Permanent ", "Permanent1", "Permanent2"]


def test_ids(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 7)], "code string, raster_id int")
    seen = spark.createDataFrame([("b",), ("c",), ("d",), ("c",)], "code string")
    assert sorted(map(tuple, zonal.assign_ids(existing, seen).collect())) == [("b", 7), ("c", 8), ("d", 9)]


def test_rings():
    square = np.array([(0, 0), (1, 0), (1, 1), (0, 0)], float)
    assert vector.simplify_ring(square, 10).tolist() == square.tolist()
    teeth = np.array([(i / 10, (i % 2) * 0.001) for i in range(20)] + [(1, 5), (0, 0)], float)
    assert 4 <= len(vector.simplify_ring(teeth, 0.01)) < len(teeth)


def test_years_and_links(spark):
    paths = spark.createDataFrame([("x/zonal_2019_v2.csv",), ("x/none.csv",)], "p string")
    assert [r[0] for r in paths.select(files.year_of(F.col("p"))).collect()] == [2019, None]
    asked = Query.of_link("#m=change&p=F&f=2024&t=2018&y=1900&o=12", tuple(range(2017, 2026)))
    assert (asked.mode, asked.key, asked.first, asked.last, asked.year, asked.zone) == ("change", "F", 2017, 2024, 2024, "12")
    assert Query.of_link(asked.link(), tuple(range(2017, 2026))) == asked


def test_geojson_there_and_back(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    body = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"KOD": k}, "geometry": {"type": t, "coordinates": c}} for k, t, c in ((1, "Polygon", [ring]), (2, "MultiPolygon", [[ring], [ring]]))]}
    (tmp_path / "a.json").write_text(json.dumps(body))
    got = files.read_geojson(spark, str(tmp_path / "a.json"), "KOD int")
    assert {r["KOD"]: len(r["polygons"]) for r in got.collect()} == {1: 1, 2: 2}
    assert json.loads(sinks.features(got.filter("KOD = 2")).first()["value"])["geometry"]["coordinates"] == [[ring], [ring]]


def test_zipped_shapefile(spark, tmp_path):
    points = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    record = struct.pack("<i4d2ii", 5, 0, 0, 1, 1, 1, 4, 0) + b"".join(struct.pack("<2d", *p) for p in points)
    shape = bytes(100) + struct.pack(">2i", 1, len(record) // 2) + record
    field = b"KOD".ljust(11, b"\0") + b"C" + bytes(4) + bytes([4, 0]) + bytes(14)
    table = struct.pack("<4BIHH", 3, 24, 1, 1, 1, 65, 5) + bytes(20) + field + b"\r" + b" 12  "
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("a/s.shp", shape), z.writestr("a/s.dbf", table), z.writestr("__MACOSX/._s.shp", b"")
    row = files.read_shapefiles(spark, str(tmp_path), ["KOD"]).first()
    assert (row["KOD"], [(p["x"], p["y"]) for p in row["rings"][0]]) == ("12", points)
    with pytest.raises(ValueError, match="several"):
        files.one_shapefile(["a.shp", "b.shp"])
    with pytest.raises(FileNotFoundError):
        files.one_shapefile(["a.dbf"])


def test_download_csv(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a "b", c', None), (1, "plain", 1.5)], "zone int, name string, v double")
    sinks.write_download(df, str(tmp_path / "out"), ["zone"])
    text = next((tmp_path / "out").glob("part-*")).read_bytes().decode()
    assert text == '﻿zone,name,v\r\n1,plain,1.5\r\n2,"a ""b"", c",\r\n'
    assert sinks.fixed(df, {"v": 4}).orderBy("zone").first()["v"] == "1.5000"


def test_failures_are_reported():
    def work(x):
        if x == "b":
            raise ValueError("no")

    assert sinks.each("abc", work) == [("b", "ValueError: no")]


def test_national_grid_and_its_datum(spark):
    from zonalspark.functions import krovak, tiles

    one = spark.range(1)
    # the example of the public guidance note, on the grid's own ellipsoid
    lon, lat = 16 + 50 / 60 + 59.179 / 3600, 50 + 12 / 60 + 32.442 / 3600
    x, y = one.select(*krovak.grid_of(F.lit(lon), F.lit(lat))).first()
    assert (x, y) == (pytest.approx(-568990.995, abs=0.02), pytest.approx(-1050538.631, abs=0.02))
    assert tuple(one.select(*krovak.degrees_of(F.lit(x), F.lit(y))).first()) == (pytest.approx(lon, abs=1e-9), pytest.approx(lat, abs=1e-9))
    for lon, lat in ((14.4378, 50.0755), (12.2, 50.1), (18.8, 49.5), (16.6, 48.7)):
        for epsg in (5514, 3857, 32633):
            back = one.select(*tiles.project(*tiles.project(F.lit(lon), F.lit(lat), 4326, epsg), epsg, 4326)).first()
            assert tuple(back) == (pytest.approx(lon, abs=3e-8), pytest.approx(lat, abs=3e-8))  # 3 mm
    x, y = one.select(*tiles.project(F.lit(14.4378), F.lit(50.0755), 4326, 5514)).first()
    assert abs(x + 743_000) < 1500 and abs(y + 1_043_500) < 1500  # the middle of Prague
    # on the central meridian, north is the scaled length of the meridian
    assert tuple(one.select(*tiles.to_utm(F.lit(15.0), F.lit(50.0), 33)).first()) == (pytest.approx(500000), pytest.approx(5538630.7, abs=0.1))


def test_grid_checks():
    own = Grid.of_bounds(0.0, 0.0, 95.0, 41.0, 10.0)
    assert (own.width, own.height, own.dx, own.dy, own.y0) == (10, 5, 9.5, 8.2, 41.0)
    own.same(Grid.of_bounds(0.0, 0.0, 95.0, 41.0, 10.0))
    with pytest.raises(ValueError, match="grids differ"):
        own.same(Grid.of_bounds(0.0, 0.0, 95.0, 42.0, 10.0))


def _plain_simplify(points, tolerance):
    """Douglas-Peucker as it is told, by recursion."""
    if len(points) < 3:
        return points
    (ax, ay), (bx, by) = points[0], points[-1]
    length = np.hypot(bx - ax, by - ay)
    away = [np.hypot(x - ax, y - ay) if length == 0 else abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / length for x, y in points[1:-1]]
    k = int(np.argmax(away)) + 1
    if away[k - 1] <= tolerance:
        return [points[0], points[-1]]
    return _plain_simplify(points[: k + 1], tolerance)[:-1] + _plain_simplify(points[k:], tolerance)


def test_simplify_against_recursion(spark):
    rng = np.random.RandomState(6)
    rings = []
    for i in range(30):
        n = rng.randint(3, 60)
        ring = [tuple(p) for p in (rng.rand(n, 2)).tolist()]
        rings.append((i, [*ring, ring[0]], float(rng.choice([0.01, 0.1, 0.3]))))
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r], t) for i, r, t in rings], "id int, ring array<struct<x:double,y:double>>, tolerance double")
    got = {r["id"]: [(p["x"], p["y"]) for p in r["ring"]] for r in vector.simplify(df).collect()}
    for i, ring, tolerance in rings:
        want = _plain_simplify(ring, tolerance)
        assert got[i] == (ring if len(ring) < 5 or len(want) < 4 else want)


def _polygon(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]


def test_dissolve_keeps_lobes_and_real_holes(spark):
    ring = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 2), (3, 2), (3, 3), (0, 3)]  # a C, closed by a bar: the hole is the region's
    bar = [(2, 1), (3, 1), (3, 2), (2, 2)]
    c = [(0, 0), (3, 0), (3, 1), (2, 1), (1, 1), (1, 2), (2, 2), (3, 2), (3, 3), (0, 3)]
    rows = [
        (1, "A", _polygon(c)), (2, "A", _polygon(bar[::-1])), (3, "A", _polygon([(9, 9), (9.001, 9), (9.001, 9.001), (9, 9.001)])),
        (4, "B", _polygon([(20, 0), (20.001, 0), (20.001, 0.001), (20, 0.001)])), (5, "D", _polygon([(30, 0), (31, 0), (31, 1), (30, 1)], [(30.2, 0.2), (30.3, 0.2), (30.3, 0.3), (30.2, 0.3)], [(30.5, 0.5), (30.5001, 0.5), (30.5001, 0.5001), (30.5, 0.5001)])),
    ]
    df = spark.createDataFrame(rows, "id int, region string, rings array<array<struct<x:double,y:double>>>")
    got = {r["region"]: r["rings"] for r in vector.dissolve_polygons(df).collect()}
    assert {k: len(v) for k, v in got.items()} == {"A": 2, "B": 1, "D": 2}  # slivers go, but for the only lobe of B
    assert {(p["x"], p["y"]) for p in got["A"][1]} == {(1, 1), (2, 1), (2, 2), (1, 2)} and len(ring) == 8
    same = spark.createDataFrame([(1, "E", _polygon([(0, 0), (1, 0), (1, 1)])), (2, "E", _polygon([(0, 0), (1, 0), (1, 1)]))], df.schema)
    assert [len(r["rings"]) for r in vector.dissolve_polygons(same, least_m2=0.0).collect()] == [1, 1]  # every edge cancels: the members stay


def test_unique_and_duplicate_years(spark, tmp_path):
    from zonalspark.operators import reshape

    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b")], "zone int, class int, v string")
    assert sorted(map(tuple, reshape.unique(df, "zone", "class").collect())) == [(1, 2, "a"), (1, 3, "b")]
    with pytest.raises(Exception, match="comes twice"):
        reshape.unique(df, "zone").collect()
    twice = spark.createDataFrame([(5, 1, 1, 0.1), (5, 1, 1, 0.2)], "year int, zone int, class int, mean double")
    with pytest.raises(Exception, match="comes twice"):
        zonal.zonal_matrix(twice, [1]).collect()
    for name in ("a_2019.csv", "b_2019.csv", "c_2020.csv"):
        (tmp_path / name).write_text("v\n1\n")
    with pytest.raises(ValueError, match="2019"):
        files.yearly_csv(spark, str(tmp_path), "v int")
    (tmp_path / "b_2019.csv").unlink()
    assert sorted(tuple(r) for r in files.yearly_csv(spark, str(tmp_path), "v int").collect()) == [(1, 2019), (1, 2020)]


@pytest.mark.parametrize(("kind", "pack"), [("u1", True), ("i2", False), ("f4", True), ("f8", False)])
def test_tiff_round_trip(spark, tmp_path, kind, pack):
    from zonalspark.sources import rasters

    values = (np.arange(70 * 33).reshape(70, 33) % 201).astype(kind)
    (tmp_path / "a.tif").write_bytes(rasters.tiff_bytes(values, x0=100.0, y0=200.0, dx=2.0, dy=3.0, nodata=7, rows=16, pack=pack))
    got = {(r["row"], r["col"]): r["value"] for r in rasters.pixels(rasters.read_tiff(spark, str(tmp_path))).collect()}
    assert got == {(r, c): None if values[r, c] == 7 else float(values[r, c]) for r in range(70) for c in range(33)}
    assert rasters.read_tiff(spark, str(tmp_path)).count() == 5
    assert tuple(rasters.placement(spark, str(tmp_path)).first()) == ("a.tif", 100.0, 200.0, 2.0, 3.0, 33, 70)


def test_tiled_tiff_with_differences(spark, tmp_path):
    import zlib

    from zonalspark.sources import rasters

    values = np.arange(5 * 6, dtype=">u2").reshape(5, 6) * 3
    padded = np.zeros((8, 8), ">u2")
    padded[:5, :6] = values
    tiles = []
    for r in (0, 4):
        for c in (0, 4):
            part = padded[r : r + 4, c : c + 4].astype(np.int64)
            tiles.append(zlib.compress((np.diff(part, axis=1, prepend=0) % 65536).astype(">u2").tobytes()))
    tags = [(256, 3, [6]), (257, 3, [5]), (258, 3, [16]), (259, 3, [8]), (317, 3, [2]), (322, 3, [4]), (323, 3, [4]), (324, 4, [0] * 4), (325, 4, [len(t) for t in tiles]), (339, 3, [1])]
    at = 8 + 2 + 12 * len(tags) + 4
    firsts = [at + 32 + sum(len(t) for t in tiles[:k]) for k in range(4)]
    head = b""
    for tag, kind, v in tags:
        body = struct.pack(f">{len(v)}{'HI'[kind == 4]}", *v)
        head += struct.pack(">HHI", tag, kind, len(v)) + (body.ljust(4, b"\0") if len(body) <= 4 else struct.pack(">I", at if tag == 324 else at + 16))
    raw = b"MM\0*" + struct.pack(">IH", 8, len(tags)) + head + bytes(4) + struct.pack(">4I", *firsts) + struct.pack(">4I", *map(len, tiles)) + b"".join(tiles)
    (tmp_path / "t.tif").write_bytes(raw)
    got = {(r["row"], r["col"]): r["value"] for r in rasters.pixels(rasters.read_tiff(spark, str(tmp_path))).collect()}
    assert got == {(r, c): float(values[r, c]) for r in range(5) for c in range(6)}


def test_nodata_is_each_files_own(spark, tmp_path):
    from zonalspark.sources import rasters

    for name, nodata in (("a_2019.tif", 1), ("b_2020.tif", 2)):
        (tmp_path / name).write_bytes(rasters.tiff_bytes(np.array([[1, 2, 3]], "u1"), nodata=nodata))
    got = rasters.pixels(rasters.read_tiff(spark, str(tmp_path))).groupBy("file").agg(F.array_sort(F.collect_list("value")).alias("v")).collect()
    assert {r["file"]: r["v"] for r in got} == {"a_2019.tif": [2, 3], "b_2020.tif": [1, 3]}


def test_grids_of_one_shape_in_two_places_differ():
    with pytest.raises(ValueError, match="grids differ"):
        Grid(0.0, 10.0, 1.0, 1.0, 5, 5).same(Grid(1.0, 10.0, 1.0, 1.0, 5, 5))


def test_resampling_keeps_fractions(spark):
    from zonalspark.operators import grid as g

    own = Grid(0.0, 2.0, 1.0, 1.0, 2, 2)
    source = spark.createDataFrame([(0, 0, 0.25), (0, 1, 0.75), (1, 0, None), (1, 1, 0.5)], "row int, col int, value double")
    same = {(r["row"], r["col"]): r["value"] for r in g.resample(source, own, own).collect()}
    assert same == {(0, 0): 0.25, (0, 1): 0.75, (1, 0): None, (1, 1): 0.5}


def test_points_are_shown_within_a_hundred(spark):
    rows = spark.createDataFrame([(x,) for x in (2.0, -2.0, 0.0004, -0.0004, None)], "x double").select(formats.points(F.col("x")).alias("t"), formats.change(F.col("x")).alias("c"), formats.level(F.col("x")).alias("l")).collect()
    unit = formats.NBSP + "p.p."
    assert [r["t"] for r in rows] == ["+100.0" + unit, formats.MINUS + "100.0" + unit, "0.0" + unit, "0.0" + unit, None]
    assert [r["c"][:2] for r in rows[:4]] == ["▲ ", "▼ ", "→ ", "→ "] and rows[4]["c"] == rows[4]["l"] == "n/a"


def test_an_id_with_two_classes_counts_for_both(spark):
    from zonalspark.operators import reshape

    long = spark.createDataFrame([(2019, 1, 7, 0.5)], "year int, zone int, class int, value double")
    lookup = spark.createDataFrame([(7, "A"), (7, "A"), (7, "B")], "class int, name string")
    assert sorted(r["name"] for r in reshape.lookup_mean(long, lookup).collect()) == ["A", "B"]
    with pytest.raises(Exception, match="comes twice"):
        reshape.unique(lookup.distinct(), "class").collect()


def test_an_interrupted_result_is_no_result(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_once(spark.range(3), path)
    sinks.write_once(spark.range(9), path)  # left as it is
    assert spark.read.parquet(path).count() == 3 and (tmp_path / "out" / "_SUCCESS").exists()
    sinks.write_once(spark.range(9), path, force=True)
    assert spark.read.parquet(path).count() == 9


def test_p_values_of_the_published_trend_agree_with_its_r2(spark):
    # t follows from r2: with 9 years, t = r * sqrt(7 / (1 - r2))
    rows = spark.createDataFrame([(r2,) for r2 in (0.05, 0.3, 0.62, 0.9)], "r2 double")
    got = rows.select(p_value(F.sqrt(F.col("r2") * 7 / (1 - F.col("r2"))), F.lit(7)).alias("p")).collect()
    assert [r["p"] for r in got] == pytest.approx([0.5620, 0.1269, 0.0117, 0.0001], abs=2e-3)


def test_zones_without_a_value_have_no_place(spark):
    df = spark.createDataFrame([(i, 1, None if i == 3 else float(i)) for i in range(8)], "zone int, region int, value double")
    assert 3 not in {r["zone"] for r in compare.leaderboard(df).collect()} | {r["zone"] for r in compare.ranks(df).collect()}
