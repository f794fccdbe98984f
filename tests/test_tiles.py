"""Operators on tiles: warps, averages by area, the rendered pyramid, and tables that meet without a shuffle."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalspark.functions import colour
from zonalspark.operators import grid as g
from zonalspark.operators import zonal
from zonalspark.sources import images


def pixels_of(spark, values, first=(0, 0)):
    rows = [(int(r) + first[0], int(c) + first[1], None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(values)]
    return spark.createDataFrame(rows, "row int, col int, value double")


def random_grid(shape, seed=1, none=0.1):
    rng = np.random.RandomState(seed)
    values = rng.randn(*shape)
    values[rng.rand(*shape) < none] = np.nan
    return values


def by_place(df):
    return {(r["row"], r["col"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
@pytest.mark.parametrize("case", ["shifted", "mercator", "krovak", "apart"])
def test_warp_of_tiles_is_that_of_pixels(spark, method, case):
    values = random_grid((40, 50))
    source = pixels_of(spark, values)
    own = g.Grid(12.0, 50.0, 0.01, 0.01, 50, 40)
    target, epsg = {
        "shifted": (g.Grid(12.033, 49.961, 0.007, 0.013, 60, 25), 4326), "mercator": (g.Grid(1335833.9, 6446275.8, 900.0, 1300.0, 61, 47), 3857),
        "krovak": (g.Grid(-905000.0, -1020000.0, 800.0, 900.0, 60, 50), 5514), "apart": (g.Grid(12.45, 49.65, 0.01, 0.01, 30, 20), 4326),
    }[case]
    want = by_place(g.resample(source, own, target, method, own_epsg=4326, target_epsg=epsg))
    tiles = g.warp_tiles(g.to_tiles(source, 16), own, target, size=8, own_size=16, method=method, own_epsg=4326, target_epsg=epsg)
    got = by_place(g.to_pixels(tiles).filter((F.col("row") < target.height) & (F.col("col") < target.width)))
    assert got.keys() == want.keys() and sum(v is not None for v in want.values()) > 15
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or got[k] == pytest.approx(want[k], abs=1e-9)) for k in want)


def test_a_warp_shuffles_tiles_only(spark):
    own, target = g.Grid(0.0, 64.0, 1.0, 1.0, 64, 64), g.Grid(0.3, 63.8, 1.1, 1.1, 50, 50)
    source = g.to_tiles(pixels_of(spark, random_grid((64, 64))), 16)
    plan = g.warp_tiles(source, own, target, size=16, own_size=16)._jdf.queryExecution().optimizedPlan().toString()
    head = plan[: plan.index("collect_list(struct(k")] if "collect_list(struct(k" in plan else plan
    assert "explode(sequence" not in head.split("Aggregate")[0]  # above the join no row is a pixel
    assert g.warp_tiles(source, own, target, size=16, own_size=16).count() == 16


def test_area_average_against_overlaps(spark):
    values = random_grid((23, 31), 4)
    own, target = g.Grid(100.0, 200.0, 3.0, 2.0, 31, 23), g.Grid(98.5, 201.1, 7.3, 5.9, 12, 9)
    got = {(r["row"], r["col"]): (r["value"], r["area"]) for r in g.area_average(pixels_of(spark, values), own, target).collect()}
    total = 0
    for i in range(target.height):
        for j in range(target.width):
            top, left = target.y0 - i * target.dy, target.x0 + j * target.dx
            s = a = 0.0
            for (r, c), v in np.ndenumerate(values):
                if not np.isnan(v):
                    high = min(top, own.y0 - r * own.dy) - max(top - target.dy, own.y0 - (r + 1) * own.dy)
                    wide = min(left + target.dx, own.x0 + (c + 1) * own.dx) - max(left, own.x0 + c * own.dx)
                    if high > 1e-12 and wide > 1e-12:
                        s, a = s + v * high * wide, a + high * wide
            if a:
                assert got[i, j] == (pytest.approx(s / a), pytest.approx(a))
                total += 1
    assert total == len(got)
    # the target covers the whole source: what comes in goes out
    inside = np.nansum(values[:, : int((target.x0 + target.width * target.dx - own.x0) // own.dx)])
    whole = g.Grid(100.0, 200.0, 7.5, 5.5, 13, 9)
    assert sum(r["value"] * r["area"] for r in g.area_average(pixels_of(spark, values), own, whole).collect()) == pytest.approx(np.nansum(values) * own.dx * own.dy)
    assert inside != 0


def test_every_zoom_against_brute_force_and_its_images(spark, tmp_path):
    size, zoom = 8, 3
    values = random_grid((50, 61), 7, 0.3)
    levels = g.quad_tree(g.to_tiles(pixels_of(spark, values), size), zoom, size)
    full = np.full((size << zoom, size << zoom), np.nan)
    full[:50, :61] = values
    for z in range(zoom + 1):
        step = 1 << (zoom - z)
        blocks = full.reshape(len(full) // step, step, len(full) // step, step).transpose(0, 2, 1, 3).reshape(len(full) // step, len(full) // step, -1)
        count = (~np.isnan(blocks)).sum(axis=2)
        want = np.where(count, np.nansum(blocks, axis=2) / np.maximum(count, 1), np.nan)
        rows = g.means(levels[z]).collect()
        assert {(r["x"], r["y"]) for r in rows} == {(c // size, r // size) for r, c in zip(*np.nonzero(~np.isnan(np.where(np.arange(len(want))[:, None] * step < 50, np.where(np.arange(len(want))[None, :] * step < 61, 1.0, np.nan), np.nan))))}
        for r in rows:
            own = np.array(r["cells"], float).reshape(size, size)
            assert np.allclose(own, want[r["y"] * size : (r["y"] + 1) * size, r["x"] * size : (r["x"] + 1) * size], equal_nan=True)
        painted = images.coloured(g.means(levels[z]), lambda v: colour.change_colour((v + 1) / 2))
        images.write_pngs(painted, str(tmp_path / "tiles"), size)
        for r in painted.collect():
            image = images.from_png((tmp_path / "tiles" / str(z) / str(r["x"]) / f"{r['y']}.png").read_bytes())
            assert image.ravel().tolist() == r["rgba"]
            assert ((image[:, :, 3] == 0) == np.isnan(np.array(r["cells"], float).reshape(size, size))).all()
    assert sorted(p.name for p in (tmp_path / "tiles").iterdir()) == ["0", "1", "2", "3"]
    with pytest.raises(ValueError):
        images.from_png(b"GIF89a")


def test_tables_in_buckets_meet_without_a_shuffle(spark, tmp_path):
    values = random_grid((64, 64), 3)
    zones = pixels_of(spark, np.add.outer(np.arange(64) // 20 + 1, np.zeros(64)))
    classes = pixels_of(spark, np.add.outer(np.zeros(64), np.arange(64) % 5 + 1))
    plain = [g.to_tiles(df, 16) for df in (zones, classes, pixels_of(spark, values))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = [g.co_partitioned(df, f"tiles_{k}", 4, str(tmp_path / f"t{k}")) for k, df in enumerate(plain)]
        cells = g.overlay(*tables)
        assert cells.count() == 64 * 64
        assert "Exchange" not in cells._jdf.queryExecution().executedPlan().toString()
        want, got = (sorted(tuple(r) for r in zonal.zonal_stats(c, ("zone", "class")).collect()) for c in (g.overlay(*plain), cells))
        assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3:] for r in got], [r[3:] for r in want])
        mixed = g.overlay(tables[0], tables[1], g.to_tiles(pixels_of(spark, values), 8))
        assert mixed.count() == 0  # tiles of another shape do not meet
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for k in range(3):
            spark.sql(f"drop table if exists tiles_{k}")
