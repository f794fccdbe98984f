"""Grid and colour queries, over the embeddings as a raster (row = vec_id, col = place in the vector)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import functions as F

from ..functions import colour, krovak, tiles
from ..operators import grid as g
from ..operators import zonal
from ..session import shared_folder
from ..sources import rasters
from ..tables import GRID_SQL, grid
from .common import even, even_sql

#: Pixels of the grid, in units of ten, and of a coarser one that is shifted inside of it.
PIXEL, COARSE, SHIFT = (10.0, 10.0), (17.0, 13.0), (23.0, 59.0)
#: The corner 12 E, 50 N in Web Mercator.
MERCATOR = (1335833.8895192828, 6446275.841017161)
SIZE = 35.0
#: A pixel that is no multiple of the grid's.
FRACTION = (23.7, 17.3)
TILE = 16
STACK = 4


def _part(spark, d):
    return grid(spark, d).select("row", "col", "value")


def _grids(spark, d) -> tuple[g.Grid, g.Grid]:
    """The grid of the whole table, its upper edge at the height of its rows, and the coarser one over all of it."""
    height, width = (n + 1 for n in grid(spark, d).agg(F.max("row"), F.max("col")).first())
    top = height * PIXEL[1]
    own = g.Grid(0.0, top, *PIXEL, width, height)
    return own, g.Grid(SHIFT[0], top - SHIFT[1], *COARSE, int(width * PIXEL[0] // COARSE[0]), int(top // COARSE[1]))


def _layers(spark, d):
    """Sixteen columns for each of four years; values below -0.25 are nodata."""
    return grid(spark, d).select((F.floor(F.col("col") / 16)).cast("int").alias("year"), "row", (F.col("col") % 16).alias("col"), F.when(F.col("value") >= -0.25, F.col("value")).alias("value"))


def grid_nearest(spark, d):
    return even(g.resample(_part(spark, d), *_grids(spark, d), "nearest"))


def grid_bilinear(spark, d):
    return even(g.resample(_part(spark, d), *_grids(spark, d)))


def _degree_grids(spark, d) -> tuple[g.Grid, g.Grid]:
    """The grid as a hundredth of a degree for each pixel, from 12 E and 50 N, and Web Mercator pixels of 900 m over it."""
    height, width = (n + 1 for n in grid(spark, d).agg(F.max("row"), F.max("col")).first())
    return g.Grid(12.0, 50.0, 0.01, 0.001, width, height), g.Grid(MERCATOR[0], MERCATOR[1], 900.0, 180.0, int(width * 1100 // 900), height)


def grid_reproject(spark, d):
    """Degrees to Web Mercator, bilinear."""
    return even(g.resample(_part(spark, d), *_degree_grids(spark, d), own_epsg=4326, target_epsg=3857))


def grid_reproject_nearest(spark, d):
    return even(g.resample(_part(spark, d), *_degree_grids(spark, d), "nearest", own_epsg=4326, target_epsg=3857))


def _places(spark, d):
    """Pixels with a place in degrees. Vectors are dealt to all tasks first: a file is a task to a row group, and projecting costs more than reading."""
    lon, lat = 12.1 + F.col("col") / 10.0, 48.6 + F.col("row") % 100 / 50.0
    return grid(spark, d, spread=True).select("row", "col", lon.alias("lon"), lat.alias("lat"))


def reprojected_points(spark, d):
    """Points in degrees, to each of three projections and back."""
    out = _places(spark, d)
    for epsg in (3857, 5514, 32633):
        out = tiles.projected(out, F.col("lon"), F.col("lat"), 4326, epsg, 4326, names=(f"lon_{epsg}", f"lat_{epsg}"))
    return even(out.drop("lon", "lat"))


def projected_points(spark, d):
    """Points in degrees on the national grid and in UTM 33, to the centimetre."""
    out = _places(spark, d)
    for epsg in (5514, 32633):
        out = tiles.projected(out, F.col("lon"), F.col("lat"), 4326, epsg, names=(f"x_{epsg}", f"y_{epsg}"))
    return even(out.drop("lon", "lat"), 2)


def zonal_three_grids(spark, d):
    """Statistics of a value grid by a grid of zones and a grid of classes, tile by tile."""
    pixels = grid(spark, d)
    layer = lambda c: g.to_tiles(pixels.select("row", "col", c.alias("value")), TILE)
    zones, classes = F.floor(F.col("row") / 40).cast("int"), (F.col("col") % 7).cast("int")
    cells = g.overlay(layer(zones), layer(classes), layer(F.when(F.col("value") > -0.25, F.col("value"))))
    return even(zonal.zonal_stats(cells, ("zone", "class")))


def _warped(spark, d, grids, size=16, own_size=32, **options):
    """The whole grid as tiles, warped tile by tile; its pixels."""
    own, target = grids(spark, d)
    out = g.to_pixels(g.warp_tiles(g.to_tiles(_part(spark, d), own_size), own, target, size=size, own_size=own_size, **options))
    return even(out.filter((F.col("row") < target.height) & (F.col("col") < target.width)))


def warp_bilinear(spark, d):
    return _warped(spark, d, _grids)


def warp_nearest(spark, d):
    return _warped(spark, d, _grids, method="nearest")


def warp_reproject(spark, d):
    return _warped(spark, d, _degree_grids, target_epsg=3857)


def area_average(spark, d):
    """The grid on pixels of another size, each by the area that it shares."""
    height, width = (n + 1 for n in grid(spark, d).agg(F.max("row"), F.max("col")).first())
    own = g.Grid(0.0, 0.0, *PIXEL, width, height)
    target = g.Grid(0.0, 0.0, *FRACTION, -int(-width * PIXEL[0] // FRACTION[0]), -int(-height * PIXEL[1] // FRACTION[1]))
    return even(g.area_average(_part(spark, d), own, target))


def pyramid_pixels(spark, d):
    """The pixels of every zoom of the grid, in tiles of eight."""
    most = grid(spark, d).agg(F.greatest(F.max("row"), F.max("col")) + 1).first()[0]
    zoom = max(0, math.ceil(math.log2(most / 8)))
    levels = g.quad_tree(g.to_tiles(_part(spark, d), 8), zoom, 8)
    out = reduce(lambda a, b: a.union(b), map(g.means, levels.values()))
    each = out.select("z", "x", "y", F.posexplode("cells").alias("k", "mean")).filter("mean IS NOT NULL")
    return even(each.select("z", (F.col("y") * 8 + F.floor(F.col("k") / 8)).alias("row"), (F.col("x") * 8 + F.col("k") % 8).alias("col"), "mean"))


def raster_round_trip(spark, d):
    """The grid as TIFF files, one for each window, and read back window by window."""
    height, width = (n + 1 for n in grid(spark, d).agg(F.max("row"), F.max("col")).first())
    tiles = g.to_tiles(_part(spark, d), TILE)
    blocks = tiles.select((F.col("tile_row") * TILE).alias("row"), (F.col("tile_col") * TILE).alias("col"), "h", "w", "cells")
    folder = shared_folder(spark, "rasters")
    rasters.write_tiff(blocks, folder, width=width, height=height, window=128, tile=32, dtype="f8", x0=1000.0, y0=9000.0, dx=2.0, dy=2.0, epsg=3857)
    back = rasters.in_grid(rasters.read_tiff(spark, folder, window=64), rasters.placement(spark, folder), x0=1000.0, y0=9000.0, dx=2.0, dy=2.0)
    return even(rasters.pixels(back).filter("value IS NOT NULL").select("row", "col", "value"))


def grid_downsample_avg(spark, d):
    points = grid(spark, d).select((F.col("col") * 10.0 + 5).alias("x"), (F.col("row") * 10.0 + 5).alias("y"), "value")
    return even(g.downsample(points, SIZE))


def tile_pyramid(spark, d):
    return even(g.pyramid(grid(spark, d).select("row", "col", "value"), 6, 8))


def tile_round_trip(spark, d):
    """Pixels to tiles and back: every value is in its place."""
    out = g.to_pixels(g.to_tiles(grid(spark, d).select("row", "col", "value"), TILE))
    return even(out.filter("value IS NOT NULL"))


def mosaic_first(spark, d):
    layers = _layers(spark, d).select(F.col("year").alias("layer"), "row", "col", F.when(F.col("value").isNull() | (F.abs("value") < 0.02), 0.0).otherwise(F.col("value")).alias("value"))
    return even(g.mosaic(layers))


def stack_complete(spark, d):
    """Cells with a value in every year, from yearly layers that are put on one stack."""
    whole = _layers(spark, d)
    layers = {y: whole.filter(F.col("year") == y) for y in range(STACK)}
    return even(g.complete(g.stack(layers), STACK))


def raster_summary(spark, d):
    pixels = grid(spark, d).select("value", F.abs("value").alias("p"))
    return even(g.summary(pixels, p="p"))


def colour_relief(spark, d):
    return even(g.colour_relief(_part(spark, d), -0.3, 0.3))


def colour_ramp(spark, d):
    v = F.col("value")
    picks = {"change": colour.change_colour((v + 0.3) / 0.6), "difference": colour.difference_colour(v, F.lit(0.2)), "absolute": colour.absolute_colour(F.when(v > -0.25, v), F.lit(-0.2), F.lit(0.2))}
    return _part(spark, d).select(F.col("row").cast("bigint"), F.col("col").cast("bigint"), *(F.lower(colour.to_hex(c)).alias(k) for k, c in picks.items()))


def tile_recolour(spark, d):
    rgba = [F.pmod(F.floor(F.col("value") * k), F.lit(256)).cast("int") for k in (1000, 1700, 2300, 3100)]
    return even(_part(spark, d).select("row", "col", colour.recolour(*rgba).alias("k")).select("row", "col", "k.*"))


def overzoom_tiles(spark, d):
    z, x, y = F.lit(15), F.col("row") * 37, F.col("col") * 91
    return even(_part(spark, d).select("row", "col", tiles.overzoom(z, x, y, 12).alias("k")).select("row", "col", "k.*"))


def mercator_tiles(spark, d):
    """Points to Web Mercator, to their tiles, and back to degrees."""
    lon, lat = 12 + F.col("col") / 10.0, 48 + F.col("row") / 40.0
    x, y = tiles.to_mercator(lon, lat)
    back = tiles.from_mercator(x, y)
    tx, ty = tiles.tile_of(x, y, 12)
    return even(_part(spark, d).select("row", "col", x.alias("x"), y.alias("y"), back[0].alias("lon"), back[1].alias("lat"), tx.alias("tx"), ty.alias("ty")), 4)


_P = f"WITH {GRID_SQL}, p AS (SELECT row, col, value FROM grid)"
_T = f"""e AS (SELECT (max(row) + 1) * {PIXEL[1]}e0 AS top, (max(col) + 1) * {PIXEL[0]}e0 AS wide FROM grid),
 t AS (SELECT r, c, (top - (top - {SHIFT[1]}e0 - (r + 0.5e0) * {COARSE[1]}e0)) / {PIXEL[1]}e0 - 0.5e0 AS fr, ({SHIFT[0]}e0 + (c + 0.5e0) * {COARSE[0]}e0) / {PIXEL[0]}e0 - 0.5e0 AS fc
  FROM (SELECT top, unnest(range(CAST(floor(top / {COARSE[1]}e0) AS BIGINT))) AS r FROM e) a, (SELECT unnest(range(CAST(floor(wide / {COARSE[0]}e0) AS BIGINT))) AS c FROM e) b)"""
_M = f"""e AS (SELECT max(row) + 1 AS height, max(col) + 1 AS width FROM grid),
 c AS (SELECT r, c, {MERCATOR[0]}e0 + (c + 0.5e0) * 900 AS x, {MERCATOR[1]}e0 - (r + 0.5e0) * 180 AS y FROM (SELECT unnest(range(height)) AS r FROM e) a, (SELECT unnest(range(CAST(floor(width * 1100 / 900) AS BIGINT))) AS c FROM e) b),
 t AS (SELECT r, c, (50e0 - degrees(2 * atan(exp(y / 6378137e0)) - pi() / 2)) / 0.001e0 - 0.5e0 AS fr, (degrees(x / 6378137e0) - 12e0) / 0.01e0 - 0.5e0 AS fc FROM c)"""
_LY = f"WITH {GRID_SQL}, l AS (SELECT col // 16 AS year, row, col % 16 AS col, CASE WHEN value >= -0.25e0 THEN value END AS value FROM grid)"


def _ramp_sql(t: str, channel: int, stops: tuple[tuple[float, str], ...]) -> str:
    t = f"greatest(least({t}, {stops[-1][0]!r}e0), {stops[0][0]!r}e0)"
    whens = []
    for (a, ca), (b, cb) in zip(stops[:-1], stops[1:], strict=True):
        low, high = colour.channels(ca)[channel], colour.channels(cb)[channel]
        whens.append(f"WHEN {t} <= {b!r}e0 THEN CAST(floor({low} + ({high - low}) * (({t} - {a!r}e0) / {b - a!r}e0) + 0.5e0) AS INT)")
    return f"CASE {' '.join(whens)} ELSE {colour.channels(stops[-1][1])[channel]} END"


def _hex_sql(t: str, stops: tuple[tuple[float, str], ...]) -> str:
    return "'#' || " + " || ".join(f"lower(printf('%02x', {_ramp_sql(t, k, stops)}))" for k in range(3))


_RGBA = ", ".join(f"(CAST(floor(value * {k}) AS BIGINT) % 256 + 256) % 256 AS {n}" for n, k in zip("rgba", (1000, 1700, 2300, 3100), strict=True))
_SIGN = f"CASE WHEN g > r + 2 THEN least(1e0, ({colour.TILE_WHITE} - r) / {colour.TILE_GREEN}e0) WHEN r > g + 2 THEN -least(1e0, ({colour.TILE_WHITE} - b) / {colour.TILE_RED}e0) ELSE 0e0 END"
_X = "radians(12 + col / 10e0) * 6378137e0"
_Y = "ln(tan(pi() / 4 + radians(48 + row / 40e0) / 2)) * 6378137e0"
_RELIEF = ", ".join(f"CASE WHEN value IS NULL THEN 0 ELSE {_ramp_sql('(value - (-0.3e0)) / 0.6e0', k, colour.CHANGE_RAMP)} END AS {n}" for k, n in enumerate("rgb"))

def _projected_sql() -> str:
    """The formulas of the projections step by step: on WGS 84 in space, shifted to the Bessel ellipsoid, to the sphere, to the oblique cone; and UTM by its series of sines."""
    (a, f), (a2, f2) = krovak.WGS84, krovak.BESSEL
    e2, t2 = 2 * f - f * f, 2 * f2 - f2 * f2
    m, (rx, ry, rz) = 1 + krovak.PPM / 1e6, (math.radians(r / 3600) for r in krovak.ROTATION)
    e, centre, cone, parallel = math.sqrt(t2), math.radians(krovak.LAT_CENTRE), math.radians(krovak.CONE_COLATITUDE), math.radians(krovak.PSEUDO_PARALLEL)
    b = math.sqrt(1 + t2 * math.cos(centre) ** 4 / (1 - t2))
    u0 = math.asin(math.sin(centre) / b)
    k0 = math.tan(u0 / 2 + math.pi / 4) * ((1 + e * math.sin(centre)) / (1 - e * math.sin(centre))) ** (e * b / 2) / math.tan(centre / 2 + math.pi / 4) ** b
    r0 = krovak.SCALE * a2 * math.sqrt(1 - t2) / (1 - t2 * math.sin(centre) ** 2) / math.tan(parallel)
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3, 13 / 48 * n**2 - 3 / 5 * n**3, 61 / 240 * n**3)
    k = 2 * math.sqrt(n) / (1 + n)
    sinh, cosh = (lambda v: f"((exp({v}) - exp(-({v}))) / 2)"), (lambda v: f"((exp({v}) + exp(-({v}))) / 2)")
    atanh = lambda v: f"(ln((1 + ({v})) / (1 - ({v}))) / 2)"
    east = " + ".join(f"{c!r} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, c in enumerate(alpha, 1))
    north = " + ".join(f"{c!r} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, c in enumerate(alpha, 1))
    return f"""{_P}, d0 AS (SELECT row, col, radians(12.1e0 + col / 10e0) AS lam, radians(48.6e0 + row % 100 / 50e0) AS phi FROM p), d1 AS (SELECT *, {a!r} / sqrt(1 - {e2!r} * sin(phi) ** 2) AS nu FROM d0),
 d2 AS (SELECT *, (nu * cos(phi) * cos(lam) - {krovak.SHIFT[0]}e0) / {m!r} AS gx, (nu * cos(phi) * sin(lam) - {krovak.SHIFT[1]}e0) / {m!r} AS gy, (nu * (1 - {e2!r}) * sin(phi) - {krovak.SHIFT[2]}e0) / {m!r} AS gz FROM d1),
 d3 AS (SELECT *, gx + {rz!r} * gy - {ry!r} * gz AS bx, gy - {rz!r} * gx + {rx!r} * gz AS bz0, gz + {ry!r} * gx - {rx!r} * gy AS bz FROM d2),
 d4 AS (SELECT *, sqrt(bx * bx + bz0 * bz0) AS pr, atan2(bz * {a2!r}, sqrt(bx * bx + bz0 * bz0) * {a2 * (1 - f2)!r}) AS th FROM d3),
 d5 AS (SELECT *, atan2(bz0, bx) AS blam, atan2(bz + {t2 / (1 - t2) * a2 * (1 - f2)!r} * sin(th) ** 3, pr - {t2 * a2!r} * cos(th) ** 3) AS bphi FROM d4),
 d6 AS (SELECT *, 2 * (atan({k0!r} * tan(bphi / 2 + pi() / 4) ** {b!r} / ((1 + {e!r} * sin(bphi)) / (1 - {e!r} * sin(bphi))) ** {e * b / 2!r}) - pi() / 4) AS u, {b!r} * ({math.radians(krovak.LON_ORIGIN)!r} - blam) AS v FROM d5),
 d7 AS (SELECT *, asin({math.cos(cone)!r} * sin(u) + {math.sin(cone)!r} * cos(u) * cos(v)) AS t FROM d6),
 d8 AS (SELECT *, {math.sin(parallel)!r} * asin(cos(u) * sin(v) / cos(t)) AS ang, {r0!r} * ({math.tan(parallel / 2 + math.pi / 4)!r} / tan(t / 2 + pi() / 4)) ** {math.sin(parallel)!r} AS rad FROM d7),
 d9 AS (SELECT *, ln(tan(pi() / 4 + phi / 2)) - {k!r} * {atanh(f"{k!r} * sin(phi)")} AS q, lam - radians(15) AS dl FROM d8), d10 AS (SELECT *, {sinh("q")} AS tt FROM d9),
 d11 AS (SELECT *, atan2(tt, cos(dl)) AS xi, {atanh("sin(dl) / sqrt(1 + tt * tt)")} AS eta FROM d10) --
SELECT row, col, -rad * sin(ang) AS x_5514, -rad * cos(ang) AS y_5514, 500000 + 0.9996e0 * {radius!r} * (eta + {east}) AS x_32633, 0.9996e0 * {radius!r} * (xi + {north}) AS y_32633 FROM d11"""


QUERIES = {
    "grid_nearest": (grid_nearest, even_sql(f"{_P}, {_T} --\nSELECT r AS row, c AS col, value FROM t LEFT JOIN p ON p.row = floor(fr + 0.5e0) AND p.col = floor(fc + 0.5e0)", "row col", "value")),
    "grid_bilinear": (
        grid_bilinear,
        even_sql(f"{_P}, {_T}, k AS (SELECT r, c, floor(fr) + i AS pr, floor(fc) + j AS pc, (CASE i WHEN 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE j WHEN 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w FROM t, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS q(i, j)) --\nSELECT r AS row, c AS col, sum(value * w) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value FROM k LEFT JOIN p ON p.row = pr AND p.col = pc WHERE w > 0 GROUP BY r, c", "row col", "value"),
    ),
    "grid_reproject": (
        grid_reproject,
        even_sql(f"{_P}, {_M}, k AS (SELECT r, c, floor(fr) + i AS pr, floor(fc) + j AS pc, (CASE i WHEN 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE j WHEN 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w FROM t, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS q(i, j)) --\nSELECT r AS row, c AS col, sum(value * w) / nullif(sum(CASE WHEN value IS NOT NULL THEN w END), 0) AS value FROM k LEFT JOIN p ON p.row = pr AND p.col = pc WHERE w > 0 GROUP BY r, c", "row col", "value"),
    ),
    "grid_reproject_nearest": (grid_reproject_nearest, even_sql(f"{_P}, {_M} --\nSELECT r AS row, c AS col, value FROM t LEFT JOIN p ON p.row = floor(fr + 0.5e0) AND p.col = floor(fc + 0.5e0)", "row col", "value")),
    "reprojected_points": (reprojected_points, even_sql(f"{_P} --\nSELECT row, col, " + ", ".join(f"12.1e0 + col / 10e0 AS lon_{k}, 48.6e0 + row % 100 / 50e0 AS lat_{k}" for k in (3857, 5514, 32633)) + " FROM p", "row col", "lon_3857 lat_3857 lon_5514 lat_5514 lon_32633 lat_32633")),
    "area_average": (
        area_average,
        even_sql(
            f"WITH {GRID_SQL}, o AS (SELECT value, row * {PIXEL[1]}e0 AS t, (row + 1) * {PIXEL[1]}e0 AS b, col * {PIXEL[0]}e0 AS l, (col + 1) * {PIXEL[0]}e0 AS r FROM grid), k AS (SELECT *, unnest(range(CAST(floor(t / {FRACTION[1]}e0) AS BIGINT), CAST(ceil(b / {FRACTION[1]}e0) AS BIGINT))) AS row FROM o),"
            f" m AS (SELECT *, unnest(range(CAST(floor(l / {FRACTION[0]}e0) AS BIGINT), CAST(ceil(r / {FRACTION[0]}e0) AS BIGINT))) AS col FROM k), w AS (SELECT row, col, value, (least(b, (row + 1) * {FRACTION[1]}e0) - greatest(t, row * {FRACTION[1]}e0)) * (least(r, (col + 1) * {FRACTION[0]}e0) - greatest(l, col * {FRACTION[0]}e0)) AS a FROM m) --\nSELECT row, col, sum(value * a) / sum(a) AS value, sum(a) AS area FROM w WHERE a > 0 GROUP BY row, col",
            "row col", "value area",
        ),
    ),
    "pyramid_pixels": (pyramid_pixels, even_sql(f"WITH {GRID_SQL}, e AS (SELECT CAST(greatest(0, ceil(log2((greatest(max(row), max(col)) + 1) / 8e0))) AS BIGINT) AS zoom FROM grid), z AS (SELECT zoom, unnest(range(zoom + 1)) AS z FROM e) --\nSELECT z, row >> CAST(zoom - z AS INT) AS row, col >> CAST(zoom - z AS INT) AS col, avg(value) AS mean FROM grid, z GROUP BY 1, 2, 3", "z row col", "mean")),
    "raster_round_trip": (raster_round_trip, even_sql(f"WITH {GRID_SQL} --\nSELECT * FROM grid", "row col", "value")),
    "projected_points": (projected_points, even_sql(_projected_sql(), "row col", "x_5514 y_5514 x_32633 y_32633", digits=2)),
    "zonal_three_grids": (zonal_three_grids, even_sql(f"WITH {GRID_SQL} --\nSELECT row // 40 AS zone, col % 7 AS class, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std_pop, min(value) AS min, max(value) AS max FROM grid WHERE value > -0.25e0 AND row // 40 > 0 AND col % 7 > 0 GROUP BY 1, 2", "zone class n", "mean std_pop min max")),
    "grid_downsample_avg": (grid_downsample_avg, even_sql(f"WITH {GRID_SQL} --\nSELECT floor((col * 10e0 + 5) / {SIZE}e0) AS tap_x, floor((row * 10e0 + 5) / {SIZE}e0) AS tap_y, avg(value) AS value, count(value) AS n FROM grid GROUP BY 1, 2", "tap_x tap_y n", "value")),
    "tile_pyramid": (tile_pyramid, even_sql(f"WITH {GRID_SQL} --\nSELECT z, floor((col // 8) / power(2, 6 - z)) AS x, floor((row // 8) / power(2, 6 - z)) AS y, count(*) AS n, avg(value) AS mean FROM grid, (SELECT unnest(range(7)) AS z) AS zooms GROUP BY 1, 2, 3", "z x y n", "mean")),
    "tile_round_trip": (tile_round_trip, even_sql(f"WITH {GRID_SQL} --\nSELECT * FROM grid", "row col", "value")),
    "mosaic_first": (mosaic_first, even_sql(f"{_LY} --\nSELECT row, col, arg_min(value, year) AS value FROM l WHERE value IS NOT NULL AND abs(value) >= 0.02e0 GROUP BY row, col", "row col", "value")),
    "stack_complete": (stack_complete, even_sql(f"{_LY} --\nSELECT row, col FROM l GROUP BY row, col HAVING count(value) = {STACK}", "row col")),
    "raster_summary": (raster_summary, even_sql(f"WITH {GRID_SQL} --\nSELECT count(value) AS valid, min(value) AS min, max(value) AS max, avg(value) AS mean, avg(CASE WHEN abs(value) < 0.05e0 THEN 1e0 ELSE 0e0 END) AS share_significant FROM grid", "valid", "min max mean share_significant")),
    "colour_relief": (colour_relief, even_sql(f"{_P} --\nSELECT row, col, {_RELIEF}, 255 AS a FROM p", "row col r g b a")),
    "colour_ramp": (colour_ramp, even_sql(f"{_P} --\nSELECT row, col, {_hex_sql('(value + 0.3e0) / 0.6e0', colour.CHANGE_RAMP)} AS change, {_hex_sql('(value / 0.2e0 + 1) / 2', colour.CHANGE_RAMP)} AS difference, CASE WHEN value > -0.25e0 THEN {_hex_sql('(value - (-0.2e0)) / (0.2e0 - (-0.2e0))', colour.ABSOLUTE_RAMP)} ELSE '{colour.NO_VALUE}' END AS absolute FROM p", "row col", "", "change difference absolute")),
    "tile_recolour": (
        tile_recolour,
        even_sql(f"{_P}, k AS (SELECT row, col, {_RGBA} FROM p), s AS (SELECT *, greatest(r, g, b) AS bright, {_SIGN} AS size FROM k) --\nSELECT row, col, " + ", ".join(f"CASE WHEN bright > 15 THEN {_ramp_sql('(size + 1) / 2', k, colour.CHANGE_RAMP)} ELSE {n} END AS {n}" for k, n in enumerate("rgb")) + ", CASE WHEN bright <= 15 THEN 0 WHEN bright < 95 THEN floor(a * ((bright - 15) / 80e0) + 0.5e0) ELSE a END AS a FROM s", "row col r g b a"),
    ),
    "overzoom_tiles": (overzoom_tiles, even_sql(f"{_P} --\nSELECT row, col, 12 AS z, row * 37 // 8 AS x, col * 91 // 8 AS y, 8 AS factor, row * 37 % 8 AS sub_x, col * 91 % 8 AS sub_y FROM p", "row col z x y factor sub_x sub_y")),
    "mercator_tiles": (mercator_tiles, even_sql(f"{_P}, m AS (SELECT row, col, {_X} AS x, {_Y} AS y, 12 + col / 10e0 AS lon, 48 + row / 40e0 AS lat FROM p) --\nSELECT *, floor((x + pi() * 6378137e0) / (2 * pi() * 6378137e0 / 4096)) AS tx, floor((pi() * 6378137e0 - y) / (2 * pi() * 6378137e0 / 4096)) AS ty FROM m", "row col tx ty", "x y lon lat", digits=4)),
}

#: Tile by tile the same values as pixel by pixel.
QUERIES |= {k: (f, QUERIES[same][1]) for k, f, same in (("warp_bilinear", warp_bilinear, "grid_bilinear"), ("warp_nearest", warp_nearest, "grid_nearest"), ("warp_reproject", warp_reproject, "grid_reproject"))}
