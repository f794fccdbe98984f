"""Grid operators: stacks, mosaics, resampling, downsampling, tiles and colour relief.

A grid is a pixel table (row, col, value), null for nodata, or a tile table
(tile_row, tile_col, h, w, cells) with a tile's values in one array; a Grid says
where its pixels are. Blocks are Spark's partitions; nothing iterates over them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import colour, krovak, tiles
from ..session import written


@dataclass(frozen=True)
class Grid:
    """Upper left corner, pixel size and shape. Grids are the same only if all of it is."""

    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int

    @classmethod
    def of_bounds(cls, min_x: float, min_y: float, max_x: float, max_y: float, pixel: float) -> Grid:
        width, height = math.ceil((max_x - min_x) / pixel), math.ceil((max_y - min_y) / pixel)
        return cls(min_x, max_y, (max_x - min_x) / width, (max_y - min_y) / height, width, height)

    def centre(self, row: Column, col: Column) -> tuple[Column, Column]:
        return self.x0 + (col + 0.5) * self.dx, self.y0 - (row + 0.5) * self.dy

    def place(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Fractional (row, col) of a point; pixel centres are whole numbers."""
        return (self.y0 - y) / self.dy - 0.5, (x - self.x0) / self.dx - 0.5

    def same(self, other: Grid) -> None:
        if self != other:
            raise ValueError(f"grids differ: {self} and {other}")


def stack(layers: dict[int, DataFrame]) -> DataFrame:
    """(year, row, col, value) of yearly grids: a union, to be grouped by cell, not joined."""
    from functools import reduce

    return reduce(DataFrame.union, [df.select(F.lit(y).alias("year"), "row", "col", "value") for y, df in layers.items()])


def complete(series: DataFrame, years: int, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Cells with a value in every year."""
    return series.groupBy(*keys).agg(F.count("value").alias("n")).filter(F.col("n") == years).select(*keys)


def to_tiles(pixels: DataFrame, size: int) -> DataFrame:
    """Pixel table to tile table; a tile has size * size values at most. Values are looked up line by line, as a map is searched from its start."""
    inside = F.pmod("row", F.lit(size)) * size + F.pmod("col", F.lit(size))
    got = pixels.groupBy(F.floor(F.col("row") / size).cast("int").alias("tile_row"), F.floor(F.col("col") / size).cast("int").alias("tile_col")).agg(F.collect_list(F.struct(inside.alias("k"), "value")).alias("e"))
    steps = F.sequence(F.lit(0), F.lit(size - 1))
    line = lambda r: krovak.bind(lambda m: F.transform(steps, lambda c: F.try_element_at(m, r * size + c)), m=F.map_from_entries(F.filter("e", lambda x: F.floor(x["k"] / size) == r)))
    return got.select("tile_row", "tile_col", F.lit(size).alias("h"), F.lit(size).alias("w"), F.flatten(F.transform(steps, line)).alias("cells"))


def to_pixels(tile_table: DataFrame) -> DataFrame:
    out = tile_table.select("tile_row", "tile_col", "h", "w", F.posexplode("cells").alias("k", "value"))
    return out.select((F.col("tile_row") * F.col("h") + F.floor(F.col("k") / F.col("w"))).cast("int").alias("row"), (F.col("tile_col") * F.col("w") + F.col("k") % F.col("w")).cast("int").alias("col"), "value")


def overlay(zones: DataFrame, classes: DataFrame, values: DataFrame) -> DataFrame:
    """(zone, class, value) of every pixel of three tile tables of one tiling: what zonal statistics read.

    Tiles meet, not pixels: a join row is a tile with its arrays, and pixels are only
    made from them, side by side, inside the task that counts them.
    """
    keys = ["tile_row", "tile_col"]
    named = lambda df, name: df.select(*keys, F.col("cells").alias(name), F.struct("h", "w").alias(f"{name}_shape"))
    met = named(zones, "zone").join(named(classes, "class"), keys).join(named(values, "value"), keys)
    # the shapes are no keys: tables that are bucketed by tile need no shuffle
    same = (F.col("zone_shape") == F.col("class_shape")) & (F.col("class_shape") == F.col("value_shape"))
    return met.select(F.inline(F.when(same, F.arrays_zip("zone", "class", "value"))))


def mosaic(layers: DataFrame, order: str = "layer", keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """The first value in layer order that is not nodata (0 or null)."""
    return layers.filter("value IS NOT NULL AND value <> 0").groupBy(*keys).agg(F.min_by("value", order).alias("value"))


def targets(spark, grid: Grid) -> DataFrame:
    """(row, col) of every pixel of a grid, made where they are used."""
    n = F.lit(grid.width)
    return spark.range(grid.width * grid.height).select(F.floor(F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"))


def resample(source: DataFrame, own: Grid, target: Grid, method: str = "bilinear", *, own_epsg: int = 4326, target_epsg: int = 4326) -> DataFrame:
    """source on the target grid: nearest (classes) or bilinear (values), from one projection to another.

    Bilinear weights are shared among the corners that have a value; a pixel without any is null.
    """
    pixels = targets(source.sparkSession, target)
    x, y = tiles.project(*target.centre(F.col("row"), F.col("col")), target_epsg, own_epsg)
    row, col = own.place(x, y)
    if method == "nearest":
        corners = F.array(F.struct(F.floor(row + 0.5).cast("int").alias("r"), F.floor(col + 0.5).cast("int").alias("c"), F.lit(1.0).alias("w")))
    else:
        r, c = F.floor(row), F.floor(col)
        fr, fc = row - r, col - c
        corners = F.array(*(F.struct((r + i).cast("int").alias("r"), (c + j).cast("int").alias("c"), ((fr if i else 1 - fr) * (fc if j else 1 - fc)).alias("w")) for i in (0, 1) for j in (0, 1)))
    wanted = pixels.select("row", "col", F.explode(corners).alias("k")).select("row", "col", F.col("k.r").alias("r"), F.col("k.c").alias("c"), F.col("k.w").alias("w")).filter("w > 0")
    values = source.select(F.col("row").alias("r"), F.col("col").alias("c"), F.col("value").alias("v"))
    got = wanted.join(values, ["r", "c"], "left")
    w = F.when(F.col("v").isNotNull(), F.col("w"))
    return got.groupBy("row", "col").agg((F.sum(F.col("v") * w) / F.nullif(F.sum(w), F.lit(0.0))).alias("value"))


def _tile_keys(row: Column, col: Column, size: int) -> tuple[Column, Column]:
    return F.floor(row / size).cast("int"), F.floor(col / size).cast("int")


def warp_tiles(source: DataFrame, own: Grid, target: Grid, *, size: int, own_size: int, method: str = "bilinear", own_epsg: int = 4326, target_epsg: int = 4326, halo: int = 2) -> DataFrame:
    """Tile table of the target grid from the source's, as ``resample``, but tile by tile: no pixel is a row of a shuffle.

    source: tiles of own_size * own_size; the result has tiles of size * size. A target
    tile meets the source tiles under its outline: points all over the tile are projected,
    and their bounds, with a halo of pixels and a fiftieth of their extent, are the rows and
    columns it needs. Its values are then interpolated in the arrays of the joined row.
    """
    down, across = -(-target.height // size), -(-target.width // size)
    high, wide = -(-own.height // own_size), -(-own.width // own_size)
    made = source.sparkSession.range(down * across).select(F.floor(F.col("id") / across).cast("int").alias("tile_row"), (F.col("id") % across).cast("int").alias("tile_col"))
    there = lambda row, col: own.place(*tiles.project(*target.centre(row, col), target_epsg, own_epsg))

    def spot(p: Column) -> Column:
        row, col = there(F.col("tile_row") * size - 0.5 + p["u"] * size, F.col("tile_col") * size - 0.5 + p["v"] * size)
        return F.struct(row.alias("r"), col.alias("c"))

    spots = F.transform(F.array(*(F.struct(F.lit(i / 8).alias("u"), F.lit(j / 8).alias("v")) for i in range(9) for j in range(9))), spot)
    ends = {}
    for k, most in (("r", high), ("c", wide)):
        values = F.col(f"spots.{k}")
        room = F.lit(halo) + (F.array_max(values) - F.array_min(values)) / 50
        ends[f"{k}0"] = F.greatest(F.floor((F.array_min(values) - room) / own_size), F.lit(0)).cast("int")
        ends[f"{k}1"] = F.least(F.floor((F.array_max(values) + room) / own_size), F.lit(most - 1)).cast("int")
    outlined = made.withColumn("spots", spots).withColumns(ends).drop("spots")
    steps = lambda a, b: F.when(F.col(a) <= F.col(b), F.sequence(a, b))
    wanted = outlined.withColumn("sr", F.explode_outer(steps("r0", "r1"))).withColumn("sc", F.explode_outer(steps("c0", "c1")))
    given = source.select(F.col("tile_row").alias("sr"), F.col("tile_col").alias("sc"), "cells")
    keys = ["tile_row", "tile_col", "r0", "r1", "c0", "c1"]
    n = F.col("c1") - F.col("c0") + 1
    entry = F.when(F.col("cells").isNotNull(), F.struct(((F.col("sr") - F.col("r0")) * n + F.col("sc") - F.col("c0")).alias("k"), "cells"))
    met = wanted.join(given, ["sr", "sc"], "left").groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
    count = F.greatest((F.col("r1") - F.col("r0") + 1) * n, F.lit(0))
    near = met.withColumn("near", F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.try_element_at("held", k))))

    def value(r: Column, c: Column) -> Column:
        """A source pixel; null outside of the tiles at hand."""
        (tr, tc), (r, c) = _tile_keys(r, c, own_size), (r.cast("int"), c.cast("int"))
        here = tr.between(F.col("r0"), F.col("r1")) & tc.between(F.col("c0"), F.col("c1"))
        return F.when(here, F.get(F.get("near", (tr - F.col("r0")) * n + tc - F.col("c0")), F.pmod(r, F.lit(own_size)) * own_size + F.pmod(c, F.lit(own_size))))

    def bilinear(row: Column, col: Column) -> Column:
        r, c = F.floor(row), F.floor(col)
        corners = [(value(r + i, c + j), (row - r if i else 1 - (row - r)) * (col - c if j else 1 - (col - c))) for i in (0, 1) for j in (0, 1)]
        mean = lambda *k: sum(F.coalesce(v * w, F.lit(0.0)) for v, w in zip(k[::2], k[1::2])) / F.nullif(sum(F.when(v.isNotNull(), w).otherwise(0.0) for v, w in zip(k[::2], k[1::2])), F.lit(0.0))
        return krovak.bind(mean, **{f"{x}{i}": part for i, corner in enumerate(corners) for x, part in zip("vw", corner, strict=True)})

    def pixel(k: Column) -> Column:
        row, col = F.col("tile_row") * size + F.floor(k / size), F.col("tile_col") * size + k % size
        inside = (row < target.height) & (col < target.width)
        source_row, source_col = there(row, col)
        pick = (lambda r, c: value(F.floor(r + 0.5), F.floor(c + 0.5))) if method == "nearest" else bilinear
        return F.when(inside, krovak.bind(lambda r, c: pick(r, c), r=source_row, c=source_col))

    cells = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), pixel)
    return near.select("tile_row", "tile_col", F.lit(size).alias("h"), F.lit(size).alias("w"), cells.alias("cells"))


def area_average(source: DataFrame, own: Grid, target: Grid) -> DataFrame:
    """(row, col, value, area): the mean of the source on the target grid of the same projection, each pixel by the area that it shares.

    The overlap of two pixels is the product of those of their rows and columns. area is
    what the valid pixels cover, so that value * area adds up to that of the source.
    """
    def overlaps(at: Column, start: float, step: float, other: float, width: float, n: int, down: bool) -> Column:
        # both in units along the axis, from the target's first edge
        near = (other - start if down else start - other) + at * step
        far = near + step
        first, last = F.greatest(F.floor(near / width), F.lit(0)), F.least(F.ceil(far / width) - 1, F.lit(n - 1))
        part = lambda k: F.struct(k.cast("int").alias("k"), (F.least(far, (k + 1) * width) - F.greatest(near, k * width)).alias("w"))
        return F.when(first <= last, F.filter(F.transform(F.sequence(first, last), part), lambda p: p["w"] > 0))

    rows = overlaps(F.col("row"), own.y0, own.dy, target.y0, target.dy, target.height, True)
    columns = overlaps(F.col("col"), own.x0, own.dx, target.x0, target.dx, target.width, False)
    split = source.filter("value IS NOT NULL").select("value", F.explode(rows).alias("r"), columns.alias("c")).select("value", "r", F.explode("c").alias("c"))
    w = F.col("r.w") * F.col("c.w")
    met = split.groupBy(F.col("r.k").alias("row"), F.col("c.k").alias("col")).agg(F.sum(F.col("value") * w).alias("s"), F.sum(w).alias("area"))
    return met.select("row", "col", (F.col("s") / F.col("area")).alias("value"), "area")


def downsample(points: DataFrame, size: float, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """Mean of the values in square pixels aligned to multiples of size (tap_x, tap_y from the west and south)."""
    return points.filter(F.col(value).isNotNull()).groupBy(F.floor(F.col(x) / size).cast("int").alias("tap_x"), F.floor(F.col(y) / size).cast("int").alias("tap_y")).agg(F.avg(value).alias("value"), F.count(value).alias("n"))


def pyramid(pixels: DataFrame, deepest: int, size: int = 256) -> DataFrame:
    """(z, x, y, n, mean) of the tiles of all zooms; pixels: (row, col, value) at the deepest.

    Each pixel is a row for each zoom, summed before the shuffle: one shuffle for the whole pyramid.
    """
    v = pixels.filter("value IS NOT NULL").select((F.floor(F.col("col") / size)).cast("int").alias("tx"), (F.floor(F.col("row") / size)).cast("int").alias("ty"), "value")
    deep = v.groupBy("tx", "ty").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    up = deep.select("n", "s", F.explode(F.transform(F.sequence(F.lit(0), F.lit(deepest)), lambda z: F.struct(z.alias("z"), F.floor(F.col("tx") / F.pow(F.lit(2), deepest - z)).cast("int").alias("x"), F.floor(F.col("ty") / F.pow(F.lit(2), deepest - z)).cast("int").alias("y")))).alias("k"))
    return up.groupBy("k.z", "k.x", "k.y").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).select("z", "x", "y", "n", (F.col("s") / F.col("n")).alias("mean"))


def quad_tree(deepest: DataFrame, zoom: int, size: int) -> dict[int, DataFrame]:
    """The tiles of every zoom from ``zoom`` up to 0: (z, x, y, n, s), counts and sums of the valid deepest pixels under each pixel.

    deepest: (tile_row, tile_col, cells) of size * size. Four children give one parent: a
    child first adds up its squares of four pixels, so that a quarter of a tile is shuffled.
    """
    half = size // 2
    valid = lambda name, f: F.transform("cells", f).alias(name)
    level = deepest.select(F.lit(zoom).alias("z"), F.col("tile_col").alias("x"), F.col("tile_row").alias("y"), valid("n", lambda v: F.when(v.isNotNull(), 1).otherwise(0).cast("long")), valid("s", lambda v: F.coalesce(v, F.lit(0.0))))
    out = {zoom: level}
    for z in range(zoom - 1, -1, -1):
        corner = lambda k: 2 * F.floor(k / half).cast("int") * size + 2 * (k % half)
        added = lambda name: F.transform(F.sequence(F.lit(0), F.lit(half * half - 1)), lambda k: sum(F.get(name, corner(k) + d) for d in (1, size, size + 1)) + F.get(name, corner(k))).alias(name)
        quarter = (F.col("y") % 2 * 2 + F.col("x") % 2).cast("int")
        parts = out[z + 1].select(F.floor(F.col("x") / 2).cast("int").alias("x"), F.floor(F.col("y") / 2).cast("int").alias("y"), F.struct(quarter.alias("q"), added("n"), added("s")).alias("p"))
        met = parts.groupBy("x", "y").agg(F.map_from_entries(F.collect_list(F.struct("p.q", "p"))).alias("m"))
        # the quarter of a parent's pixel, and the place in it
        q = lambda k: (F.floor(k / (size * half)) * 2 + F.floor((k % size) / half)).cast("int")
        at = lambda k: F.floor(k / size).cast("int") % half * half + k % half
        held = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.try_element_at("m", i))
        laid = lambda name, none: F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.coalesce(F.get(F.get("held", q(k))[name], at(k)), F.lit(none))).alias(name)
        out[z] = written(met.withColumn("held", held).select(F.lit(z).alias("z"), "x", "y", laid("n", 0), laid("s", 0.0)), "zoom")
    return out


def means(level: DataFrame) -> DataFrame:
    """(z, x, y, cells): the means of a zoom's pixels; null without a valid one."""
    return level.select("z", "x", "y", F.zip_with("s", "n", lambda s, n: s / F.nullif(n, F.lit(0))).alias("cells"))


def co_partitioned(tile_table: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """tile_table as a table with so many buckets by tile: tables that are made alike meet without a shuffle.

    Zones and classes are written so once, and every year's values once, however often they are joined.
    """
    out = tile_table.write.bucketBy(buckets, "tile_row", "tile_col").sortBy("tile_row", "tile_col").mode("overwrite")
    (out.option("path", path) if path else out).saveAsTable(name)
    return tile_table.sparkSession.table(name)


def colour_relief(pixels: DataFrame, low: float, high: float) -> DataFrame:
    """(row, col, r, g, b, a): the change ramp over [low, high], clamped; nodata is transparent."""
    rgb = colour.change_colour((F.col("value") - low) / (high - low))
    out = pixels.select("row", "col", "value", rgb.alias("k"))
    gone = F.col("value").isNull()
    return out.select("row", "col", *(F.when(gone, 0).otherwise(F.col(f"k.{n}")).alias(n) for n in "rgb"), F.when(gone, 0).otherwise(255).alias("a"))


def summary(pixels: DataFrame, value: str = "value", p: str | None = None) -> DataFrame:
    """Valid cells, minimum, maximum, mean, and the share with p < 0.05."""
    v = F.col(value)
    share = F.avg(F.when(F.col(p).isNotNull(), (F.col(p) < 0.05).cast("int"))) if p else F.lit(None).cast("double")
    return pixels.filter(v.isNotNull()).agg(F.count(v).alias("valid"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), share.alias("share_significant"))


def zoom_grid(min_x: float, min_y: float, max_x: float, max_y: float, zoom: int = 12) -> Grid:
    """The grid of a zoom's pixels (in Web Mercator) over bounds."""
    return Grid.of_bounds(min_x, min_y, max_x, max_y, tiles.pixel_size(zoom))
