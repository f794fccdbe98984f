"""Vector operators: spatial join, rasterize, simplify, dissolve, adjacency.

Features have (id, polygons), polygons being array<array<ring>>; spatial joins
go by a cell key, so that they are equi joins with a residual test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry
from ..session import forget, written
from .grid import Grid


def parts(features: DataFrame, *keys: str) -> DataFrame:
    """(keys, part, rings): multipolygons as single polygons."""
    return features.select(*keys, F.posexplode("polygons").alias("part", "rings"))


def whole(rings: DataFrame, *keys: str) -> DataFrame:
    """(keys, polygons): single polygons back in the order of their parts; the other way of ``parts``."""
    return rings.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "rings"))).alias("p")).select(*keys, F.col("p.rings").alias("polygons"))


def simplify_features(features: DataFrame, tolerance: float, *keys: str) -> DataFrame:
    """features (keys, polygons) with every ring simplified: parts and rings apart, each simplified, and put back."""
    rings = parts(features, *keys).select(*keys, "part", F.posexplode("rings").alias("at", "ring")).withColumn("tolerance", F.lit(float(tolerance)))
    done = simplify(rings).groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("at", "ring"))).alias("r"))
    return whole(done.select(*keys, "part", F.col("r.ring").alias("rings")), *keys)


def covering(polygons: DataFrame, cell: float, key: str = "id") -> DataFrame:
    """(cx, cy, key, inside, edges): the cells that a polygon meets, with the edges that pass through each.

    inside says whether the cell's south-west corner is in the polygon. A cell without
    edges is inside whole, and needs no further test; no cell has rings of its own.
    Overlapping rows of one key are separate polygons.
    """
    own = polygons.select(F.col(key).alias("polygon"), "rings").withColumn("shape", F.xxhash64("rings")).groupBy("polygon", "shape").agg(F.first("rings").alias("rings"))
    edges = own.select("polygon", "shape", F.explode(F.flatten(F.transform("rings", geometry.edges))).alias("e"))
    y1, y2, x1, x2 = (F.col(f"e.{k}") for k in ("y1", "y2", "x1", "x2"))
    low, high, left, right = F.least(y1, y2), F.greatest(y1, y2), F.least(x1, x2), F.greatest(x1, x2)
    at = lambda y: F.when(y1 == y2, x1).otherwise((x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)
    # the cells that an edge passes, row by row of them, a little more rather than less
    room = 1e-9
    rows = edges.withColumn("cy", F.explode(F.sequence(F.floor(low / cell - room), F.floor(high / cell + room))))
    a, b = (at(F.greatest(low, F.least(high, (F.col("cy") + k) * cell))) for k in (0, 1))
    flat = y1 == y2
    first, last = F.when(flat, left).otherwise(F.greatest(left, F.least(a, b))), F.when(flat, right).otherwise(F.least(right, F.greatest(a, b)))
    touched = rows.withColumn("cx", F.explode(F.sequence(F.floor(first / cell - room), F.floor(last / cell + room))))
    passed = touched.groupBy("polygon", "shape", "cx", "cy").agg(F.collect_list("e").alias("edges"))
    # the edges that cross the lower line of each row of cells, from the west
    lines = edges.filter(low < high).withColumn("cy", F.explode(F.expr(f"filter(sequence(cast(ceil(least(e.y1, e.y2) / {cell}D - {room}D) as bigint), cast(ceil(greatest(e.y1, e.y2) / {cell}D + {room}D) as bigint)), r -> least(e.y1, e.y2) <= r * {cell}D and r * {cell}D < greatest(e.y1, e.y2))")))
    crossing = F.struct(at(F.col("cy") * cell).alias("at"), "e")
    crossed = lines.groupBy("polygon", "shape", "cy").agg(F.array_sort(F.collect_list(crossing)).alias("line"))
    x0, y0 = F.col("cx") * cell, F.col("cy") * cell
    west = F.size(F.filter(F.coalesce("line", F.array()), lambda c: ~_east(c["e"], x0, y0)))
    boundary = passed.join(crossed, ["polygon", "shape", "cy"], "left").select("cx", "cy", "polygon", "shape", (west % 2 == 1).alias("inside"), "edges")
    # between an odd crossing and the next one corners are inside
    runs = F.transform(F.sequence(F.lit(1), F.floor(F.size("line") / 2).cast("int")), lambda k: F.struct(F.ceil(F.get("line", 2 * k - 2)["at"] / cell).alias("a"), (F.ceil(F.get("line", 2 * k - 1)["at"] / cell) - 1).alias("b")))
    inner = crossed.filter(F.size("line") > 1).select("polygon", "shape", "cy", F.explode(runs).alias("r")).filter("r.a <= r.b").select("polygon", "shape", "cy", F.explode(F.sequence("r.a", "r.b")).alias("cx"))
    inner = inner.join(passed.select("polygon", "shape", "cx", "cy"), ["polygon", "shape", "cx", "cy"], "left_anti")
    return boundary.unionByName(inner.withColumn("inside", F.lit(True)).withColumn("edges", F.array().cast(boundary.schema["edges"].dataType))).select("cx", "cy", F.col("polygon").alias(key), "inside", "edges")


def _spans(e: Column, x0: Column) -> Column:
    """Whether an edge passes the vertical line at x0."""
    return (e["x1"] <= x0) != (e["x2"] <= x0)


def _height(e: Column, x0: Column) -> Column:
    return (e["y2"] - e["y1"]) * (x0 - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) + e["y1"]


def _east(e: Column, x0: Column, y: Column) -> Column:
    """Whether an edge that passes height y does so east of x0: by its height there, if it passes x0 too, as that is also what crossings of the line at x0 go by."""
    rises = (e["x2"] > e["x1"]) == (e["y2"] > e["y1"])
    return F.when(_spans(e, x0), (_height(e, x0) <= y) == rises).otherwise(e["x1"] > x0)


def _in_cell(held: Column, x: Column, y: Column, x0: Column, y0: Column) -> Column:
    """Whether a point is in a polygon, by the edges of its cell: crossings on the way up from the corner, and from there to the east."""
    up = lambda e: _spans(e, x0) & (_height(e, x0) > y0) & (_height(e, x0) <= y)
    at = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
    along = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & _east(e, x0, y) & ~(x < at(e))
    n = F.aggregate(held["edges"], F.lit(0), lambda acc, e: acc + F.coalesce(up(e), F.lit(False)).cast("int") + F.coalesce(along(e), F.lit(False)).cast("int"))
    return held["inside"] != (n % 2 == 1)


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, *, key: str = "id", how: str = "left") -> DataFrame:
    """points (x, y) with the key of the polygon that they are in; the last key of several; null without one.

    The polygons that meet a cell are one row, each with its edges in that cell only, so a
    point meets all of them by one join and stays one row, whatever else it has.
    """
    held = F.struct(F.col(key).alias("polygon"), "inside", "edges")
    near = covering(polygons, cell, key).groupBy("cx", "cy").agg(F.collect_list(held).alias("near"))
    placed = points.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    x, y, x0, y0 = F.col("x"), F.col("y"), F.col("cx") * cell, F.col("cy") * cell
    inside = lambda p: _in_cell(p, x, y, x0, y0)
    out = placed.join(near, ["cx", "cy"], "left").withColumn(key, F.array_max(F.transform(F.filter("near", inside), lambda p: p["polygon"])))
    return (out if how == "left" else out.filter(F.col(key).isNotNull())).select(*points.columns, key)


def runs(polygons: DataFrame, grid: Grid, *, key: str = "id", order: str = "ord") -> DataFrame:
    """(id, ord, row, first, last): the runs of pixels of each grid row whose centres are in a polygon.

    polygons: (key, ord, rings). A scanline: each edge gives its crossing with every
    row that it spans, and a polygon's crossings of a row, in order, begin and end runs.
    """
    numbered = polygons.select(F.col(key).alias("id"), F.col(order).alias("ord"), F.monotonically_increasing_id().alias("polygon"), "rings")
    out = numbered.select("id", "ord", "polygon", F.explode(F.flatten(F.transform("rings", geometry.edges))).alias("e"))
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    # rows whose centre y has low <= y < high
    first, last = F.greatest(F.floor(grid.place(F.lit(0.0), high)[0]) + 1, F.lit(0)), F.least(F.floor(grid.place(F.lit(0.0), low)[0]), F.lit(grid.height - 1))
    out = out.filter(first <= last).select("id", "ord", "polygon", "e", F.explode(F.sequence(first, last)).alias("row"))
    y = grid.centre(F.col("row"), F.lit(0))[1]
    at = (F.col("e.x2") - F.col("e.x1")) * (y - F.col("e.y1")) / F.nullif(F.col("e.y2") - F.col("e.y1"), F.lit(0.0)) + F.col("e.x1")
    crossed = out.groupBy("id", "ord", "polygon", "row").agg(F.array_sort(F.collect_list(at)).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda k: F.struct(F.get("xs", 2 * k).alias("a"), F.get("xs", 2 * k + 1).alias("b")))
    cut = crossed.filter(F.size("xs") > 1).select("id", "ord", F.col("row").cast("int").alias("row"), F.explode(pairs).alias("p"))
    column = lambda x: F.ceil(grid.place(F.lit(0.0), F.lit(0.0))[1] + x / grid.dx)
    cut = cut.select("id", "ord", "row", F.greatest(column(F.col("p.a")), F.lit(0)).alias("first"), F.least(column(F.col("p.b")) - 1, F.lit(grid.width - 1)).alias("last"))
    return cut.filter("first <= last")


def rasterize(polygons: DataFrame, grid: Grid, *, key: str = "id", order: str = "ord") -> DataFrame:
    """(row, col, value) of the pixels whose centre is in a polygon; later features overwrite earlier ones."""
    pixels = runs(polygons, grid, key=key, order=order).select("id", "ord", "row", F.explode(F.sequence("first", "last")).alias("col"))
    return pixels.groupBy("row", F.col("col").cast("int").alias("col")).agg(F.max_by("id", "ord").alias("value"))


#: Points of lines that are cut together.
POINTS = 250_000


def survival(points: np.ndarray, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For every point the tolerance below which Douglas-Peucker keeps it; infinite at the ends of lines.

    Line k has points[first[k]] to points[last[k]]. Where a line is cut does not depend on
    the tolerance, only how far the cutting goes: a point stays if it, and all points that
    the line was cut at before it, are farther than the tolerance from their chords. The
    pieces of all lines are cut in rounds; those within least[k] are not cut further, and
    their points have minus infinity.
    """
    out = np.full(len(points), -np.inf)
    x, y = points[:, 0], points[:, 1]
    some = first <= last
    out[first[some]] = out[last[some]] = np.inf
    a, b, reach = first, last, np.full(len(first), np.inf)
    while True:
        long = b - a > 1
        a, b, least, reach = a[long], b[long], least[long], reach[long]
        if not len(a):
            return out
        inner = b - a - 1
        begin = np.cumsum(inner) - inner
        piece = np.repeat(np.arange(len(a)), inner)
        at = np.arange(len(piece)) + (a + 1 - begin)[piece]
        ax, ay, dx, dy = x[a], y[a], x[b] - x[a], y[b] - y[a]
        length = np.hypot(dx, dy)
        with np.errstate(divide="ignore", invalid="ignore"):
            distance = np.abs(dx[piece] * (ay[piece] - y[at]) - (ax[piece] - x[at]) * dy[piece]) / length[piece]
        closed = np.flatnonzero((length == 0)[piece])
        distance[closed] = np.hypot(x[at[closed]] - ax[piece[closed]], y[at[closed]] - ay[piece[closed]])
        most = np.maximum.reduceat(distance, begin)
        # the first of the farthest points of each piece
        hit = np.flatnonzero(distance == most[piece])
        k, where = np.unique(piece[hit], return_index=True)
        far = most[k] > least[k]
        k, cut = k[far], at[hit[where]][far]
        out[cut] = np.minimum(reach[k], most[k])
        a, b, least, reach = np.concatenate((a[k], cut)), np.concatenate((cut, b[k])), np.tile(least[k], 2), np.tile(out[cut], 2)


def douglas_peucker(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points stay: rounds instead of recursion; the farthest point stays if farther than the tolerance."""
    keep = survival(points, np.array([0]), np.array([len(points) - 1]), np.array([tolerance])) > tolerance
    keep[[0, -1]] = True
    return keep


def simplify_ring(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Rings of fewer than 5 points stay; a result of fewer than 4 gives the ring back."""
    if len(ring) < 5:
        return ring
    out = ring[douglas_peucker(ring, tolerance)]
    return out if len(out) >= 4 else ring


def _together(lines: pa.ListArray) -> Iterator[tuple[slice, pa.StructArray, np.ndarray, np.ndarray]]:
    """(which lines, points, their x and y, ends) of as many lines at a time as have ``POINTS`` points; ends: where each line's points end, after a zero."""
    sizes = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - 1) // POINTS
    for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            some = slice(int(part[0]), int(part[-1]) + 1)
            points = lines[some].flatten()
            xy = np.column_stack([points.field(k).to_numpy(zero_copy_only=False).astype(float) for k in "xy"])
            yield some, points, xy, np.concatenate(([0], np.cumsum(sizes[some])))


def _ring_stays(xy: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which rings stay whole, by the rules of ``simplify_ring``."""
    return (np.diff(ends) < 5) | (counts < 4)


def _stay(xy: np.ndarray, ends: np.ndarray, survives: np.ndarray, tolerance: np.ndarray, whole=_ring_stays) -> tuple[np.ndarray, np.ndarray]:
    """(which points stay, how many of each line)."""
    count = lambda: np.diff(np.concatenate(([0], np.cumsum(keep)))[ends])
    keep = survives > np.repeat(tolerance, np.diff(ends))
    keep[ends[:-1][ends[:-1] < ends[1:]]] = keep[ends[1:][ends[:-1] < ends[1:]] - 1] = True
    keep |= np.repeat(whole(xy, ends, count()), np.diff(ends))
    return keep, count()


def shortened(lines: pa.ListArray, tolerance: np.ndarray, whole=_ring_stays) -> pa.ListArray:
    """Lines, each by its tolerance; whole says which of them stay as they are: a function of x and y, the lines' ends, and how many points each would keep."""
    done = []
    for some, points, xy, ends in _together(lines):
        keep, counts = _stay(xy, ends, survival(xy, ends[:-1], ends[1:] - 1, tolerance[some]), tolerance[some], whole)
        starts = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        done.append(pa.ListArray.from_arrays(starts, points.filter(pa.array(keep)), type=lines.type, mask=lines[some].is_null()))
    return pa.concat_arrays(done) if done else lines


def simplify(rings: DataFrame, tolerance: str = "tolerance") -> DataFrame:
    """rings (any columns, ring, tolerance) with simplified rings; the rings of an Arrow batch are cut together."""
    at, limit_at = rings.columns.index("ring"), rings.columns.index(tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch.columns
            arrays[at] = shortened(arrays[at], arrays[limit_at].to_numpy(zero_copy_only=False).astype(float))
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return rings.mapInArrow(run, rings.schema)


def tolerance_sweep(rings: DataFrame, tolerances: tuple[float, ...] = (0.0005, 0.0008, 0.0012, 0.002)) -> DataFrame:
    """Points before and after for each tolerance. A ring is cut once, as far as the least of them goes; each task adds up its points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points, xy, ends in _together(batch.column(0)):
                n = len(ends) - 1
                survives = survival(xy, ends[:-1], ends[1:] - 1, np.full(n, min(tolerances)))
                after = [int(_stay(xy, ends, survives, np.full(n, t))[1].sum()) for t in tolerances]
                yield pa.RecordBatch.from_pydict({"tolerance": [float(t) for t in tolerances], "before": [len(points)] * len(after), "after": after})

    counted = rings.select("ring").mapInArrow(run, "tolerance double, before bigint, after bigint")
    return counted.groupBy("tolerance").agg(F.sum("before").alias("points_before"), F.sum("after").alias("points_after"))


def ring_edges(polygons: DataFrame, *keys: str) -> DataFrame:
    """(keys, x1, y1, x2, y2, a, b): directed edges, and their ends in a fixed order."""
    out = polygons.select(*keys, F.explode("rings").alias("ring")).select(*keys, F.explode(geometry.edges(F.col("ring"))).alias("e")).select(*keys, "e.*")
    p, q = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    return out.withColumn("a", F.least(p, q)).withColumn("b", F.greatest(p, q))


def outline(polygons: DataFrame, region: str = "region") -> DataFrame:
    """Edges of each region that only one of its zones has: shared edges cancel."""
    return ring_edges(polygons, region).groupBy(region, "a", "b").agg(F.count("*").alias("n"), F.first("x1").alias("x1"), F.first("y1").alias("y1"), F.first("x2").alias("x2"), F.first("y2").alias("y2")).filter("n = 1").drop("n", "a", "b")


def _clockwise(incoming: tuple[float, float], outgoing: tuple[float, float]) -> float:
    """The angle, clockwise, from the way back along an edge to another one; straight back comes last."""
    turn = math.atan2(-incoming[1], -incoming[0]) - math.atan2(outgoing[1], outgoing[0])
    return turn % (2 * math.pi) or 2 * math.pi


def stitch(edges: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """Directed edges to closed rings; where rings touch, each goes on around its own inside, on the left."""
    after: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for x1, y1, x2, y2 in sorted(edges):
        after.setdefault((x1, y1), []).append((x2, y2))
    rings = []
    while after:
        start = next(iter(after))
        first = after[start].pop()
        if not after[start]:
            del after[start]
        ring, before, at = [start, first], start, first
        while at in after:
            way = (at[0] - before[0], at[1] - before[1])
            ways = after[at] + ([first] if at == start else [])  # the ring's own first edge ends it, if it is the next one
            nxt = min(ways, key=lambda p: _clockwise(way, (p[0] - at[0], p[1] - at[1])))
            if at == start and nxt == first:
                break
            after[at].remove(nxt)
            if not after[at]:
                del after[at]
            ring.append(nxt)
            before, at = at, nxt
        if len(ring) > 3 and ring[0] == ring[-1]:
            rings.append(ring)
    return rings


def followers(edges: DataFrame, *keys: str) -> DataFrame:
    """(id, next): the edge that follows each edge (keys, id, x1, y1, x2, y2) at its end, by the same rule; null without one.

    The edges of a point are a few. They are taken in turn clockwise, the ways back along
    those that come in and those that go out, so that no two are followed by the same.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    comes = edges.select(*keys, F.col("x2").alias("x"), F.col("y2").alias("y"), F.struct((-F.atan2(-dy, -dx)).alias("turn"), "id").alias("in"), F.lit(None).cast("struct<turn:double,id:bigint>").alias("out"))
    goes = edges.select(*keys, F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(None).cast("struct<turn:double,id:bigint>").alias("in"), F.struct((-F.atan2(dy, dx)).alias("turn"), "id").alias("out"))
    met = comes.union(goes).groupBy(*keys, "x", "y").agg(F.array_sort(F.collect_list("in")).alias("ins"), F.array_sort(F.collect_list("out")).alias("outs"))
    # the first edge out that is further clockwise than the first one in
    first = F.expr("size(filter(outs, o -> o.turn <= ins[0].turn))")
    pair = F.expr("transform(ins, (e, i) -> named_struct('id', e.id, 'next', if(i < size(outs), outs[(i + first) % size(outs)].id, null)))")
    return met.filter(F.size("ins") > 0).withColumn("first", first).select(F.inline(pair))


def ranked_rings(edges: DataFrame, *keys: str) -> DataFrame:
    """(keys, ring): the closed rings of directed edges (keys, x1, y1, x2, y2), however long, by list ranking.

    Every edge points to its follower; in each round pointers double their reach, so that
    an edge learns the smallest edge of its ring, and how far it is, in the logarithm of
    the ring's length. Rounds are written; no group but a point's few edges is in one task.
    Edges that close no ring are left out.
    """
    numbered = written(edges.select(*keys, "x1", "y1", "x2", "y2").withColumn("id", F.monotonically_increasing_id()), "edges")
    state = written(followers(numbered, *keys).select("id", "next", F.col("id").alias("best"), F.lit(0).cast("long").alias("far")), "rank")
    step, before = 1, None
    while True:
        now = tuple(state.agg(F.sum(F.col("best").cast("decimal(38,0)")), F.count("next")).collect()[0])
        if now == before:
            break
        other = state.select(F.col("id").alias("next"), F.col("next").alias("over"), F.col("best").alias("their"), F.col("far").alias("further"))
        less = F.col("their") < F.col("best")
        both = state.join(other, "next", "left").select("id", F.col("over").alias("next"), F.when(less, F.col("their")).otherwise(F.col("best")).alias("best"), F.when(less, F.col("further") + step).otherwise(F.col("far")).alias("far"))
        old, state = state, written(both, "rank")
        forget(old)
        step, before = 2 * step, now
    place = F.when(F.col("far") == 0, F.lit(-(1 << 62))).otherwise(-F.col("far"))
    points = numbered.join(state.filter("next IS NOT NULL"), "id").groupBy(*keys, "best").agg(F.array_sort(F.collect_list(F.struct(place.alias("k"), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("p")))).alias("v"))
    return points.filter(F.size("v") > 2).select(*keys, F.expr("concat(v.p, array(v[0].p))").alias("ring"))


#: Edges of a region that one task stitches.
GROUP = 100_000


def dissolve(polygons: DataFrame, *, region: str = "region", least_m2: float = 0.0, group: int = GROUP) -> DataFrame:
    """(region, ring, area): outlines of the regions, lobes apart, small ones left out unless all are.

    A region with at most ``group`` edges is stitched in one task, others by list ranking.
    Rings are written, so that what is made of them does not stitch again.
    """
    kind = polygons.schema[region].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = stitch(list(pdf[["x1", "y1", "x2", "y2"]].itertuples(index=False, name=None)))
        return pd.DataFrame({region: [pdf[region].iloc[0]] * len(found), "ring": [[{"x": x, "y": y} for x, y in r] for r in found]})

    edges = written(outline(polygons, region), "outline")
    large = edges.groupBy(region).agg(F.count("*").alias("n")).filter(F.col("n") > group).select(region)
    some = edges if large.isEmpty() else edges.join(large, region, "left_anti")
    rings = some.groupBy(region).applyInPandas(run, f"{region} {kind}, ring {geometry.RING}")
    if some is not edges:
        rings = rings.union(ranked_rings(edges.join(large, region, "left_semi"), region))
    rings = written(rings, "rings")
    forget(edges)
    sized = rings.withColumn("area", F.abs(geometry.signed_area(F.col("ring"))))
    largest = F.max("area").over(Window.partitionBy(region))
    return sized.withColumn("largest", largest).filter((F.col("area") >= least_m2) | (F.col("largest") < least_m2)).drop("largest")


def turned(polygons: DataFrame) -> DataFrame:
    """polygons with outer rings counter-clockwise and holes clockwise, so that the inside is on the left of every edge."""
    ring = lambda r, i: F.when((geometry.signed_area(r) > 0) == (i == 0), r).otherwise(F.reverse(r))
    return polygons.withColumn("rings", F.transform("rings", ring))


def dissolve_polygons(polygons: DataFrame, *, region: str = "region", least_m2: float = 2e6, area=geometry.geodesic_area) -> DataFrame:
    """(region, rings, area): the lobes of each region, each with its holes; area: of the outer ring.

    Lobes and holes below ``least_m2`` are slivers and go, but for the largest lobe of a
    region without another. A region whose edges close no ring keeps its members' polygons.
    """
    own = turned(polygons)
    rings = dissolve(own, region=region).withColumn("size", area(F.col("ring")))
    lobes = rings.filter(geometry.signed_area(F.col("ring")) > 0).select(region, "ring", "size", F.xxhash64("ring").alias("lobe"))
    holes = rings.filter((geometry.signed_area(F.col("ring")) < 0) & (F.col("size") >= least_m2)).select(region, F.col("ring").alias("hole"), F.col("ring")[0].alias("p"))
    # a region's rings are few; a hole is in the smallest lobe that holds a point of its edge
    first, second = F.col("hole")[0], F.col("hole")[1]
    x, y = (first["x"] + second["x"]) / 2, (first["y"] + second["y"]) / 2
    inside = holes.join(lobes, region).filter(geometry.within(x, y, F.array("ring")) | F.exists("ring", lambda q: (q["x"] == first["x"]) & (q["y"] == first["y"])))
    placed = inside.groupBy(region, "hole").agg(F.min_by("lobe", F.struct("size", "lobe")).alias("lobe")).groupBy(region, "lobe").agg(F.collect_list("hole").alias("holes"))
    largest = F.max("size").over(Window.partitionBy(region))
    kept = lobes.withColumn("largest", largest).filter((F.col("size") >= least_m2) | ((F.col("largest") < least_m2) & (F.col("size") == F.col("largest"))))
    out = kept.join(placed, [region, "lobe"], "left").select(region, F.concat(F.array("ring"), F.coalesce("holes", F.array().cast(f"array<{geometry.RING}>"))).alias("rings"), F.col("size").alias("area"))
    rest = own.join(lobes.select(region).distinct(), region, "left_anti").select(region, "rings", area(F.col("rings")[0]).alias("area"))
    return out.union(rest)


def adjacency(polygons: DataFrame, key: str = "zone") -> DataFrame:
    """(zone, neighbor) of zones that share an edge, both ways. An edge has two sides, so its group is two rows."""
    sides = ring_edges(polygons, key).groupBy("a", "b").agg(F.collect_set(key).alias("zones")).filter(F.size("zones") > 1)
    both = sides.select(F.explode("zones").alias(key), "zones").select(key, F.explode("zones").alias("neighbor")).filter(F.col(key) != F.col("neighbor"))
    return both.distinct()
