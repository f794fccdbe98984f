"""Coverages as arcs: polygons that share borders, simplified without gaps or overlaps.

A junction is a point from which borders go in more than two directions. Rings are
cut at junctions into arcs; an arc has the same points, in one direction, for the
polygons on both of its sides, so it is simplified once and put back into both.
Points and arcs are shuffled, whole polygons never; a task holds rings of one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry
from ..session import forget, written
from .vector import shortened

RING = ["part", "hole"]


def rings_of(features: DataFrame, *keys: str) -> DataFrame:
    """(keys, part, hole, ring) of features (keys, polygons)."""
    return features.select(*keys, F.posexplode("polygons").alias("part", "rings")).select(*keys, "part", F.posexplode("rings").alias("hole", "ring"))


def features_of(rings: DataFrame, *keys: str) -> DataFrame:
    """The other way of ``rings_of``."""
    parts = rings.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("hole", "ring"))).alias("r"))
    return parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", F.col("r.ring").alias("rings")))).alias("p")).select(*keys, F.col("p.rings").alias("polygons"))


def arcs(rings: DataFrame, *keys: str) -> DataFrame:
    """(keys, part, hole, at, forward, arc, line): the arcs of every ring in their order.

    line is in the direction that both sides share, arc its name, and forward says
    whether the ring goes along it so. A ring without a junction is one arc from its
    smallest point. Rings are closed and have at least three points.
    """
    n = F.size("ring") - 1
    corner = lambda i: F.struct(i.alias("i"), F.get("ring", i).alias("p"), F.array(F.get("ring", F.when(i == 0, n - 1).otherwise(i - 1)), F.get("ring", i + 1)).alias("beside"))
    points = rings.select(*keys, *RING, F.explode(F.transform(F.sequence(F.lit(0), n - 1), corner)).alias("v")).select(*keys, *RING, "v.*")
    ways = F.size(F.array_distinct(F.flatten(F.collect_set("beside").over(Window.partitionBy("p")))))
    marked = points.withColumn("junction", ways > 2)
    whole = marked.groupBy(*keys, *RING).agg(F.array_sort(F.collect_list(F.struct("i", "p", "junction"))).alias("v"))
    whole = whole.withColumn("marks", F.expr("transform(filter(v, x -> x.junction), x -> x.i)")).withColumn("p", F.expr("transform(v, x -> x.p)"))
    whole = whole.withColumn("start", F.expr("if(size(marks) > 0, marks[0], cast(array_position(p, array_min(p)) as int) - 1)"))
    whole = whole.withColumn("turned", F.expr("concat(slice(p, start + 1, size(p) - start), slice(p, 1, start), array(p[start]))"))
    whole = whole.withColumn("cuts", F.expr("concat(if(size(marks) > 0, transform(marks, m -> m - start), array(0)), array(size(p)))"))
    lines = F.expr("transform(sequence(0, size(cuts) - 2), k -> slice(turned, cuts[k] + 1, cuts[k + 1] - cuts[k] + 1))")
    each = whole.select(*keys, *RING, F.posexplode(lines).alias("at", "own")).withColumn("forward", F.col("own") <= F.reverse("own"))
    named = each.withColumn("line", F.when(F.col("forward"), F.col("own")).otherwise(F.reverse("own")))
    arc = F.struct(F.get("line", F.lit(0)).alias("a"), F.get("line", F.lit(1)).alias("b"), F.element_at("line", -1).alias("c"), F.size("line").alias("n"))
    return named.select(*keys, *RING, "at", "forward", arc.alias("arc"), "line")


def simplify_lines(lines: DataFrame, tolerance: float) -> DataFrame:
    """lines (any columns, line) with ``short``: the ends stay; a closed line that would have fewer than four points stays whole."""
    at = lines.columns.index("line")

    def collapsed(xy: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (xy[ends[:-1]] == xy[ends[1:] - 1]).all(axis=1) & (counts < 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = shortened(batch.column(at), np.full(batch.num_rows, float(tolerance)), collapsed)
            yield pa.RecordBatch.from_arrays([*batch.columns, short], names=[*batch.schema.names, "short"])

    return lines.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in lines.schema)}, short {geometry.RING}")


def crossings(lines: DataFrame, cell: float, name: str = "arc", line: str = "now") -> DataFrame:
    """(a, b): pairs of names of lines with segments that cross, touch or lie on each other other than at common ends. Segments meet by cell."""
    pieces = lines.select(F.col(name).alias("name"), F.posexplode(geometry.edges(F.col(line))).alias("k", "e")).select("name", "k", "e.*")
    low = lambda a, b: F.floor(F.least(a, b) / cell)
    high = lambda a, b: F.floor(F.greatest(a, b) / cell)
    placed = pieces.withColumn("cx", F.explode(F.sequence(low("x1", "x2"), high("x1", "x2")))).withColumn("cy", F.explode(F.sequence(low("y1", "y2"), high("y1", "y2"))))
    one = placed.select("cx", "cy", *(F.col(c).alias(f"a_{c}") for c in pieces.columns))
    two = placed.select("cx", "cy", *(F.col(c).alias(f"b_{c}") for c in pieces.columns))
    point = lambda s, i: (F.col(f"{s}_x{i}"), F.col(f"{s}_y{i}"))

    def side(s, p):
        (ax, ay), (bx, by) = point(s, 1), point(s, 2)
        return F.signum((bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax))

    same = lambda p, q: (p[0] == q[0]) & (p[1] == q[1])
    ends = [same(point("a", i), point("b", j)) for i in (1, 2) for j in (1, 2)]
    shared = sum(e.cast("int") for e in ends[1:]) + ends[0].cast("int")
    meets = lambda s, t: side(s, point(t, 1)) * side(s, point(t, 2)) <= 0
    apart = lambda k: (F.greatest(f"a_{k}1", f"a_{k}2") >= F.least(f"b_{k}1", f"b_{k}2")) & (F.greatest(f"b_{k}1", f"b_{k}2") >= F.least(f"a_{k}1", f"a_{k}2"))
    crossed = F.when(shared == 0, meets("a", "b") & meets("b", "a")).when(shared == 2, True).otherwise(False)
    order = F.struct("a_name", "a_k") < F.struct("b_name", "b_k")
    met = one.join(two, ["cx", "cy"]).filter(order & apart("x") & apart("y") & crossed)
    return met.select(F.col("a_name").alias("a"), F.col("b_name").alias("b")).distinct()


def simplify_coverage(features: DataFrame, tolerance: float, *keys: str) -> DataFrame:
    """features (keys, polygons), simplified: borders that two of them share stay the same for both, and so do all neighbours.

    Arcs whose short form would make a ring collapse or cross another arc stay as they
    are. Rings of fewer than three different points stay as they are, too.
    """
    rings = rings_of(features, *keys)
    cut = written(arcs(rings.filter(F.size("ring") > 3), *keys), "arcs")
    lines = cut.groupBy("arc").agg(F.first("line").alias("line"))
    state = written(simplify_lines(lines, tolerance).select("arc", "line", F.col("short").alias("now")), "lines")
    uses = cut.select(*keys, *RING, "arc")
    span = F.explode(geometry.edges(F.col("now"))).alias("e")
    mean = state.select(span).agg(F.avg(F.greatest(F.abs(F.col("e.x2") - F.col("e.x1")), F.abs(F.col("e.y2") - F.col("e.y1"))))).collect()[0][0]
    cell = max(2 * (mean or 0.0), tolerance, 1e-12)
    while True:
        sizes = Window.partitionBy(*keys, *RING)
        collapsed = uses.join(state.select("arc", "now"), "arc").withColumn("points", F.sum(F.size("now") - 1).over(sizes)).filter("points < 3").select("arc")
        crossed = crossings(state, cell)
        bad = collapsed.union(crossed.select("a")).union(crossed.select("b")).distinct()
        bad = written(bad.join(state.filter("now != line").select("arc"), "arc", "left_semi"), "bad")
        if bad.isEmpty():
            forget(bad)
            break
        # what goes back to its whole form never changes again, so this ends
        before, state = state, written(state.join(bad.withColumn("back", F.lit(True)), "arc", "left").select("arc", "line", F.when(F.col("back"), F.col("line")).otherwise(F.col("now")).alias("now")), "lines")
        forget(before, bad)
    way = F.when(F.col("forward"), F.col("now")).otherwise(F.reverse("now"))
    sides = cut.select(*keys, *RING, "at", "forward", "arc").join(state.select("arc", "now"), "arc").withColumn("way", way)
    joined = sides.groupBy(*keys, *RING).agg(F.array_sort(F.collect_list(F.struct("at", "way"))).alias("w"))
    joined = joined.withColumn("open", F.expr("flatten(transform(w, x -> slice(x.way, 1, size(x.way) - 1)))"))
    done = joined.select(*keys, *RING, F.concat("open", F.array(F.get("open", F.lit(0)))).alias("ring"))
    return features_of(done.union(rings.filter(F.size("ring") <= 3).select(*keys, *RING, "ring")), *keys)
