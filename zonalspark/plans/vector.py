"""Vector queries: nations as unit boxes on a five by five board, customers as points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import topology, vector
from ..operators.grid import Grid
from .common import even, even_sql

BOARD = Grid(0.0, 5.0, 0.1, 0.1, 50, 50)


def _boxes(spark, d):
    """(zone, region, polygons): zone k is at (k mod 5, k div 5); zone 12 has a hole."""
    nation = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("int").alias("zone"), F.col("n_regionkey").cast("int").alias("region"))
    x, y = (F.col("zone") % 5).cast("double"), F.floor(F.col("zone") / 5).cast("double")
    ring = lambda a, b: F.array(*(F.struct((x + u).alias("x"), (y + v).alias("y")) for u, v in ((a, a), (b, a), (b, b), (a, b), (a, a))))
    rings = F.when(F.col("zone") == 12, F.array(ring(0.0, 1.0), ring(0.25, 0.75))).otherwise(F.array(ring(0.0, 1.0)))
    return nation.withColumn("polygons", F.array(rings))


def _parts(spark, d):
    return vector.parts(_boxes(spark, d), "zone", "region")


def _points(spark, d):
    key = F.col("c_custkey")
    return spark.read.parquet(f"{d}/customer.parquet").select(key.alias("point_id"), (F.pmod(key * 37, F.lit(577)) / 100.0).alias("x"), (F.pmod(key * 91, F.lit(563)) / 100.0).alias("y"))


def point_in_region(spark, d):
    """Zone and region of each customer's point, null outside of all zones and in the hole."""
    found = vector.points_in_polygons(_points(spark, d), _parts(spark, d), 1.0, key="zone")
    zones = _boxes(spark, d).select("zone", "region")
    return even(found.join(zones, "zone", "left").select("point_id", "zone", "region"))


def rasterize_boxes(spark, d):
    """Boxes half as large again, so that later zones overwrite earlier ones."""
    wide = _parts(spark, d).select("zone", F.col("zone").alias("ord"), F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] * 0.9 + 0.013).alias("x"), (p["y"] * 0.9 + 0.017).alias("y")))).alias("rings"))
    return even(vector.rasterize(wide, BOARD, key="zone"))


def polygon_measures(spark, d):
    """Area less holes, centroid of the outer ring, points, and bounds."""
    rings = F.col("rings")
    outer = F.get(rings, F.lit(0))
    out = _parts(spark, d).select("zone", geometry.polygon_area(rings).alias("area"), geometry.centroid(outer).alias("c"), geometry.bounds(outer).alias("b"))
    return even(out.select("zone", "area", F.col("c.x").alias("cx"), F.col("c.y").alias("cy"), "b.*"))


def vertex_counts(spark, d):
    return even(_boxes(spark, d).select("zone", geometry.vertex_count(F.col("polygons")).alias("points")))


def geodesic_areas(spark, d):
    """Square kilometres of each box with its corners as degrees from (12 E, 48 N)."""
    moved = F.transform(F.get("rings", F.lit(0)), lambda p: F.struct((p["x"] + 12).alias("x"), (p["y"] + 48).alias("y")))
    return even(_parts(spark, d).select("zone", (geometry.geodesic_area(moved) / 1e6).alias("km2")), 3)


def adjacency(spark, d):
    return even(vector.adjacency(_parts(spark, d)))


def dissolve_edges(spark, d):
    """Outline edges of each region: edges that two of its zones share are gone."""
    return even(vector.outline(_parts(spark, d)))


def dissolve_rings(spark, d):
    """Outlines of the regions as closed rings, lobes apart."""
    out = vector.dissolve(_parts(spark, d))
    return even(out.select("region", "area", F.size("ring").alias("points")))


def dissolved_regions(spark, d):
    """Area of the lobes of each region less their holes, and how many holes there are."""
    out = vector.dissolve_polygons(_parts(spark, d), least_m2=0.0, area=lambda ring: F.abs(geometry.signed_area(ring)))
    return even(out.groupBy("region").agg(F.sum(geometry.polygon_area(F.col("rings"))).alias("area")))


def multipart_round_trip(spark, d):
    """Polygons simplified ring by ring with no tolerance: what goes in comes out."""
    out = vector.simplify_features(_boxes(spark, d), 0.0, "zone")
    return even(out.select("zone", F.size("polygons").alias("parts"), geometry.vertex_count(F.col("polygons")).alias("points"), geometry.polygon_area(F.col("polygons")[0]).alias("area")))


def _zigzag(spark, d):
    """A closed ring for each supplier, with small and large teeth. Keys are dealt to all tasks first: their file is a task or two, and rings cost more than reading."""
    k = F.col("s_suppkey")
    ring = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.struct(((F.lit(1) + F.pmod(k * (i % 40), F.lit(7)) / 2000.0) * F.cos((i % 40) * 0.15707963)).alias("x"), ((F.lit(1) + F.pmod(k * (i % 40), F.lit(11)) / 3000.0) * F.sin((i % 40) * 0.15707963)).alias("y")))
    keys = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey").repartition(spark.sparkContext.defaultParallelism)
    return keys.select(k.alias("id"), ring.alias("ring"))


def simplify_dp(spark, d):
    rings = _zigzag(spark, d).withColumn("tolerance", F.lit(0.002))
    return even(vector.simplify(rings).select("id", F.size("ring").alias("points")))


def simplify_sweep(spark, d):
    return even(vector.tolerance_sweep(_zigzag(spark, d)))


def simplified_coverage(spark, d):
    """Boxes with rough outer sides, which neighbours share, simplified together: neighbours, points and area of each."""
    def rough(e):
        """Eight points of an edge; those between its ends are moved by what their place says, the same for both sides."""
        def point(t):
            x, y = e["x1"] + (e["x2"] - e["x1"]) * t / 8, e["y1"] + (e["y2"] - e["y1"]) * t / 8
            off = F.when(t > 0, F.sin(x * 40 + y * 90) / 50).otherwise(0.0)
            level = e["y1"] == e["y2"]
            return F.struct((x + F.when(level, 0.0).otherwise(off)).alias("x"), (y + F.when(level, off).otherwise(0.0)).alias("y"))

        return F.transform(F.sequence(F.lit(0), F.lit(7)), point)

    ring = lambda r: F.concat(F.flatten(F.transform(geometry.edges(r), rough)), F.array(r[0]))
    rings = F.transform("polygons", lambda polygon: F.transform(polygon, lambda r, i: F.when(i == 0, ring(r)).otherwise(r)))
    out = topology.simplify_coverage(_boxes(spark, d).withColumn("polygons", rings).select("zone", "polygons"), 0.05, "zone")
    near = vector.adjacency(vector.parts(out, "zone").select("zone", "rings")).groupBy("zone").agg(F.count("*").alias("neighbours"))
    return even(out.join(near, "zone").select("zone", "neighbours", geometry.vertex_count(F.col("polygons")).alias("points"), geometry.polygon_area(F.col("polygons")[0]).alias("area")))


_BOX = "z AS (SELECT n_nationkey AS zone, n_regionkey AS region, CAST(n_nationkey % 5 AS DOUBLE) AS x, CAST(n_nationkey // 5 AS DOUBLE) AS y FROM nation)"
_PT = "p AS (SELECT c_custkey AS point_id, c_custkey * 37 % 577 / 100e0 AS x, c_custkey * 91 % 563 / 100e0 AS y FROM customer)"
_IN = "p.x >= z.x AND p.x < z.x + 1 AND p.y >= z.y AND p.y < z.y + 1 AND NOT (zone = 12 AND p.x >= z.x + 0.25e0 AND p.x < z.x + 0.75e0 AND p.y >= z.y + 0.25e0 AND p.y < z.y + 0.75e0)"
_EDGES = f"""WITH {_BOX}, e0 AS (SELECT zone, region, x + a * s + o AS x1, y + b * s + o AS y1, x + c * s + o AS x2, y + d * s + o AS y2 FROM z, (VALUES (1e0, 0e0), (0.5e0, 0.25e0)) AS r(s, o), (VALUES (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)) AS q(a, b, c, d) WHERE s = 1 OR zone = 12),
 e AS (SELECT *, least((x1, y1), (x2, y2)) AS a, greatest((x1, y1), (x2, y2)) AS b FROM e0)"""
_R = "r AS (SELECT zone, x * 0.9e0 + 0.013e0 AS x0, (x + 1) * 0.9e0 + 0.013e0 AS x1, y * 0.9e0 + 0.017e0 AS y0, (y + 1) * 0.9e0 + 0.017e0 AS y1, (x + 0.25e0) * 0.9e0 + 0.013e0 AS hx0, (x + 0.75e0) * 0.9e0 + 0.013e0 AS hx1, (y + 0.25e0) * 0.9e0 + 0.017e0 AS hy0, (y + 0.75e0) * 0.9e0 + 0.017e0 AS hy1 FROM z)"
_C = "c AS (SELECT i AS row, j AS col, (j + 0.5e0) * 0.1e0 AS px, 5e0 - (i + 0.5e0) * 0.1e0 AS py FROM (SELECT unnest(range(50)) AS i) a, (SELECT unnest(range(50)) AS j) b)"

QUERIES = {
    "point_in_region": (point_in_region, even_sql(f"WITH {_BOX}, {_PT} --\nSELECT point_id, zone, region FROM p LEFT JOIN z ON {_IN}", "point_id zone region")),
    "rasterize_boxes": (rasterize_boxes, even_sql(f"WITH {_BOX}, {_R}, {_C} --\nSELECT row, col, max(zone) AS value FROM c JOIN r ON px >= x0 AND px < x1 AND py >= y0 AND py < y1 AND NOT (zone = 12 AND px >= hx0 AND px < hx1 AND py >= hy0 AND py < hy1) GROUP BY row, col", "row col value")),
    "polygon_measures": (polygon_measures, even_sql(f"WITH {_BOX} --\nSELECT zone, CASE WHEN zone = 12 THEN 0.75e0 ELSE 1e0 END AS area, x + 0.5e0 AS cx, y + 0.5e0 AS cy, x AS min_x, y AS min_y, x + 1 AS max_x, y + 1 AS max_y FROM z", "zone", "area cx cy min_x min_y max_x max_y")),
    "vertex_counts": (vertex_counts, even_sql(f"WITH {_BOX} --\nSELECT zone, CASE WHEN zone = 12 THEN 10 ELSE 5 END AS points FROM z", "zone points")),
    "geodesic_areas": (geodesic_areas, even_sql(f"WITH {_BOX} --\nSELECT zone, radians(1) * (sin(radians(y + 49)) - sin(radians(y + 48))) * {geometry.EARTH}e0 * {geometry.EARTH}e0 / 1e6 AS km2 FROM z", "zone", "km2", digits=3)),
    "adjacency": (adjacency, even_sql(f"{_EDGES} --\nSELECT DISTINCT m.zone, n.zone AS neighbor FROM e m JOIN e n ON m.a = n.a AND m.b = n.b AND m.zone <> n.zone", "zone neighbor")),
    "dissolve_edges": (dissolve_edges, even_sql(f"{_EDGES} --\nSELECT region, any_value(x1) AS x1, any_value(y1) AS y1, any_value(x2) AS x2, any_value(y2) AS y2 FROM e GROUP BY region, a, b HAVING count(*) = 1", "region", "x1 y1 x2 y2")),
    "dissolve_rings": (dissolve_rings, None),
    "dissolved_regions": (dissolved_regions, even_sql(f"WITH {_BOX} --\nSELECT region, sum(CASE WHEN zone = 12 THEN 0.75e0 ELSE 1e0 END) AS area FROM z GROUP BY region", "region", "area")),
    "multipart_round_trip": (multipart_round_trip, even_sql(f"WITH {_BOX} --\nSELECT zone, 1 AS parts, CASE WHEN zone = 12 THEN 10 ELSE 5 END AS points, CASE WHEN zone = 12 THEN 0.75e0 ELSE 1e0 END AS area FROM z", "zone parts points", "area")),
    "simplified_coverage": (simplified_coverage, even_sql(f"WITH {_BOX} --\nSELECT a.zone, count(*) AS neighbours, CASE WHEN a.zone = 12 THEN 10 ELSE 5 END AS points, CASE WHEN a.zone = 12 THEN 0.75e0 ELSE 1e0 END AS area FROM z a JOIN z b ON abs(a.x - b.x) + abs(a.y - b.y) = 1 GROUP BY a.zone", "zone neighbours points", "area")),
    "simplify_dp": (simplify_dp, None),
    "simplify_sweep": (simplify_sweep, None),
}
