"""What a map and a report show: fills, tips, legends, texts, names in order, and the shapes of grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import colour, formats, geometry
from ..operators import compare, regress
from ..sources import sinks
from ..tables import BUCKET_NAMES
from .common import even, even_sql
from .compare import _ALL, _CG, _ZY, FIRST, LAST, _change, _names, _zone_years
from .grid import _hex_sql
from .trends import _DF, _S, _TVALUE, KEYS, YEARS, _zonal, p_value_sql
from .vector import _boxes, _points

PIXEL = 0.3
TEMPLATE = "{NAME} is zone {ZONE} of {NAME}"
DIGITS = {"edge": 6, "share": 8}


def choropleth_fills(spark, d):
    return even(compare.fills(_zone_years(spark, d), LAST, FIRST, LAST))


def zone_tips(spark, d):
    """Every tip of each zone: its dominant class, and levels and changes of the composite and the buckets."""
    return even(compare.tips(_zone_years(spark, d), _names(spark, d), LAST, FIRST, LAST))


def legend_labels(spark, d):
    """The ends of a scale that reaches as far as each zone's change, clipped and not."""
    m = F.round(F.abs("value") * 100, 3)
    (low, high), (below, above) = formats.legend_ends(m, False), formats.legend_ends(m, True)
    return even(_change(spark, d).select("zone", low.alias("low"), high.alias("high"), below.alias("below"), above.alias("above")))


def shade_colours(spark, d):
    """Each part type as one of five shades of the colour of a bucket."""
    parts = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.element_at(F.array(*map(F.lit, "FAGU")), (F.col("p_partkey") % 4 + 1).cast("int")).alias("bucket"), (F.col("p_partkey") % 5).alias("i"))
    return even(parts.select("p_partkey", colour.shade(colour.from_hex(colour.fill_class(F.col("bucket"))), F.col("i"), F.lit(5)).alias("shade")))


def line_distances(spark, d):
    """Distance of each point from a line, and from one that is a point."""
    x, y = F.col("x"), F.col("y")
    at = lambda *ends: geometry.point_line_distance(x, y, *map(F.lit, ends))
    return even(_points(spark, d).select("point_id", at(0.0, 0.5, 5.0, 3.0).alias("line"), at(1.0, 1.0, 1.0, 1.0).alias("point")), 6)


def significance_texts(spark, d):
    p = F.col("p")
    fits = regress.ols(_zonal(spark, d), KEYS, y="mean", years=YEARS)
    return even(fits.select(*KEYS, formats.significance(p).alias("kind"), formats.p_text(F.round(p, 4)).alias("text")))


def template_texts(spark, d):
    out = _names(spark, d)
    return even(out.select("zone", formats.fill(F.lit(TEMPLATE), {"NAME": F.col("name"), "ZONE": F.col("zone")}).alias("text")))


def fixed_digits(spark, d):
    """Numbers as text with a fixed number of digits, as in the CSV of a histogram."""
    orders = spark.read.parquet(f"{d}/orders.parquet").groupBy((F.col("o_custkey") % 50).alias("bin")).agg((F.count("*") / 7).alias("share"))
    return even(sinks.fixed(orders.select("bin", (F.col("bin") / 64).alias("edge"), "share"), DIGITS))


def names_in_order(spark, d):
    return even(compare.in_name_order(_names(spark, d)))


def grid_shapes(spark, d):
    """The grid of each region's bounds: columns, rows and the true size of a pixel."""
    box = F.expr("box")
    boxes = _boxes(spark, d).select("region", geometry.bounds(F.col("polygons")[0][0]).alias("box"))
    whole = boxes.groupBy("region").agg(F.min(box["min_x"]).alias("x0"), F.min(box["min_y"]).alias("y0"), F.max(box["max_x"]).alias("x1"), F.max(box["max_y"]).alias("y1"))
    side = lambda a, b: F.ceil((F.col(b) - F.col(a)) / PIXEL)
    out = whole.withColumn("width", side("x0", "x1")).withColumn("height", side("y0", "y1"))
    return even(out.select("region", "width", "height", ((F.col("x1") - F.col("x0")) / F.col("width")).alias("dx"), ((F.col("y1") - F.col("y0")) / F.col("height")).alias("dy")))


def _fills_sql() -> str:
    """Domains and ranges over all zones and years, as the map's rules say: none of it is taken from the chosen years."""
    none, grey = f"'{colour.NO_DATA}'", f"'{colour.NO_VALUE}'"
    level = f"CASE WHEN level IS NULL THEN CASE WHEN bucket = 'I' AND has_year THEN {grey} ELSE {none} END ELSE {_hex_sql('((level - low) / (high - low))', colour.ABSOLUTE_RAMP)} END"
    moved = f"CASE WHEN before IS NULL OR after IS NULL THEN {none} ELSE {_hex_sql('(((after - before) / m + 1) / 2)', colour.CHANGE_RAMP)} END"
    at = lambda y, what="value": f"max(CASE WHEN year = {y} THEN {what} END)"
    own = "CASE arg_max(bucket, share) FILTER (share IS NOT NULL) " + " ".join(f"WHEN '{b}' THEN '{c}'" for b, c in colour.BUCKET_COLOURS.items()) + f" ELSE {none} END"
    columns = [f"coalesce(max(CASE WHEN bucket = '{b}' THEN {kind} END), {none}) AS {b}_{name}" for name, kind in (("level", "lv"), ("change", "ch")) for b in _ALL]
    return f"""{_ZY}, ends AS (SELECT bucket, min(value) AS a, max(value) AS b FROM zy GROUP BY bucket),
 dm AS (SELECT bucket, CASE WHEN bucket = 'I' THEN 0.35e0 WHEN a = b THEN 0 ELSE greatest(0, a - (b - a) * 0.08e0) END AS low, CASE WHEN bucket = 'I' THEN 0.75e0 WHEN a = b THEN 1 ELSE least(1, b + (b - a) * 0.08e0) END AS high FROM ends),
 sp AS (SELECT zone, bucket, max(value) - min(value) AS spread FROM zy GROUP BY zone, bucket),
 ms AS (SELECT bucket, greatest(0.05e0, ceil(round(max(spread) * 20, 9)) / 20) AS m FROM sp GROUP BY bucket),
 wd AS (SELECT zone, bucket, {at(LAST)} AS level, {at(FIRST)} AS before, {at(LAST)} AS after, {at(LAST, 'share')} AS share, bool_or(year = {LAST}) AS has_year FROM zy GROUP BY zone, bucket),
 k AS (SELECT zone, bucket, share, {level} AS lv, {moved} AS ch FROM wd JOIN dm USING (bucket) JOIN ms USING (bucket)) --
SELECT zone, {own} AS dominant, {", ".join(columns)} FROM k GROUP BY zone"""


def _tips_sql() -> str:
    labels = {"I": "IEI", "F": "IEI (Forest)", "A": "IEI (Agricultural Land)", "G": "IEI (Grassland)", "U": "IEI (Urban Areas)"}
    names = "CASE bucket " + " ".join(f"WHEN '{b}' THEN '{x}'" for b, x in BUCKET_NAMES.items()) + " END"
    percent = lambda v: f"CASE WHEN {v} IS NULL THEN 'n/a' ELSE printf('%.0f', round({v} * 100)) || '%' END"
    moved = f"CASE WHEN moved IS NULL THEN 'n/a' ELSE CASE WHEN abs(moved) < 0.0005e0 THEN '→ ' WHEN moved > 0 THEN '▲ ' ELSE '▼ ' END || {_points_sql('moved')} END"
    columns = []
    for b, label in labels.items():
        own = lambda x: f"max(CASE WHEN bucket = '{b}' THEN {x} END)"  # noqa: B023, E731
        columns.append(f"n_name || chr(10) || '{label} {LAST}: ' || coalesce({own(percent('value'))}, 'n/a')" + ("" if b == "I" else f" || chr(10) || 'Regional median: ' || coalesce({own(percent('others'))}, 'n/a')") + f" AS {b}_level")
        columns.append(f"n_name || chr(10) || '{label} {FIRST}→{LAST}: ' || coalesce({own(moved)}, 'n/a') AS {b}_change")
    return f"""{_ZY}, a AS (SELECT zone, bucket, max(CASE WHEN year = {LAST} THEN value END) - max(CASE WHEN year = {FIRST} THEN value END) AS moved FROM zy GROUP BY zone, bucket),
 lv AS (SELECT * FROM zy JOIN a USING (zone, bucket) WHERE year = {LAST}),
 ot AS (SELECT x.zone, x.bucket, any_value(x.value) AS value, any_value(x.share) AS share, any_value(x.moved) AS moved, median(y.value) AS others FROM lv x LEFT JOIN lv y ON x.region = y.region AND x.bucket = y.bucket AND x.zone <> y.zone GROUP BY x.zone, x.bucket),
 top AS (SELECT zone, {names} AS kind, share, row_number() OVER (PARTITION BY zone ORDER BY share DESC, strpos('FAGU', bucket)) AS rn FROM ot WHERE share IS NOT NULL) --
SELECT ot.zone, n_name || chr(10) || 'Dominant class: ' || any_value(kind) || ' (' || any_value({percent('top.share')}) || ' share of area)' AS dominant, {", ".join(columns)}
 FROM ot JOIN top ON ot.zone = top.zone AND rn = 1 JOIN nation ON ot.zone = n_nationkey + 1 GROUP BY ot.zone, n_name"""


def _points_sql(v: str) -> str:
    """Percentage points as text."""
    v = f"greatest(least({v} * 100, 100), -100)"
    return f"CASE WHEN round({v}, 1) > 0 THEN '+' ELSE '' END || CASE WHEN round({v}, 1) = 0 THEN '0.0' ELSE replace(printf('%.1f', round({v}, 1)), '-', '{formats.MINUS}') END || '{formats.NBSP}p.p.'"


def _shade_sql() -> str:
    whens = []
    for k, bucket in enumerate("FAGU"):
        r, g, b = (c / 255 for c in colour.channels(colour.BUCKET_COLOURS[bucket]))
        high, low = max(r, g, b), min(r, g, b)
        spread, light = high - low, (high + low) / 2
        sat = 0.0 if not spread else spread / ((2 - high - low) if light > 0.5 else (high + low)) * 100
        hue = 0.0 if not spread else 60 * ((g - b) / spread + (6 if g < b else 0) if high == r else (b - r) / spread + 2 if high == g else (r - g) / spread + 4)
        sat = 0.0 if sat < 5 else min(max(sat, 30.0), 70.0)
        whens.append(f"WHEN {k} THEN 'hsl({int(hue + 0.5)}, {int(sat + 0.5)}%, '")
    return f"SELECT p_partkey, CASE p_partkey % 4 {' '.join(whens)} END || CAST(floor(26 + 44 * (p_partkey % 5) / 4e0 + 0.5) AS INT) || '%)' AS shade FROM part"


_M = "round(abs(value) * 100, 3)"
_END = f"CASE WHEN abs({_M} - round({_M})) < 1e-9 THEN printf('%.0f', {_M}) ELSE printf('%.1f', round({_M}, 1)) END"
_XY = "WITH p AS (SELECT c_custkey AS point_id, (c_custkey * 37 % 577) / 100e0 AS x, (c_custkey * 91 % 563) / 100e0 AS y FROM customer)"
_BOX = "WITH z AS (SELECT n_regionkey AS region, min(n_nationkey % 5) AS x0, min(n_nationkey // 5) AS y0, max(n_nationkey % 5) + 1e0 AS x1, max(n_nationkey // 5) + 1e0 AS y1 FROM nation GROUP BY 1)"

QUERIES = {
    "choropleth_fills": (choropleth_fills, even_sql(_fills_sql(), "zone", "", "dominant " + " ".join(f"{b}_{k}" for k in ("level", "change") for b in _ALL))),
    "zone_tips": (zone_tips, even_sql(_tips_sql(), "zone", "", "dominant " + " ".join(f"{b}_{k}" for b in _ALL for k in ("level", "change")))),
    "legend_labels": (legend_labels, even_sql(f"{_CG} --\nSELECT zone, '{formats.MINUS}' || {_END} AS low, '+' || {_END} AS high, '≤ {formats.MINUS}' || {_END} AS below, '≥ +' || {_END} AS above FROM lv", "zone", "", "low high below above")),
    "shade_colours": (shade_colours, even_sql(f"--\n{_shade_sql()}", "p_partkey", "", "shade")),
    "line_distances": (line_distances, even_sql(f"{_XY} --\nSELECT point_id, abs(5 * (0.5e0 - y) - (0 - x) * 2.5e0) / sqrt(25 + 6.25e0) AS line, sqrt((x - 1) * (x - 1) + (y - 1) * (y - 1)) AS point FROM p", "point_id", "line point", digits=6)),
    "significance_texts": (significance_texts, even_sql(f"{_S}, g AS (SELECT zone, class, {_TVALUE} AS tv FROM f WHERE k = {YEARS}), h AS (SELECT zone, class, {p_value_sql('tv', _DF)} AS p FROM g) --\nSELECT zone, class, CASE WHEN p IS NULL THEN 'unknown' WHEN p < 0.05e0 THEN 'significant' ELSE 'not significant' END AS kind, CASE WHEN round(p, 4) < 0.001e0 THEN '<0.001' WHEN p IS NOT NULL THEN printf('%.3f', round(round(p, 4), 3)) END AS text FROM h", "zone class", "", "kind text")),
    "template_texts": (template_texts, even_sql("--\nSELECT n_nationkey + 1 AS zone, n_name || ' is zone ' || (n_nationkey + 1) || ' of ' || n_name AS text FROM nation", "zone", "", "text")),
    "fixed_digits": (fixed_digits, even_sql("--\nSELECT o_custkey % 50 AS bin, printf('%.6f', o_custkey % 50 / 64e0) AS edge, printf('%.8f', count(*) / 7e0) AS share FROM orders GROUP BY 1, 2", "bin", "", "edge share")),
    "names_in_order": (names_in_order, even_sql("--\nSELECT n_nationkey + 1 AS zone, n_name AS name, row_number() OVER (ORDER BY n_name) AS place FROM nation", "zone place", "", "name")),
    "grid_shapes": (grid_shapes, even_sql(f"{_BOX}, s AS (SELECT *, ceil((x1 - x0) / {PIXEL}e0) AS width, ceil((y1 - y0) / {PIXEL}e0) AS height FROM z) --\nSELECT region, width, height, (x1 - x0) / width AS dx, (y1 - y0) / height AS dy FROM s", "region width height", "dx dy")),
}
