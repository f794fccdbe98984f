"""Comparison queries over zone-years: medians, ranks, boards, shares and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formats
from ..operators import compare, order, regress, reshape
from ..tables import BUCKETS, GRID_SQL, cells, cells_sql, grid
from .common import even, even_sql

FIRST, LAST = 1995, 2001


def _zone_years(spark, d):
    return compare.zone_years(cells(spark, d))


def _level(spark, d):
    """(zone, region, value) of the composite in the last year."""
    return _zone_years(spark, d).filter(f"bucket = 'I' AND year = {LAST}").select("zone", "region", "value")


def _change(spark, d):
    return compare.delta(_zone_years(spark, d), FIRST, LAST).withColumnRenamed("delta", "value")


def _names(spark, d):
    return spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") + 1).cast("int").alias("zone"), F.col("n_name").alias("name"))


def _zones(spark, d):
    """(zone, name, region)."""
    return spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") + 1).cast("int").alias("zone"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 1).alias("region"))


def composite_index(spark, d):
    return even(_zone_years(spark, d).filter("bucket = 'I'").select("zone", "year", "value"))


def bucket_shares(spark, d):
    return even(_zone_years(spark, d).filter("bucket <> 'I'").select("zone", "year", "bucket", "value", "share"))


def indicator_mean(spark, d):
    """The grid and the grid moved by 20 and by 40 columns as three layers; cells below -0.2 are nodata."""
    layers = [grid(spark, d).select("row", ((F.col("col") + 20 * k) % 64).alias("col"), F.when(F.col("value") >= -0.2, F.col("value")).alias("value")) for k in range(3)]
    return even(compare.composite_indicator(*layers))


def contribution_untapped(spark, d):
    return even(compare.contribution(_zone_years(spark, d)))


def dominant_class(spark, d):
    return even(compare.dominant(_zone_years(spark, d)))


def empty_years(spark, d):
    """A zone's year is empty if all of its values are null; every third zone loses 1997."""
    gone = (F.col("zone") % 3 == 0) & (F.col("year") == 1997)
    return even(compare.empty_years(_zone_years(spark, d).withColumn("value", F.when(~gone, F.col("value")))))


def delta(spark, d):
    return even(compare.delta(_zone_years(spark, d), FIRST, LAST))


def yoy(spark, d):
    return even(compare.year_over_year(_zone_years(spark, d)))


def region_median_excl_self(spark, d):
    return even(compare.region_median_of_others(_level(spark, d)))


def region_comparison(spark, d):
    """Difference from the median of the region's other zones, and how it reads."""
    out = compare.region_median_of_others(_level(spark, d)).withColumn("diff", F.col("value") - F.col("median_others"))
    return even(out.select("zone", "diff", formats.comparison(F.col("diff")).alias("text")), 6)


def _neighbours(spark):
    return spark.range(1, 26).select(F.col("id").cast("int").alias("zone"), F.explode(F.array((F.col("id") - 1).cast("int"), (F.col("id") + 1).cast("int"))).alias("neighbor")).filter("neighbor BETWEEN 1 AND 25")


def neighbor_median(spark, d):
    return even(compare.neighbour_median(_level(spark, d), _neighbours(spark)))


def national_median(spark, d):
    return even(compare.median_by(_zone_years(spark, d), "year", "bucket"))


def region_median(spark, d):
    return even(compare.median_by(_zone_years(spark, d), "region", "year", "bucket"))


def region_ranking(spark, d):
    return even(compare.region_ranking(_level(spark, d)))


def rank_region_nation(spark, d):
    return even(compare.ranks(_level(spark, d)))


def rank_cells(spark, d):
    """Every cell with a value in the order of values and keys, over all rows: its rank by value, and the number of values up to it."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = order.ranked(lines, F.desc("l_extendedprice"))
    return even(out.select("l_orderkey", "l_linenumber", "rank", "dense", "total"))


def leaderboard_level(spark, d):
    return even(compare.leaderboard(_level(spark, d)))


def leaderboard_change(spark, d):
    return even(compare.leaderboard(_change(spark, d)))


def leaderboard_region(spark, d):
    return even(compare.leaderboard(_level(spark, d), region=2))


def leaderboard_titles(spark, d):
    return compare.leaderboard_titles(compare.leaderboard(_change(spark, d)), "value")


def top6_other(spark, d):
    counts = cells(spark, d).groupBy("zone", "bucket", "raster_id").agg(F.count("*").alias("n"))
    return even(compare.top_and_other(counts))


def bucket_domain(spark, d):
    return even(compare.bucket_domains(_zone_years(spark, d)))


def change_range_m(spark, d):
    return even(compare.change_range(_zone_years(spark, d)))


def axis_bounds(spark, d):
    return even(compare.axis_bounds(_zone_years(spark, d), "value", "zone"))


def region_peers(spark, d):
    return even(reshape.peers(_level(spark, d).select("zone", "region")))


def zone_search(spark, d):
    """A zone by its name; a text that is no zone's name finds the region's zones."""
    nation, region = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "region"))
    zones = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_nationkey").alias("zone"), F.col("n_name").alias("name"), F.col("r_name").alias("region_name"))
    region_name = "EUROPE"
    found = reshape.find_zone(zones, region_name).withColumn("asked", F.lit("region"))
    one = zones.filter("zone = 7").select("name")
    exact = zones.join(one, "name", "left_semi").withColumn("asked", F.lit("zone"))
    return even(found.unionByName(exact))


def duplicate_years(spark, d):
    """Keys that come more than once: here, order days with several orders of one customer."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return even(reshape.duplicate_keys(orders, "o_custkey", "o_orderdate").groupBy("n").agg(F.count("*").alias("days")))


def value_texts(spark, d):
    """How levels, changes and slopes read."""
    out = _change(spark, d)
    return out.select(F.col("zone").cast("bigint"), formats.rounded_sign(F.col("value")).cast("bigint").alias("sign"), formats.arrow(F.col("value"), 0.005).alias("arrow"))


def export_levels(spark, d):
    return even(compare.export_levels(_zone_years(spark, d), _zones(spark, d)), 2)


def export_change(spark, d):
    return even(compare.export_change(_zone_years(spark, d), _zones(spark, d), FIRST, LAST), 2)


def export_trend(spark, d):
    slopes = regress.ols(_zone_years(spark, d), ("zone", "bucket")).select("zone", "bucket", "slope")
    return even(compare.export_trend(slopes, _zones(spark, d)), 3)


_IN = "('F', 'A', 'G', 'U')"
_ZY = f"""WITH {cells_sql()}, c1 AS (SELECT zone, region, year, bucket, sum(value * area) / sum(area) AS value, sum(area) AS area FROM cells WHERE bucket IN {_IN} AND value IS NOT NULL GROUP BY zone, region, year, bucket),
 c2 AS (SELECT *, area / sum(area) OVER (PARTITION BY zone, year) AS share FROM c1),
 zy AS (SELECT zone, region, year, bucket, value, share FROM c2 UNION ALL SELECT zone, region, year, 'I', sum(value * share), NULL FROM c2 GROUP BY zone, region, year)"""
_LV = f"{_ZY}, lv AS (SELECT zone, region, value FROM zy WHERE bucket = 'I' AND year = {LAST})"
_CG = f"{_ZY}, lv AS (SELECT zone, any_value(region) AS region, max(CASE WHEN year = {LAST} THEN value END) - max(CASE WHEN year = {FIRST} THEN value END) AS value FROM zy WHERE bucket = 'I' AND year IN ({FIRST}, {LAST}) GROUP BY zone)"
_MO = f"{_LV}, mo AS (SELECT a.zone, any_value(a.region) AS region, any_value(a.value) AS value, median(b.value) AS median_others FROM lv a LEFT JOIN lv b ON a.region = b.region AND a.zone <> b.zone GROUP BY a.zone)"
_BOARD = ", n AS (SELECT count(*) AS n FROM lv WHERE value IS NOT NULL), board AS (SELECT 'worst' AS side, row_number() OVER (ORDER BY value, zone) AS place, zone, value FROM lv WHERE value IS NOT NULL UNION ALL SELECT 'best', row_number() OVER (ORDER BY value DESC, zone DESC), zone, value FROM lv WHERE value IS NOT NULL), top AS (SELECT board.* FROM board, n WHERE place <= least(5, n // 2))"
_LAYERS = "l AS (SELECT row, (col + k) % 64 AS c, CASE WHEN value >= -0.2e0 THEN value END AS v FROM grid, (VALUES (0), (20), (40)) AS m(k))"
_WIDE = ", ".join(f"max(CASE WHEN bucket = '{b}' THEN value END) AS {b}" for b in ("I", *BUCKETS))
_ALL = ("I", *BUCKETS)

QUERIES = {
    "composite_index": (composite_index, even_sql(f"{_ZY} --\nSELECT * FROM zy WHERE bucket = 'I'", "zone year", "value")),
    "bucket_shares": (bucket_shares, even_sql(f"{_ZY} --\nSELECT * FROM zy WHERE bucket <> 'I'", "zone year", "value share", "bucket")),
    "indicator_mean": (indicator_mean, even_sql(f"WITH {GRID_SQL}, {_LAYERS} --\nSELECT row, c AS col, CASE WHEN count(v) = 3 THEN sum(v) / 3 END AS value FROM l GROUP BY row, c HAVING count(*) = 3", "row col", "value")),
    "contribution_untapped": (contribution_untapped, even_sql(f"{_ZY}, k AS (SELECT zone, year, sum(value * share) AS contribution FROM zy WHERE bucket <> 'I' GROUP BY zone, year) --\nSELECT *, greatest(1 - contribution, 0e0) AS untapped FROM k", "zone year", "contribution untapped")),
    "dominant_class": (dominant_class, even_sql(f"{_ZY}, o AS (SELECT *, row_number() OVER (PARTITION BY zone, year ORDER BY share DESC, strpos('FAGU', bucket)) AS rn FROM zy WHERE bucket <> 'I' AND share IS NOT NULL) --\nSELECT zone, year, bucket AS dominant FROM o WHERE rn = 1", "zone year", "", "dominant")),
    "empty_years": (empty_years, even_sql(f"{_ZY} --\nSELECT zone, year, bool_and(zone % 3 = 0 AND year = 1997) AS empty FROM zy GROUP BY zone, year", "zone year", "", "empty")),
    "delta": (delta, even_sql(f"{_CG} --\nSELECT zone, region, value AS delta FROM lv", "zone region", "delta")),
    "yoy": (yoy, even_sql(f"{_ZY} --\nSELECT zone, bucket, year, value, value - lag(value) OVER (PARTITION BY zone, bucket ORDER BY year) AS yoy FROM zy", "zone year", "value yoy", "bucket")),
    "region_median_excl_self": (region_median_excl_self, even_sql(f"{_MO} --\nSELECT * FROM mo", "zone region", "value median_others")),
    "region_comparison": (region_comparison, even_sql(f"{_MO} --\nSELECT zone, value - median_others AS diff, CASE WHEN round((value - median_others) * 100, 1) > 0 THEN 'above' WHEN round((value - median_others) * 100, 1) < 0 THEN 'below' WHEN median_others IS NOT NULL THEN 'same' END AS text FROM mo", "zone", "diff", "text", digits=6)),
    "neighbor_median": (neighbor_median, even_sql(f"{_LV} --\nSELECT a.z AS zone, median(value) AS neighbor_median FROM (SELECT unnest(range(1, 26)) AS z) a JOIN lv ON abs(lv.zone - a.z) = 1 GROUP BY a.z", "zone", "neighbor_median")),
    "national_median": (national_median, even_sql(f"{_ZY} --\nSELECT year, bucket, median(value) AS median, count(value) AS n FROM zy GROUP BY year, bucket", "year n", "median", "bucket")),
    "region_median": (region_median, even_sql(f"{_ZY} --\nSELECT region, year, bucket, median(value) AS median, count(value) AS n FROM zy GROUP BY region, year, bucket", "region year n", "median", "bucket")),
    "region_ranking": (region_ranking, even_sql(f"{_LV}, m AS (SELECT region, median(value) AS median FROM lv GROUP BY region) --\nSELECT region, median, rank() OVER (ORDER BY median DESC) AS rank, greatest(4, floor(abs(median) / max(abs(median)) OVER () * 100 + 0.5e0)) AS bar FROM m", "region rank bar", "median")),
    "rank_region_nation": (rank_region_nation, even_sql(f"{_LV} --\nSELECT zone, region, value, rank() OVER (PARTITION BY region ORDER BY value DESC) AS region_rank, count(*) OVER (PARTITION BY region) AS region_n, rank() OVER (ORDER BY value DESC) AS nation_rank, count(*) OVER () AS nation_n FROM lv WHERE value IS NOT NULL", "zone region region_rank region_n nation_rank nation_n", "value")),
    "rank_cells": (rank_cells, even_sql("--\nSELECT l_orderkey, l_linenumber, rank() OVER w AS rank, dense_rank() OVER w AS dense, count(*) OVER () AS total FROM lineitem WINDOW w AS (ORDER BY l_extendedprice DESC)", "l_orderkey l_linenumber rank dense total")),
    "leaderboard_level": (leaderboard_level, even_sql(f"{_LV}{_BOARD} --\nSELECT * FROM top", "place zone", "value", "side")),
    "leaderboard_change": (leaderboard_change, even_sql(f"{_CG}{_BOARD} --\nSELECT * FROM top", "place zone", "value", "side")),
    "leaderboard_region": (leaderboard_region, even_sql(f"{_ZY}, lv AS (SELECT zone, region, value FROM zy WHERE bucket = 'I' AND year = {LAST} AND region = 2){_BOARD} --\nSELECT * FROM top", "place zone", "value", "side")),
    "leaderboard_titles": (leaderboard_titles, f"{_CG}{_BOARD} SELECT CASE WHEN max(CASE WHEN side = 'best' THEN sign(round(value * 100, 1)) END) > 0 THEN 'largest increase' ELSE 'smallest decrease' END AS best_title, CASE WHEN min(CASE WHEN side = 'worst' THEN sign(round(value * 100, 1)) END) > 0 THEN 'smallest increase' ELSE 'largest decrease' END AS worst_title FROM top"),
    "top6_other": (top6_other, even_sql(f"WITH {cells_sql()}, k AS (SELECT zone, bucket, raster_id, count(*) AS n FROM cells GROUP BY zone, bucket, raster_id), r AS (SELECT *, row_number() OVER (PARTITION BY zone, bucket ORDER BY n DESC, raster_id) AS rn FROM k) --\nSELECT zone, bucket, CASE WHEN rn <= 6 THEN CAST(raster_id AS VARCHAR) ELSE 'Other' END AS item, sum(n) AS n FROM r GROUP BY 1, 2, 3", "zone n", "", "bucket item")),
    "bucket_domain": (bucket_domain, even_sql(f"{_ZY}, e AS (SELECT bucket, min(value) AS a, max(value) AS b FROM zy GROUP BY bucket) --\nSELECT bucket, CASE WHEN b > a THEN greatest(a - (b - a) * 0.08e0, 0e0) ELSE 0e0 END AS low, CASE WHEN b > a THEN least(b + (b - a) * 0.08e0, 1e0) ELSE 1e0 END AS high FROM e", "", "low high", "bucket")),
    "change_range_m": (change_range_m, even_sql(f"{_ZY}, e AS (SELECT zone, bucket, max(value) - min(value) AS s FROM zy GROUP BY zone, bucket) --\nSELECT bucket, greatest(ceil(round(max(s) / 0.05e0, 9)) * 0.05e0, 0.05e0) AS m FROM e GROUP BY bucket", "", "m", "bucket")),
    "axis_bounds": (axis_bounds, even_sql(f"{_ZY}, e AS (SELECT zone, max(value) * 100 AS b, min(value) * 100 AS a FROM zy GROUP BY zone) --\nSELECT zone, CASE WHEN b > 0 THEN ceil(round(b * 1.15e0 / 5, 9)) * 5 ELSE 10 END AS top, greatest(floor(round(a * 0.85e0 / 5, 9)) * 5, 0) AS bottom FROM e", "zone", "top bottom")),
    "region_peers": (region_peers, even_sql(f"{_LV} --\nSELECT a.zone, b.zone AS peer FROM lv a JOIN lv b ON a.region = b.region AND a.zone <> b.zone", "zone peer")),
    "zone_search": (zone_search, even_sql("WITH z AS (SELECT n_nationkey AS zone, n_name AS name, r_name AS region_name FROM nation JOIN region ON n_regionkey = r_regionkey) --\nSELECT *, 'region' AS asked FROM z WHERE region_name = 'EUROPE' UNION ALL SELECT *, 'zone' FROM z WHERE name = (SELECT name FROM z WHERE zone = 7)", "zone", "", "name region_name asked")),
    "duplicate_years": (duplicate_years, even_sql("SELECT n, count(*) AS days FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1) GROUP BY n", "n days")),
    "value_texts": (value_texts, even_sql(f"{_CG} --\nSELECT zone, sign(round(value * 100, 1)) AS sign, CASE WHEN value > 0.005e0 THEN 'up' WHEN value < -0.005e0 THEN 'down' ELSE 'flat' END AS arrow FROM lv", "zone sign", "", "arrow")),
    "export_levels": (export_levels, even_sql(f"{_ZY}, w AS (SELECT zone, year, {_WIDE} FROM zy GROUP BY zone, year), ys AS (SELECT DISTINCT year FROM zy) --\nSELECT n_nationkey + 1 AS zone, n_name AS name, n_regionkey + 1 AS region, ys.year, " + ", ".join(f"{b} * 100 AS {b}_pct" for b in _ALL) + " FROM nation CROSS JOIN ys LEFT JOIN w ON w.zone = n_nationkey + 1 AND w.year = ys.year", "zone region year", " ".join(f"{b}_pct" for b in _ALL), "name", digits=2)),
    "export_change": (export_change, even_sql(f"{_ZY}, w AS (SELECT zone, " + ", ".join(f"max(CASE WHEN bucket = '{b}' AND year = {LAST} THEN value END) - max(CASE WHEN bucket = '{b}' AND year = {FIRST} THEN value END) AS {b}" for b in _ALL) + f" FROM zy GROUP BY zone) --\nSELECT n_nationkey + 1 AS zone, n_name AS name, n_regionkey + 1 AS region, {FIRST} AS from_year, {LAST} AS to_year, " + ", ".join(f"{b} * 100 AS {b}_change_pp" for b in _ALL) + " FROM nation LEFT JOIN w ON zone = n_nationkey + 1", "zone region from_year to_year", " ".join(f"{b}_change_pp" for b in _ALL), "name", digits=2)),
    "export_trend": (export_trend, even_sql(f"{_ZY}, s AS (SELECT zone, bucket, regr_slope(value, year - 2000e0) AS m FROM zy GROUP BY zone, bucket HAVING count(value) >= 4), w AS (SELECT zone, " + ", ".join(f"max(CASE WHEN bucket = '{b}' THEN m END) AS {b}" for b in _ALL) + " FROM s GROUP BY zone) --\nSELECT n_nationkey + 1 AS zone, n_name AS name, n_regionkey + 1 AS region, " + ", ".join(f"{b} * 100 AS {b}_slope_pp_per_year" for b in _ALL) + " FROM nation LEFT JOIN w ON zone = n_nationkey + 1", "zone region", " ".join(f"{b}_slope_pp_per_year" for b in _ALL), "name", digits=3)),
}
