"""Zonal, reshape and lookup queries over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape, zonal
from ..session import written
from ..tables import BUCKET_NAMES, BUCKETS, CLASS_BUCKET, TYPES, cells, cells_sql
from .common import even, even_sql

CLASSES = list(range(1, len(TYPES) + 1))
STATS = "count(value) AS n, avg(value) AS mean, stddev_pop(value) AS std_pop, min(value) AS min, max(value) AS max"


def zonal_stats(spark, d):
    return even(zonal.zonal_stats(cells(spark, d)))


def zonal_merged(spark, d):
    """Statistics by blocks (one for each raster id), merged."""
    parts = zonal.zonal_partials(cells(spark, d), ("year", "zone", "class", "raster_id"))
    return even(zonal.merge_partials(parts), 6)


def zonal_matrix(spark, d):
    return even(zonal.zonal_matrix(zonal.zonal_stats(cells(spark, d)), CLASSES))


def zonal_masked_nodata(spark, d):
    return even(zonal.zonal_stats(cells(spark, d), ("zone", "class")))


def zonal_matrix_years(spark, d):
    """Cells by year as columns: the layer that later steps melt."""
    return even(zonal.valid_cells(cells(spark, d)).groupBy("zone").pivot("year", list(range(1995, 2002))).agg(F.avg("value")).withColumnsRenamed({str(y): f"y{y}" for y in range(1995, 2002)}))


def _lookup(spark):
    return spark.createDataFrame([(c, BUCKET_NAMES[b]) for c, b in CLASS_BUCKET.items() if b in BUCKET_NAMES], "class int, name string")


LOOKUP_SQL = "lookup(class, name) AS (VALUES " + ", ".join(f"({c}, '{BUCKET_NAMES[b]}')" for c, b in CLASS_BUCKET.items() if b in BUCKET_NAMES) + ")"


def melt_lookup_mean(spark, d):
    matrix = zonal.zonal_matrix(zonal.zonal_stats(cells(spark, d)), CLASSES)
    long = reshape.melt(matrix, ("year", "zone"), [f"c{c}" for c in CLASSES], "column", "value").withColumn("class", F.substr("column", F.lit(2)).cast("int"))
    return even(reshape.lookup_mean(long, _lookup(spark)))


def lookup_unmatched(spark, d):
    return even(reshape.unmatched(zonal.zonal_stats(cells(spark, d)), _lookup(spark)))


def multi_year_layer(spark, d):
    """Class means of all years, aligned by name, with the zones' names; odd years lack half of the classes. The statistics are made once."""
    stats = written(zonal.zonal_stats(cells(spark, d)), "zonal")
    years = {y: zonal.zonal_matrix(stats.filter(F.col("year") == y), CLASSES if y % 2 == 0 else CLASSES[:3], keys=("zone",)) for y in range(1995, 2002)}
    names = spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") + 1).cast("int").alias("zone"), F.col("n_name").alias("name"))
    return even(reshape.attach(names, reshape.by_year(years)))


def class_lookup_ids(spark, d):
    """Brands as class codes: those of small parts have ids; those that occur with size 1 to 10 are seen."""
    part = spark.read.parquet(f"{d}/part.parquet")
    existing = part.filter("p_size = 50").groupBy(F.col("p_brand").alias("code")).agg(F.min("p_size").alias("m")).select("code", (F.ascii(F.substr("code", F.lit(-1))) - 40).cast("int").alias("raster_id"))
    existing = existing.groupBy("raster_id").agg(F.min("code").alias("code")).select("code", "raster_id")
    return even(zonal.assign_ids(existing, part.filter("p_size <= 10").select(F.col("p_brand").alias("code"))))


def first_non_null(spark, d):
    """The first category name of each code in scan order."""
    part = spark.read.parquet(f"{d}/part.parquet").select("p_brand", F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("p_name"), "p_size", "p_partkey")
    return even(zonal.first_names(part, "p_brand", "p_name", "p_size", "p_partkey"))


def class_area_summary(spark, d):
    lookup = spark.createDataFrame([(c, t) for c, t in enumerate(TYPES, 1) if c != 6] + [(9, "NONE")], "class int, code string")
    return even(zonal.area_summary(cells(spark, d), lookup, 100.0))


def subcat_counts_grand_total(spark, d):
    counts = cells(spark, d).groupBy("zone", "bucket", "raster_id").agg(F.count("*").alias("n"))
    return even(zonal.subcategory_counts(counts))


def national_rollup(spark, d):
    stats = cells(spark, d).filter("value IS NOT NULL").groupBy("year", "zone", "bucket").agg(F.avg("value").alias("value"), F.sum("area").alias("area"))
    return even(zonal.national_rollup(stats, ("year", "bucket")))


def distinct_codes(spark, d):
    """Distinct codes of each type, and how many brands."""
    part = spark.read.parquet(f"{d}/part.parquet")
    return even(part.groupBy("p_type").agg(F.countDistinct("p_brand").alias("codes"), F.countDistinct("p_size").alias("sizes")))


def region_counts(spark, d):
    """Zones by region name, most first."""
    nation, region = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("nation", "region"))
    return even(nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).groupBy("r_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "r_name"))


def semi_anti_codes(spark, d):
    """Brands of large parts that small parts have too, and those that they don't."""
    part = spark.read.parquet(f"{d}/part.parquet")
    large, small = part.filter("p_size > 45").select("p_brand").distinct(), part.filter("p_size < 4").select("p_brand")
    both = reshape.in_scope(large, small, "p_brand").withColumn("known", F.lit(True))
    return even(both.union(reshape.without(large, small, "p_brand").withColumn("known", F.lit(False))))


_Z = f"WITH {cells_sql()}"
_STATS = f"{_Z}, zonal AS (SELECT year, zone, class, {STATS} FROM cells WHERE value IS NOT NULL GROUP BY year, zone, class)"
_MATRIX = f"{_STATS}, matrix AS (SELECT year, zone, " + ", ".join(f"max(CASE WHEN class = {c} THEN mean END) AS c{c}" for c in CLASSES) + " FROM zonal GROUP BY year, zone)"

QUERIES = {
    "zonal_stats": (zonal_stats, even_sql(f"{_STATS} --\nSELECT * FROM zonal", "year zone class n", "mean std_pop min max")),
    "zonal_merged": (zonal_merged, even_sql(f"{_STATS} --\nSELECT * FROM zonal", "year zone class n", "mean std_pop min max", digits=6)),
    "zonal_matrix": (zonal_matrix, even_sql(f"{_MATRIX} --\nSELECT * FROM matrix", "year zone", " ".join(f"c{c}" for c in CLASSES))),
    "zonal_masked_nodata": (zonal_masked_nodata, even_sql(f"{_Z} --\nSELECT zone, class, {STATS} FROM cells WHERE value IS NOT NULL GROUP BY zone, class", "zone class n", "mean std_pop min max")),
    "zonal_matrix_years": (zonal_matrix_years, even_sql(f"{_Z} --\nSELECT zone, " + ", ".join(f"avg(CASE WHEN year = {y} THEN value END) AS y{y}" for y in range(1995, 2002)) + " FROM cells WHERE value IS NOT NULL GROUP BY zone", "zone", " ".join(f"y{y}" for y in range(1995, 2002)))),
    "melt_lookup_mean": (melt_lookup_mean, even_sql(f"{_STATS}, {LOOKUP_SQL} --\nSELECT year, zone, name, avg(mean) AS value FROM zonal JOIN lookup USING (class) GROUP BY year, zone, name UNION ALL SELECT year, zone, name, NULL FROM (SELECT DISTINCT year, zone, name FROM zonal, (SELECT DISTINCT name FROM lookup)) a WHERE NOT EXISTS (SELECT 1 FROM zonal z JOIN lookup l USING (class) WHERE z.year = a.year AND z.zone = a.zone AND l.name = a.name)", "year zone", "value", "name")),
    "lookup_unmatched": (lookup_unmatched, even_sql(f"{_STATS}, {LOOKUP_SQL} --\nSELECT class, count(*) AS n FROM zonal WHERE class NOT IN (SELECT class FROM lookup) GROUP BY class", "class n")),
    "multi_year_layer": (
        multi_year_layer,
        even_sql(f"{_MATRIX} --\nSELECT zone, n_name AS name, year, c1, c2, c3, CASE WHEN year % 2 = 0 THEN c4 END AS c4, CASE WHEN year % 2 = 0 THEN c5 END AS c5, CASE WHEN year % 2 = 0 THEN c6 END AS c6 FROM matrix JOIN nation ON zone = n_nationkey + 1", "zone year", "c1 c2 c3 c4 c5 c6", "name"),
    ),
    "class_lookup_ids": (
        class_lookup_ids,
        even_sql(
            """WITH e0 AS (SELECT DISTINCT p_brand AS code, ascii(right(p_brand, 1)) - 40 AS raster_id FROM part WHERE p_size = 50), existing AS (SELECT min(code) AS code, raster_id FROM e0 GROUP BY raster_id),
            seen AS (SELECT DISTINCT p_brand AS code FROM part WHERE p_size <= 10), fresh AS (SELECT code FROM seen WHERE code NOT IN (SELECT code FROM existing)) --
            SELECT code, raster_id FROM existing WHERE code IN (SELECT code FROM seen) UNION ALL SELECT code, row_number() OVER (ORDER BY code) + (SELECT coalesce(max(raster_id), 0) FROM existing) FROM fresh""".replace("--\n            ", "--\n"),
            "raster_id", "", "code",
        ),
    ),
    "first_non_null": (first_non_null, "SELECT p_brand, arg_min(p_name, CAST(p_size AS BIGINT) * 1000000000 + p_partkey) AS p_name FROM part WHERE p_partkey % 3 <> 0 AND p_name IS NOT NULL GROUP BY p_brand"),
    "class_area_summary": (
        class_area_summary,
        even_sql(f"{_Z}, lookup(class, code) AS (VALUES {', '.join(f'({c}, {t!r})' for c, t in enumerate(TYPES, 1) if c != 6)}, (9, 'NONE')) --\nSELECT class, code, polygon_count, area_m2, area_m2 / 10000e0 AS area_ha, area_m2 / 1000000e0 AS area_km2 FROM (SELECT class, code, count(*) AS polygon_count, sum(area) * 100e0 AS area_m2 FROM lookup JOIN cells USING (class) GROUP BY class, code)", "class polygon_count", "area_m2 area_ha area_km2", "code"),
    ),
    "subcat_counts_grand_total": (subcat_counts_grand_total, even_sql(f"{_Z} --\nSELECT CASE WHEN grouping(zone) = 1 THEN 'NATIONAL' ELSE CAST(zone AS VARCHAR) END AS zone, bucket, raster_id, count(*) AS count FROM cells WHERE bucket IN ('F', 'A', 'G', 'U') GROUP BY GROUPING SETS ((zone, bucket, raster_id), (bucket, raster_id))", "raster_id count", "", "zone bucket")),
    "national_rollup": (national_rollup, even_sql(f"{_Z}, v AS (SELECT year, zone, bucket, avg(value) AS value, sum(area) AS area FROM cells WHERE value IS NOT NULL GROUP BY year, zone, bucket) --\nSELECT year, bucket, sum(value * area) / sum(area) AS value, sum(area) AS area FROM v GROUP BY year, bucket", "year", "value area", "bucket")),
    "distinct_codes": (distinct_codes, even_sql("SELECT p_type, count(DISTINCT p_brand) AS codes, count(DISTINCT p_size) AS sizes FROM part GROUP BY p_type", "codes sizes", "", "p_type")),
    "region_counts": (region_counts, even_sql("SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name", "n", "", "r_name")),
    "semi_anti_codes": (semi_anti_codes, "SELECT DISTINCT p_brand, p_brand IN (SELECT p_brand FROM part WHERE p_size < 4) AS known FROM part WHERE p_size > 45"),
}

__all__ = ["BUCKETS", "QUERIES"]
