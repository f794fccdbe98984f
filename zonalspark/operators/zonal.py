"""Zonal statistics: value cells by zone and class, the matrix, areas and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import valid
from .reshape import unique


def valid_cells(cells: DataFrame, nodata: float | None = None) -> DataFrame:
    """Cells of a zone and a class with a finite value; the filter reaches the scan."""
    out = cells.filter("zone > 0 AND class > 0")
    return out.withColumn("value", valid(F.col("value"), nodata)).filter("value IS NOT NULL")


def zonal_stats(cells: DataFrame, keys: tuple[str, ...] = ("year", "zone", "class")) -> DataFrame:
    """Count, mean, population standard deviation, minimum and maximum by the keys."""
    return valid_cells(cells).groupBy(*keys).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std_pop"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def zonal_partials(cells: DataFrame, keys: tuple[str, ...] = ("year", "zone", "class")) -> DataFrame:
    """Mergeable parts: count, mean, sum of squared distances from it, minimum, maximum."""
    v = F.col("value")
    return valid_cells(cells).groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("m"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("min"), F.max(v).alias("max"))


def merge_partials(partials: DataFrame, keys: tuple[str, ...] = ("year", "zone", "class")) -> DataFrame:
    """Statistics from the parts of any number of blocks.

    Squared distances move to the whole mean part by part: nothing large is subtracted from something large.
    """
    from pyspark.sql.window import Window

    by = Window.partitionBy(*keys)
    moved = partials.withColumn("mean", F.sum(F.col("n") * F.col("m")).over(by) / F.sum("n").over(by))
    m2 = F.sum(F.col("m2") + F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean")))
    out = moved.groupBy(*keys).agg(F.sum("n").alias("n"), F.first("mean").alias("mean"), m2.alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"))
    return out.select(*keys, "n", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std_pop"), "min", "max")


def zonal_matrix(zonal: DataFrame, classes: list[int], value: str = "mean", keys: tuple[str, ...] = ("year", "zone")) -> DataFrame:
    """One row per zone, one column per class (c1, c2, ...); the classes are given, so no extra job finds them.

    A zone and class that comes twice is an error: its rows are counted where they meet, in the pivot.
    """
    wide = zonal.groupBy(*keys).pivot("class", classes).agg(F.first(value).alias("v"), F.count(F.lit(1)).alias("n"))
    twice = lambda c: F.concat(F.lit(f"a zone's class comes twice: class {c} of "), F.to_json(F.struct(*keys)))
    return wide.select(*keys, *(F.when(F.assert_true(F.coalesce(f"{c}_n", F.lit(0)) <= 1, twice(c)).isNull(), F.col(f"{c}_v")).alias(f"c{c}") for c in classes))


def area_summary(cells: DataFrame, lookup: DataFrame, unit: float = 1.0) -> DataFrame:
    """Polygons and area by class, for the classes of the lookup: in all and in hectares and square kilometres."""
    sums = cells.groupBy("class").agg(F.count("*").alias("polygon_count"), F.sum("area").alias("area"))
    out = lookup.join(sums, "class").withColumn("area_m2", F.coalesce("area", F.lit(0.0)) * unit).drop("area")
    return out.withColumn("area_ha", F.col("area_m2") / 10_000).withColumn("area_km2", F.col("area_m2") / 1_000_000)


def subcategory_counts(counts: DataFrame, national: str = "NATIONAL") -> DataFrame:
    """Cells by (zone, bucket, raster_id), and the same over all zones as zone NATIONAL.

    counts: (zone, bucket, raster_id, n); rows without a counted bucket are left out.
    """
    kept = counts.filter(F.col("bucket").isin("F", "A", "G", "U"))
    both = kept.select("zone", "bucket", "raster_id", "n").groupingSets([[F.col("zone"), F.col("bucket"), F.col("raster_id")], [F.col("bucket"), F.col("raster_id")]], "zone", "bucket", "raster_id").agg(F.sum("n").alias("count"), F.grouping("zone").alias("whole"))
    return both.select(F.when(F.col("whole") == 1, national).otherwise(F.col("zone").cast("string")).alias("zone"), "bucket", "raster_id", "count")


def national_rollup(zone_values: DataFrame, keys: tuple[str, ...], value: str = "value", weight: str = "area") -> DataFrame:
    """Area-weighted mean over all zones; null values and their areas are left out."""
    known = F.col(value).isNotNull() & F.col(weight).isNotNull()
    w = F.when(known, F.col(weight))
    return zone_values.groupBy(*keys).agg((F.sum(F.col(value) * w) / F.nullif(F.sum(w), F.lit(0.0))).alias(value), F.sum(w).alias(weight))


def assign_ids(existing: DataFrame, seen: DataFrame, code: str = "code", number: str = "raster_id") -> DataFrame:
    """Ids of the codes seen: existing ids stay; new codes, in order, get the next ones; at most 255.

    The codes are a lookup's few hundred rows, so one partition orders them.
    """
    from pyspark.sql.window import Window

    codes = seen.select(code).distinct()
    known = existing.join(codes, code, "left_semi").select(code, number)
    top = existing.agg(F.coalesce(F.max(number), F.lit(0)).alias("top"))
    new = codes.join(existing, code, "left_anti").crossJoin(F.broadcast(top))
    new = new.select(code, (F.row_number().over(Window.orderBy(code)) + F.col("top")).cast("int").alias(number))
    out = known.union(new)
    return out.withColumn(number, F.when(F.assert_true(F.col(number).between(1, 255), F.lit("raster_id outside 1..255")).isNull(), F.col(number)))


def first_names(names: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """The first non-null value of each key in scan order."""
    return names.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))
