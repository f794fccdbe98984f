"""Reshape, lookup and membership operators of the multi-year layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(matrix: DataFrame, ids: tuple[str, ...], columns: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return matrix.unpivot(list(ids), columns, name, value)


def lookup_mean(long: DataFrame, lookup: DataFrame, key: str = "class", keys: tuple[str, ...] = ("year", "zone"), name: str = "name", value: str = "value") -> DataFrame:
    """Mean by zone and class name, unweighted over the raster ids, nulls left out; ids without a name fall out."""
    return long.join(lookup.dropDuplicates([key, name]), key, "left").filter(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.avg(value).alias(value))


def unmatched(long: DataFrame, lookup: DataFrame, key: str = "class") -> DataFrame:
    """Keys without a lookup row, and how many rows have them."""
    return long.join(lookup, key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))


def by_year(layers: dict[int, DataFrame], column: str = "year") -> DataFrame:
    """One frame of all years, columns aligned by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(column, F.lit(y)) for y, df in layers.items()])


def attach(geometry: DataFrame, attributes: DataFrame, key: str = "zone") -> DataFrame:
    """Attributes (many) with their geometry (one); zones without either vanish."""
    return attributes.join(geometry, key)


def peers(regions: DataFrame) -> DataFrame:
    """(zone, peer) in one region, without the zone itself; of (zone, region)."""
    other = regions.select(F.col("zone").alias("peer"), "region")
    return regions.join(other, "region").filter("zone <> peer").select("zone", "peer")


def in_scope(df: DataFrame, scope: DataFrame, key: str = "zone") -> DataFrame:
    return df.join(scope, key, "left_semi")


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other, key, "left_anti")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that come more than once, such as a year with two files."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def unique(df: DataFrame, *keys: str, what: str = "key") -> DataFrame:
    """df; running it fails if a key comes twice. The keys are counted where the rows are: one aggregate, no join."""
    once = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(*df.columns)).alias("__row"))
    checked = once.filter(F.assert_true(F.col("__n") == 1, F.concat(F.lit(f"{what} comes twice: "), F.to_json(F.struct(*keys)))).isNull())
    return checked.select("__row.*")


def find_zone(zones: DataFrame, text: str, name: str = "name", region: str = "region_name") -> DataFrame:
    """Zones of exactly that name; if there are none, those of the region of that name."""
    same = zones.filter(F.col(name) == text)
    found = same.agg(F.count("*").alias("found"))
    return same.union(zones.filter(F.col(region) == text).crossJoin(F.broadcast(found)).filter("found = 0").drop("found"))
