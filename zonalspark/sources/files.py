"""Files as tables: names and years of a folder, CSV, GeoJSON, and shapefiles (in ``shapefiles``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import duplicate_keys

_COORDINATES = {"Polygon": "array<array<array<double>>>", "MultiPolygon": "array<array<array<array<double>>>>"}


def listing(spark: SparkSession, folder: str, pattern: str = "*", limit: int | None = None) -> DataFrame:
    """(path, length) of the files of a folder in the order of their names; limit for dry runs."""
    out = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length").orderBy("path")
    return out.limit(limit) if limit else out


def year_of(path: Column, pattern: str = r"(\d{4})") -> Column:
    """The first year in a file's name, null without one."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("int")


def one_shapefile(members: list[str]) -> str:
    """The only .shp of an archive, not counting copies that some systems add."""
    found = [m for m in members if m.lower().endswith(".shp") and "__MACOSX" not in m and not m.rsplit("/", 1)[-1].startswith("._")]
    if not found:
        raise FileNotFoundError("no .shp in the archive")
    if len(found) > 1:
        raise ValueError(f"several .shp in the archive: {found}")
    return found[0]


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; without a schema every column is text."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def yearly_csv(spark: SparkSession, folder: str, schema: str, pattern: str = "*.csv") -> DataFrame:
    """All CSV files of a folder with the year of each file's name; files without a year are left out.

    Two files of one year are an error: the listing is checked before anything is read.
    """
    years = listing(spark, folder, pattern).withColumn("year", year_of(F.col("path"))).filter("year IS NOT NULL")
    if twice := [r["year"] for r in duplicate_keys(years, "year").collect()]:
        raise ValueError(f"several files of the years {sorted(twice)}")
    out = spark.read.option("header", True).option("pathGlobFilter", pattern).schema(schema).csv(folder)
    return out.withColumn("year", year_of(F.col("_metadata.file_path"))).filter("year IS NOT NULL")


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features with the named properties (DDL) and polygons; both polygon kinds become array<array<ring>>.

    Without a use of polygons the geometry is not parsed: Spark prunes it.
    """
    whole = spark.read.option("multiLine", True).schema(f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>").json(path)
    out = whole.select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    single = F.array(F.from_json("text", _COORDINATES["Polygon"]))
    many = F.when(F.col("kind") == "Polygon", single).otherwise(F.from_json("text", _COORDINATES["MultiPolygon"]))
    points = F.transform(many, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))))
    return out.withColumn("polygons", points).drop("kind", "text")


def read_shapefiles(spark: SparkSession, folder: str, names: list[str], pattern: str = "*.zip", geometry: bool = True, **options) -> DataFrame:
    """(file, recno, names..., rings) of polygon shapefiles: see ``shapefiles``."""
    from . import shapefiles

    return shapefiles.read_shapefiles(spark, folder, names, pattern, geometry, **options)
