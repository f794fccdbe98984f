"""Results as files: CSV, fixed-precision CSV, download CSV, GeoJSON, JSON, tiles, and a page from a template."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import formats

BOM = "﻿"


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def fixed(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """The named columns as text with so many digits; the others stay."""
    return df.select(*(F.format_string(f"%.{digits[c]}f", F.col(c).cast("double")).alias(c) if c in digits else F.col(c) for c in df.columns))


def _field(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\n\r]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def line(df: DataFrame) -> Column:
    """A row as text: quotes only around fields with a quote, comma or line end."""
    return F.concat_ws(",", *(_field(F.col(c)) for c in df.columns))


def write_download(df: DataFrame, path: str, order: list[str], mode: str = "error") -> None:
    """One file with a byte order mark, a header and CRLF line ends: a report of zones and years, by their order."""
    lines = df.select(F.lit(1).alias("__row"), *(F.col(c).alias(f"__{c}") for c in order), line(df).alias("line"))
    head = df.sparkSession.range(1).select(F.lit(0).alias("__row"), F.lit(BOM + ",".join(df.columns)).alias("line"))
    whole = head.unionByName(lines, allowMissingColumns=True).coalesce(1).sortWithinPartitions("__row", *(f"__{c}" for c in order))
    whole.select("line").write.mode(mode).option("lineSep", "\r\n").text(path)


def features(df: DataFrame, polygons: str = "polygons") -> DataFrame:
    """(value): one GeoJSON feature for each row; all other columns are properties."""
    points = F.transform(polygons, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), points.alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(c for c in df.columns if c != polygons)).alias("properties"), shape.alias("geometry"))).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, polygons: str = "polygons", mode: str = "error") -> None:
    """A feature in each line, in as many files as there are partitions."""
    features(df, polygons).write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_tiles(tiles: DataFrame, path: str, by: tuple[str, ...] = ("year",), mode: str = "error") -> None:
    """Tile table as zstandard Parquet, in folders by year, so that a year's scan reads its folder only."""
    tiles.write.mode(mode).partitionBy(*by).option("compression", "zstd").parquet(path)


def write_once(df: DataFrame, path: str, force: bool = False) -> None:
    """Leaves a result that is there, unless forced."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def fill_page(templates: DataFrame, values: dict[str, str], column: str = "value") -> DataFrame:
    """Text with every {KEY} replaced."""
    return templates.select(formats.fill(F.col(column), {k: F.lit(v) for k, v in values.items()}).alias(column))


def each(items: Iterable[str], work: Callable[[str], None]) -> list[tuple[str, str]]:
    """Runs work for each item and goes on after a failure; returns (item, error) of those that failed."""
    failed = []
    for item in items:
        try:
            work(item)
        except Exception as error:  # noqa: BLE001 - the report is the point
            failed.append((item, f"{type(error).__name__}: {error}"))
    return failed
