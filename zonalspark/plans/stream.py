"""Streaming queries over events: users as zones, event types as classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming import zonal
from .common import even, even_sql


def _cells(events):
    return events.select(F.lit(2024).alias("year"), (F.col("user_id") + 1).cast("int").alias("zone"), (F.ascii("event_type") - 96).alias("class"), "value", F.col("ts").cast("timestamp").alias("ts"))


def stream_zonal(spark, d):
    """Events as a stream, to its end, in micro-batches."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    folder = shared_folder(spark, "stream")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).option("pathGlobFilter", "events.parquet").parquet(d)
    zonal.write_partials(_cells(stream), folder).awaitTermination()
    return even(zonal.merge(spark, folder), 7)


def stream_windows(spark, d):
    """The windowed statistics, here of a batch: the same plan that a stream runs."""
    out = zonal.windowed(_cells(spark.read.parquet(f"{d}/events.parquet")))
    return even(out.select(F.unix_timestamp("start").alias("start"), "zone", "n", "mean", "min", "max"))


_E = "WITH c AS (SELECT 2024 AS year, user_id + 1 AS zone, ascii(event_type) - 96 AS class, value, epoch(date_trunc('day', ts)) AS start FROM events)"
_S = "count(value) AS n, avg(value) AS mean, min(value) AS min, max(value) AS max"

QUERIES = {
    "stream_zonal": (stream_zonal, even_sql(f"{_E} --\nSELECT year, zone, class, {_S}, stddev_pop(value) AS std_pop FROM c WHERE zone > 0 AND value IS NOT NULL GROUP BY year, zone, class", "year zone class n", "mean std_pop min max", digits=7)),
    "stream_windows": (stream_windows, even_sql(f"{_E} --\nSELECT start, zone, {_S} FROM c GROUP BY start, zone", "start zone n", "mean min max")),
}
