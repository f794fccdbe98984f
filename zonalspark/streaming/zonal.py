"""Zonal statistics over a stream of cells: an extension, as sums by zone and class merge in any order.

Each micro-batch writes its partial sums once, in a folder named by the batch, so
that a batch that runs again replaces its own; ``merge`` makes statistics of all.
State is on disk only: a stream may run for as long as it likes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.zonal import merge_partials, zonal_partials


def write_partials(cells: DataFrame, folder: str, keys: tuple[str, ...] = ("year", "zone", "class")):
    """Starts a query that takes what there is; awaitTermination() waits for it."""

    def batch(df: DataFrame, number: int) -> None:
        zonal_partials(df, keys).write.mode("overwrite").parquet(f"{folder}/partials/batch={number}")

    return cells.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def merge(spark: SparkSession, folder: str, keys: tuple[str, ...] = ("year", "zone", "class")) -> DataFrame:
    return merge_partials(spark.read.parquet(f"{folder}/partials"), keys)


def windowed(events: DataFrame, *, time: str = "ts", window: str = "1 day", late: str = "2 days", key: str = "zone", value: str = "value") -> DataFrame:
    """Statistics by window and zone; rows later than the watermark are left out. Works on batches too."""
    v = F.col(value)
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")).select(F.col("w.start").alias("start"), key, "n", "mean", "min", "max")
