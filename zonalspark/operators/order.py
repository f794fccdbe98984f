"""A global order without one partition: range partitions, and offsets from a count of each.

Equal rows of an order are in one range partition, so ranks inside of it and what the
partitions before it hold give the ranks of all rows. The counts are as many as there are
partitions; rows are shuffled twice and never brought together.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import forget, written

_PART = "__part"


def ranked(df: DataFrame, *order: Column, partitions: int | None = None) -> DataFrame:
    """df with ``place`` (row number), ``rank`` (equal rows the smallest place), ``dense`` (groups of equal rows up to here) and ``total``.

    order: sort expressions, as for orderBy. Among equal rows places have no fixed order.
    The rows are written once, so that places are those of one and the same order.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(n, *order).withColumn(_PART, F.spark_partition_id()), "order")
    by = Window.partitionBy(_PART).orderBy(*order)
    own = written(rows.withColumns({"place": F.row_number().over(by), "rank": F.rank().over(by), "dense": F.dense_rank().over(by)}), "ranked")
    forget(rows)
    counts = {r[_PART]: (r["n"], r["groups"]) for r in own.groupBy(_PART).agg(F.count("*").alias("n"), F.max("dense").alias("groups")).collect()}
    sizes = [counts.get(k, (0, 0)) for k in range(n)]
    before = [F.array(*map(F.lit, [0, *accumulate(s[i] for s in sizes)])) for i in (0, 1)]
    start, groups = (F.get(b, F.col(_PART)).cast("long") for b in before)
    out = {"place": start + F.col("place"), "rank": start + F.col("rank"), "dense": groups + F.col("dense"), "total": F.lit(sum(s[0] for s in sizes)).cast("long")}
    return own.withColumns(out).drop(_PART)
