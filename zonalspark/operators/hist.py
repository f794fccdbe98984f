"""Histograms with fixed edges, percentiles interpolated from them, and colour breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Range and bins of each kind of layer; percentiles; stops of the ramp; shares for candidate ranges.
LEVEL, CHANGE, SLOPE = (0.0, 1.0, 1000), (-100.0, 100.0, 4000), (-25.0, 25.0, 2000)
PERCENTILES = (0.5, 1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 75.0, 90.0, 95.0, 97.5, 99.0, 99.5)
STOPS = (0.0, 1 / 6, 2 / 6, 0.5, 4 / 6, 5 / 6, 1.0)
EXTRA = {"change": (10.0, 20.0, 30.0), "slope": (1.0, 2.0, 3.0)}
PAIRS = {95: (2.5, 97.5), 98: (1.0, 99.0), 99: (0.5, 99.5)}


def binned(df: DataFrame, low: float, high: float, bins: int, *, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: its counted bins as a sorted array, and all that can be said of its values, from one pass.

    Values below and above the range are bins -1 and ``bins`` of the first aggregate; a key's array has at most ``bins`` entries.
    """
    v, width = F.col(value), (high - low) / bins
    at = F.when(v < low, -1).when(v > high, bins).otherwise(F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int"))
    counts = df.groupBy(*keys, at.alias("bin")).agg(F.count(v).alias("count"), F.sum(v).alias("s"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    inside = F.col("bin").between(0, bins - 1)
    entry = F.when(inside & (F.col("count") > 0), F.struct("bin", "count"))
    some = lambda where: F.coalesce(F.sum(F.when(where, F.col("count"))), F.lit(0))
    return counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), F.sum("count").alias("valid"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        (F.sum("s") / F.nullif(F.sum("count"), F.lit(0))).alias("mean"), some(F.col("bin") == -1).alias("below"), some(F.col("bin") == bins).alias("above"), some(inside).alias("total"),
    )


def spread(table: DataFrame, low: float, high: float, bins: int, *keep: str) -> DataFrame:
    """The rows of ``binned`` as histograms: the columns to keep, and every bin, counted or not."""
    width = (high - low) / bins
    own = table.withColumn("e", F.expr(f"concat(array(named_struct('bin', -1, 'count', 0L)), entries)"))
    filled = own.withColumn("b", F.expr(f"flatten(transform(e, (x, i) -> transform(sequence(x.bin, coalesce(get(e, i + 1).bin, {bins}) - 1), k -> named_struct('bin', k, 'count', if(k = x.bin, x.count, 0L)))))"))
    rows = filled.select(*keep, "total", F.explode("b").alias("b")).filter("b.bin >= 0").select(*keep, "total", "b.*")
    return rows.select(*keep, "bin", (low + F.col("bin") * width).alias("bin_left"), (low + (F.col("bin") + 1) * width).alias("bin_right"), "count", F.coalesce(F.col("count") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0)).alias("share"))


def histogram(df: DataFrame, low: float, high: float, bins: int, *, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, bin, bin_left, bin_right, count, share): bins closed on the left, the last on both sides.

    Values outside the range are in no bin; shares are of those inside.
    """
    return spread(binned(df, low, high, bins, value=value, keys=keys), low, high, bins, *keys)


def range_stats(df: DataFrame, low: float, high: float, *, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """Valid cells, minimum, maximum, mean, and how many are below and above the range."""
    v = F.col(value)
    return df.filter(v.isNotNull()).groupBy(*keys).agg(F.count(v).alias("valid"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.count_if(v < low).alias("below"), F.count_if(v > high).alias("above"))


def percentiles(hist: DataFrame, wanted: tuple[float, ...] = PERCENTILES, *, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, percentile, value): linear inside the first bin whose running count reaches the target; null without counts.

    The window runs over the bins of a histogram, a fixed number for each key.
    """
    by = Window.partitionBy(*keys, F.lit(0)).orderBy("bin")
    running = hist.withColumn("cum", F.sum("count").over(by.rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum("count").over(Window.partitionBy(*keys, F.lit(0))))
    asked = running.withColumn("percentile", F.explode(F.array(*map(F.lit, wanted)))).withColumn("target", F.col("total") * F.col("percentile") / 100)
    frac = F.when(F.col("count") > 0, (F.col("target") - (F.col("cum") - F.col("count"))) / F.col("count")).otherwise(0.0)
    at = F.when((F.col("cum") >= F.col("target")) & (F.col("total") > 0), F.struct("bin", (F.col("bin_left") + frac * (F.col("bin_right") - F.col("bin_left"))).alias("value")))
    return asked.groupBy(*keys, "percentile").agg(F.min(at).alias("m")).select(*keys, "percentile", F.col("m.value").alias("value"))


def percentile_table(df: DataFrame, kind: tuple[float, float, int] = LEVEL, *, value: str = "value", key: str = "year") -> DataFrame:
    """One row per year: valid cells, minimum, maximum, mean, and a column for each percentile (p0_5, p1, ...)."""
    names = {q: f"p{q:g}".replace(".", "_") for q in PERCENTILES}
    p = percentiles(histogram(df, *kind, value=value, keys=(key,)), keys=(key,))
    wide = p.groupBy(key).agg(*(F.max(F.when(F.col("percentile") == q, F.col("value"))).alias(n) for q, n in names.items()))
    return range_stats(df, kind[0], kind[1], value=value, keys=(key,)).drop("below", "above").join(wide, key)


def share_within(hist: DataFrame, ranges: DataFrame, m: str = "m") -> DataFrame:
    """ranges with the share of counts in bins whose centre is at most m from 0. A histogram's bins meet a few ranges."""
    centre = (F.col("bin_left") + F.col("bin_right")) / 2
    few = hist.select(centre.alias("centre"), "count").crossJoin(F.broadcast(ranges))
    return few.groupBy(*ranges.columns).agg((F.sum(F.when(F.abs("centre") <= F.col(m), F.col("count")).otherwise(0)) / F.nullif(F.sum("count"), F.lit(0))).alias("share"))


def candidate_ranges(hist: DataFrame, fixed: tuple[float, ...]) -> DataFrame:
    """(name, m): for 95, 98 and 99 % of the cells the larger absolute percentile, and fixed ranges."""
    p = percentiles(hist).groupBy().agg(*(F.max(F.when(F.col("percentile") == q, F.abs("value"))).alias(f"q{i}") for i, q in enumerate(PERCENTILES)))
    at = {q: f"q{i}" for i, q in enumerate(PERCENTILES)}
    named = [F.struct(F.lit(f"covers_{k}pct (p{a:g}/p{b:g})").alias("name"), F.greatest(at[a], at[b]).alias("m")) for k, (a, b) in PAIRS.items()]
    named += [F.struct(F.lit(f"fixed_{x:g}").alias("name"), F.lit(float(x)).alias("m")) for x in fixed]
    return p.select(F.explode(F.array(*named)).alias("x")).select("x.*")


def colour_breaks(hist: DataFrame, fixed: tuple[float, ...]) -> DataFrame:
    """(name, m, share, stop1..stop7): each candidate range with its share and the values M * (2p - 1) of the stops."""
    out = share_within(hist, candidate_ranges(hist, fixed))
    return out.select("name", "m", "share", *((F.col("m") * (2 * p - 1)).alias(f"stop{i}") for i, p in enumerate(STOPS, 1)))
