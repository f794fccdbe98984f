"""Comparison of zones: deltas, medians of peers, ranks, leaderboards, shares and ranges.

zone_year has (zone, region, year, bucket, value, share); bucket I is the composite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import colour, formats
from ..tables import BUCKET_NAMES, BUCKETS, COMPOSITE

NATIONAL = "NATIONAL"
#: The ends of the composite's colour scale.
HEALTH_DOMAIN = (0.35, 0.75)


def zone_years(cells: DataFrame) -> DataFrame:
    """Area-weighted bucket means and shares by zone and year, with the composite as bucket I.

    Shares are of the counted buckets, so that the composite is the sum of value * share.
    """
    counted = cells.filter(F.col("bucket").isin(*BUCKETS) & F.col("value").isNotNull())
    by_bucket = counted.groupBy("zone", "region", "year", "bucket").agg(F.sum(F.col("value") * F.col("area")).alias("weighted"), F.sum("area").alias("area"))
    # a zone's year has one row for each bucket at most: brought together, no second branch reads the cells again
    own = F.collect_list(F.struct("bucket", "weighted", "area"))
    years = by_bucket.groupBy("zone", "region", "year").agg(own.alias("own"), F.sum("weighted").alias("weighted"), F.sum("area").alias("area"))
    each = F.transform("own", lambda b: F.struct(b["bucket"].alias("bucket"), (b["weighted"] / b["area"]).alias("value"), (b["area"] / F.col("area")).alias("share")))
    whole = F.struct(F.lit(COMPOSITE).alias("bucket"), (F.col("weighted") / F.col("area")).alias("value"), F.lit(None).cast("double").alias("share"))
    return years.select("zone", "region", "year", F.inline(F.concat(each, F.array(whole))))


def delta(zone_year: DataFrame, first: int, last: int, bucket: str = COMPOSITE) -> DataFrame:
    """value(last) - value(first) of each zone; null if either is missing. One pass, no self join."""
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value")))
    return zone_year.filter((F.col("bucket") == bucket) & F.col("year").isin(first, last)).groupBy("zone", "region").agg((at(last) - at(first)).alias("delta"))


def year_over_year(zone_year: DataFrame) -> DataFrame:
    """Change from the year before in the zone's list of years."""
    by = Window.partitionBy("zone", "bucket").orderBy("year")
    return zone_year.select("zone", "bucket", "year", "value", (F.col("value") - F.lag("value").over(by)).alias("yoy"))


def median_by(df: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """Exact median, nulls left out, even counts as the mean of the middle pair."""
    return df.groupBy(*keys).agg(F.median(value).alias("median"), F.count(value).alias("n"))


def region_median_of_others(df: DataFrame, value: str = "value", zone: str = "zone", region: str = "region") -> DataFrame:
    """df with the median of the other zones of its region, null if there are none.

    Leaving out one of n sorted values only moves the middle by one place, so four
    values in the middle of each region decide: no join, one shuffle on the region.
    """
    whole = Window.partitionBy(region)
    known = df.withColumns({"__at": F.row_number().over(whole.orderBy(F.col(value).asc_nulls_last(), zone)), "__n": F.count(value).over(whole)})
    known = known.withColumn("__at", F.when(F.col(value).isNotNull(), F.col("__at")))
    at, n = F.col("__at"), F.col("__n")
    # of n - 1 others the middle ones are places n / 2 and (n - 1) / 2 + 1, one further from the zone's own place on
    first = F.floor(n / 2) - 1
    middle = F.array(*(F.max(F.when(at == first + i, F.col(value))).over(whole) for i in range(4)))
    # a zone without a value leaves none out
    k = F.when(at.isNull(), n).otherwise(n - 1)
    low, high = F.floor((k + 1) / 2), F.floor(k / 2) + 1
    place = lambda j: F.get("__middle", (F.when(at <= j, j + 1).otherwise(j) - first).cast("int"))
    out = known.withColumn("__middle", middle).withColumn("median_others", F.when(k > 0, (place(low) + place(high)) / 2))
    return out.drop("__at", "__n", "__middle")


def neighbour_median(df: DataFrame, neighbours: DataFrame, value: str = "value") -> DataFrame:
    """Median over each zone's neighbours; neighbours: (zone, neighbor)."""
    values = df.select(F.col("zone").alias("neighbor"), F.col(value).alias("v"))
    return neighbours.join(values, "neighbor").groupBy("zone").agg(F.median("v").alias("neighbor_median"))


def ranks(df: DataFrame, value: str = "value") -> DataFrame:
    """Competition rank, 1 = highest, and group size, in the region and in the nation; without null values.

    The national order is over zones, a dimension; the counts come from an aggregate.
    """
    known = df.filter(F.col(value).isNotNull() & (F.col("zone").cast("string") != NATIONAL))
    region, nation = Window.partitionBy("region"), Window.partitionBy()
    counts = {"region_n": F.count("*").over(region), "nation_n": F.count("*").over(nation)}
    return known.withColumns({"region_rank": F.rank().over(region.orderBy(F.desc(value))), "nation_rank": F.rank().over(nation.orderBy(F.desc(value))), **counts})


def leaderboard(df: DataFrame, value: str = "value", *, region: int | None = None, most: int = 5) -> DataFrame:
    """Worst and best zones of a region or the nation: half = min(most, n // 2) each; none if n < 2.

    Ties go by zone in the ascending list; the best list is its reversal.
    """
    known = df.filter(F.col(value).isNotNull() & (F.col("zone").cast("string") != NATIONAL))
    if region is not None:
        known = known.filter(F.col("region") == region)
    # zones are a dimension: their order is made once, and both ends are read from it
    placed = known.withColumns({"__at": F.row_number().over(Window.orderBy(value, "zone")), "__n": F.count("*").over(Window.partitionBy())})
    at, n = F.col("__at"), F.col("__n")
    half = F.least(F.lit(most), F.floor(n / 2))
    worst = at <= half
    ends = placed.filter(worst | (at > n - half))
    return ends.select(F.when(worst, "worst").otherwise("best").alias("side"), F.when(worst, at).otherwise(n - at + 1).cast("int").alias("place"), "zone", value)


#: Fixed texts: titles of the best and of the worst zones, by the sign of the change.
BEST_TITLES, WORST_TITLES = ("largest increase", "smallest decrease"), ("smallest increase", "largest decrease")


def leaderboard_titles(board: DataFrame, value: str) -> DataFrame:
    """(best_title, worst_title) by the signs of the values as shown (rounded to 0.1 points)."""
    sign = F.signum(F.round(F.col(value) * 100, 1))
    best, worst = F.col("side") == "best", F.col("side") == "worst"
    return board.agg(
        F.when(F.max(F.when(best, sign)) > 0, BEST_TITLES[0]).otherwise(BEST_TITLES[1]).alias("best_title"),
        F.when(F.min(F.when(worst, sign)) > 0, WORST_TITLES[0]).otherwise(WORST_TITLES[1]).alias("worst_title"),
    )


def region_ranking(df: DataFrame, value: str = "value") -> DataFrame:
    """Regions by their median, highest first, with a bar of max(4, |median| / largest * 100)."""
    medians = df.groupBy("region").agg(F.median(value).alias("median")).filter("median IS NOT NULL")
    largest = F.max(F.abs("median")).over(Window.partitionBy())
    bar = F.greatest(F.lit(4), F.floor(F.abs("median") / F.nullif(largest, F.lit(0.0)) * 100 + 0.5)).cast("int")
    return medians.select("region", "median", F.rank().over(Window.orderBy(F.desc("median"))).alias("rank"), F.coalesce(bar, F.lit(4)).alias("bar"))


def contribution(zone_year: DataFrame) -> DataFrame:
    """Sum of value * share of the counted buckets, and what is left of 1."""
    counted = zone_year.filter(F.col("bucket").isin(*BUCKETS))
    total = F.sum(F.coalesce("value", F.lit(0.0)) * F.coalesce("share", F.lit(0.0)))
    return counted.groupBy("zone", "year").agg(total.alias("contribution")).withColumn("untapped", F.greatest(1 - F.col("contribution"), F.lit(0.0)))


def dominant(zone_year: DataFrame) -> DataFrame:
    """The bucket with the largest share, the first in F, A, G, U of ties; null shares are left out."""
    order = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket"))
    return zone_year.filter(F.col("bucket").isin(*BUCKETS) & F.col("share").isNotNull()).groupBy("zone", "year").agg(F.max_by("bucket", F.struct("share", -order)).alias("dominant"))


def empty_years(zone_year: DataFrame) -> DataFrame:
    """Years of a zone in which every value is null."""
    return zone_year.groupBy("zone", "year").agg(F.bool_and(F.col("value").isNull()).alias("empty"))


def top_and_other(counts: DataFrame, k: int = 6, keys: tuple[str, ...] = ("zone", "bucket"), item: str = "raster_id") -> DataFrame:
    """The k largest items of each group (ties: smaller item) and the rest as Other, if it is above 0."""
    by = Window.partitionBy(*keys).orderBy(F.desc("n"), item)
    placed = counts.withColumn("rn", F.row_number().over(by))
    label = F.when(F.col("rn") <= k, F.col(item).cast("string")).otherwise("Other")
    return placed.groupBy(*keys, label.alias("item")).agg(F.sum("n").alias("n")).filter((F.col("item") != "Other") | (F.col("n") > 0))


def bucket_domains(zone_year: DataFrame, pad: float = 0.08) -> DataFrame:
    """Smallest and largest value of each bucket with padding, inside 0..1; 0..1 if they are the same."""
    ends = zone_year.filter("value IS NOT NULL").groupBy("bucket").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    low, high = padded(F.col("a"), F.col("b"), pad)
    return ends.select("bucket", low.alias("low"), high.alias("high"))


def padded(a: Column, b: Column, pad: float = 0.08) -> tuple[Column, Column]:
    """The ends of a colour scale over values from a to b."""
    room, wide = (b - a) * pad, b > a
    return F.when(wide, F.greatest(a - room, F.lit(0.0))).otherwise(0.0), F.when(wide, F.least(b + room, F.lit(1.0))).otherwise(1.0)


def change_range(zone_year: DataFrame, step: float = 0.05) -> DataFrame:
    """Half-width of the change scale of each bucket: the widest spread of a zone over its years, rounded up to the step."""
    spread = zone_year.filter("value IS NOT NULL").groupBy("zone", "bucket").agg((F.max("value") - F.min("value")).alias("spread"))
    return spread.groupBy("bucket").agg(change_half_width(F.max("spread"), step).alias("m"))


def change_half_width(spread: Column, step: float = 0.05) -> Column:
    return F.greatest(F.ceil(F.round(spread / step, 9)) * step, F.lit(step))


def axis_top(largest: Column) -> Column:
    return F.when(largest > 0, F.ceil(F.round(largest * 1.15 / 5, 9)) * 5).otherwise(10).cast("double")


def axis_bottom(smallest: Column) -> Column:
    return F.greatest(F.floor(F.round(smallest * 0.85 / 5, 9)) * 5, F.lit(0)).cast("double")


def axis_bounds(df: DataFrame, value: str = "value", *keys: str) -> DataFrame:
    """Ends of an axis in points: 15 % of room above and below, in steps of 5."""
    return df.groupBy(*keys).agg(axis_top(F.max(value) * 100).alias("top"), axis_bottom(F.min(value) * 100).alias("bottom"))


def composite_indicator(a: DataFrame, b: DataFrame, c: DataFrame, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Mean of three layers cell by cell; null if one is. One shuffle on the cell, no join."""
    layers = a.select(*keys, F.lit(0).alias("k"), "value").union(b.select(*keys, F.lit(1).alias("k"), "value")).union(c.select(*keys, F.lit(2).alias("k"), "value"))
    return layers.groupBy(*keys).agg(F.count("value").alias("n"), F.sum("value").alias("s"), F.count("*").alias("m")).filter("m = 3").select(*keys, F.when(F.col("n") == 3, F.col("s") / 3).alias("value"))


def export_levels(zone_year: DataFrame, zones: DataFrame) -> DataFrame:
    """zone, name, region, year and a column of percent for each bucket, by zone number and year.

    zones: (zone, name, region). Every zone has a row for every year that any zone has, without values where it has none.
    """
    known = zone_year.groupBy("zone").pivot("bucket", [COMPOSITE, *BUCKETS]).agg(F.map_from_entries(F.collect_list(F.struct("year", "value"))))
    # zones and years are dimensions: the years of all of them are one short array
    years = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.map_keys(COMPOSITE)).over(Window.partitionBy()))))
    wide = zones.join(known, "zone", "left").withColumn("years", years).withColumn("year", F.explode("years"))
    percent = lambda b: F.round(F.try_element_at(b, F.col("year")) * 100, 2).alias(f"{b}_pct")
    return wide.select("zone", "name", "region", "year", *map(percent, (COMPOSITE, *BUCKETS))).orderBy(F.col("zone").cast("int"), "year")


def export_change(zone_year: DataFrame, zones: DataFrame, first: int, last: int) -> DataFrame:
    """zone, name, region, the years, and the change of each bucket in points, by zone number; every zone has a row."""
    at = lambda b, y: F.max(F.when((F.col("bucket") == b) & (F.col("year") == y), F.col("value")))
    wide = zone_year.groupBy("zone").agg(*((at(b, last) - at(b, first)).alias(b) for b in (COMPOSITE, *BUCKETS)))
    points = [F.round(F.col(b) * 100, 2).alias(f"{b}_change_pp") for b in (COMPOSITE, *BUCKETS)]
    return zones.join(wide, "zone", "left").select("zone", "name", "region", F.lit(first).alias("from_year"), F.lit(last).alias("to_year"), *points).orderBy(F.col("zone").cast("int"))


def export_trend(trends: DataFrame, zones: DataFrame) -> DataFrame:
    """zone, name, region and the slope of each bucket in points a year, by zone number; every zone has a row. trends: (zone, bucket, slope)."""
    wide = trends.groupBy("zone").pivot("bucket", [COMPOSITE, *BUCKETS]).agg(F.first("slope"))
    slopes = [F.round(F.col(b) * 100, 3).alias(f"{b}_slope_pp_per_year") for b in (COMPOSITE, *BUCKETS)]
    return zones.join(wide, "zone", "left").select("zone", "name", "region", *slopes).orderBy(F.col("zone").cast("int"))


def in_name_order(names: DataFrame, name: str = "name", locale: str = "cs") -> DataFrame:
    """names with their place in the order of a language, from 1. They are a dimension: one partition orders them."""
    return names.withColumn("place", F.row_number().over(Window.orderBy(F.collate(name, locale), name)))


def fills(zone_years: DataFrame, year: int, first: int, last: int) -> DataFrame:
    """zone, and the colours of its levels in a year, of its dominant class, and of its changes between two years.

    The composite has a fixed domain, a bucket the range of all zones and years with its
    padding; changes are coloured over the same range for every pair of years. Zones and
    buckets are a small table, made once: their ends come from windows over it.
    """
    own, order = F.col("bucket"), F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket"))
    at = lambda y, what="value": F.max(F.when(F.col("year") == y, F.col(what)))
    wide = zone_years.groupBy("zone", "bucket").agg(
        at(year).alias("level"), at(first).alias("before"), at(last).alias("after"), at(year, "share").alias("share"), F.max(F.col("year") == year).alias("has_year"),
        F.min("value").alias("least"), F.max("value").alias("most"),
    )
    by = Window.partitionBy("bucket")
    ends = padded(F.min("least").over(by), F.max("most").over(by))
    ranged = wide.withColumns({"low": ends[0], "high": ends[1], "m": change_half_width(F.max(F.col("most") - F.col("least")).over(by))})
    fixed = lambda i: F.when(own == COMPOSITE, F.lit(HEALTH_DOMAIN[i])).otherwise(F.col(("low", "high")[i]))
    level = colour.fill_level(F.col("level"), fixed(0), fixed(1), F.when((own == COMPOSITE) & F.col("has_year"), colour.NO_VALUE).otherwise(colour.NO_DATA))
    moved = colour.fill_change(F.col("before"), F.col("after"), F.col("m"))
    return ranged.groupBy("zone").agg(
        colour.fill_class(F.max_by("bucket", F.when(own.isin(*BUCKETS) & F.col("share").isNotNull(), F.struct("share", -order)))).alias("dominant"),
        *(F.coalesce(F.max(F.when(own == b, level)), F.lit(colour.NO_DATA)).alias(f"{b}_level") for b in (COMPOSITE, *BUCKETS)),
        *(F.coalesce(F.max(F.when(own == b, moved)), F.lit(colour.NO_DATA)).alias(f"{b}_change") for b in (COMPOSITE, *BUCKETS)),
    )


def tips(zone_years: DataFrame, names: DataFrame, year: int, first: int, last: int) -> DataFrame:
    """(zone, dominant, and for the composite and each bucket a tip of its level and of its change): the texts that a map shows at a zone.

    A bucket's level comes with the median of the region's other zones, the composite's does not.
    """
    by = Window.partitionBy("zone", "bucket")
    ends = zone_years.filter(F.col("year").isin(year, first, last)).withColumns({"before": F.max(F.when(F.col("year") == first, F.col("value"))).over(by), "after": F.max(F.when(F.col("year") == last, F.col("value"))).over(by)})
    levels = region_median_of_others(ends.filter(F.col("year") == year).withColumn("part", F.concat_ws(":", "region", "bucket")), region="part")
    label = lambda b: "IEI" if b == COMPOSITE else f"IEI ({BUCKET_NAMES[b]})"
    order, own = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket")), F.col("bucket")
    wide = levels.groupBy("zone").agg(
        F.max_by(F.struct("bucket", "share"), F.when(F.col("share").isNotNull(), F.struct("share", -order))).alias("top"),
        *(F.max(F.when(own == b, F.struct("value", "median_others", (F.col("after") - F.col("before")).alias("moved")))).alias(b) for b in (COMPOSITE, *BUCKETS)),
    )
    name = F.col("name")
    texts = [formats.dominant_tip(name, formats.mapped(F.col("top.bucket"), BUCKET_NAMES), F.col("top.share")).alias("dominant")]
    for b in (COMPOSITE, *BUCKETS):
        median = None if b == COMPOSITE else F.col(f"{b}.median_others")
        texts += [
            formats.level_tip(name, F.lit(label(b)), F.lit(year), F.col(f"{b}.value"), median).alias(f"{b}_level"),
            formats.change_tip(name, F.lit(label(b)), F.lit(first), F.lit(last), F.col(f"{b}.moved")).alias(f"{b}_change"),
        ]
    return names.join(wide, "zone").select("zone", *texts)
