"""Temporal regression by group: least squares, weighted, Theil-Sen, influence, and the trend table.

x is centred on the middle year before any sum, so that sums of squares keep
their digits. Everything is built-in aggregates: partial sums meet in one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.tdist import p_value

MIN_YEARS = 4
MIN_INFLUENCE = 5
FLAG = 0.5
CENTRE = 2000


def _nonzero(c: Column) -> Column:
    """c, or null where it is 0 but for rounding."""
    return F.when(F.abs(c) > 1e-15, c)


def _centred(x: str) -> Column:
    return (F.col(x) - CENTRE).cast("double")


def _sums(x: str, y: str) -> dict[str, Column]:
    """Aggregates of an unweighted fit over rows with a value."""
    xs, ys = _centred(x), F.col(y)
    return {"n": F.count(ys), "xm": F.avg(xs), "ym": F.avg(ys), "sxx": F.regr_sxx(ys, xs), "sxy": F.regr_sxy(ys, xs), "syy": F.regr_syy(ys, xs)}


def _fit(sums: DataFrame) -> DataFrame:
    """sums with slope, intercept, r2, t and p."""
    slope = F.col("sxy") / _nonzero(F.col("sxx"))
    out = sums.withColumn("slope", slope).withColumn("intercept", F.col("ym") - F.col("slope") * (F.col("xm") + CENTRE)).withColumn("df", (F.col("n") - 2).cast("int"))
    sse = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    out = out.withColumn("sse", F.when(F.col("syy") > 1e-18, sse)).withColumn("r2", 1 - F.col("sse") / _nonzero(F.col("syy")))
    perfect = F.col("sse") <= 1e-14 * F.col("syy")
    out = out.withColumn("t", F.when(~perfect, F.col("slope") / F.sqrt(F.col("sse") / F.col("df") / F.col("sxx"))))
    return out.withColumn("p", p_value("t", "df"))


def ols(series: DataFrame, keys: tuple[str, ...], *, years: int | None = None, least: int = MIN_YEARS, y: str = "value", x: str = "year") -> DataFrame:
    """slope, intercept, r2, t and p of each group; years: only groups with a value in every one of so many.

    r2 and p are null where y is constant, and p where the fit is perfect.
    """
    sums = series.filter(F.col(y).isNotNull()).groupBy(*keys).agg(*(v.alias(k) for k, v in _sums(x, y).items()))
    return _fit(sums.filter(F.col("n") == years if years else F.col("n") >= least)).select(*keys, F.col("n").cast("int").alias("n_years"), "slope", "intercept", "r2", "t", "p")


def _terms(x: Column, y: Column, w: Column) -> dict[str, Column]:
    return {"w": w, "wx": w * x, "wy": w * y, "wxx": w * x * x, "wxy": w * x * y}


def _weighted_slope(v: dict[str, Column]) -> Column:
    return (v["wxy"] - v["wx"] * v["wy"] / v["w"]) / _nonzero(v["wxx"] - v["wx"] * v["wx"] / v["w"])


def _weighted_intercept(slope: str) -> Column:
    return F.col("wy") / F.col("w") - F.col(slope) * (F.col("wx") / F.col("w") + CENTRE)


def weighted_ols(series: DataFrame, keys: tuple[str, ...], *, y: str = "value", x: str = "year", weight: str = "n", least: int = MIN_YEARS) -> DataFrame:
    """Slope and intercept with weights: the effective weight of a year is its count."""
    terms = _terms(_centred(x), F.col(y), F.col(weight).cast("double"))
    sums = series.filter(F.col(y).isNotNull()).groupBy(*keys).agg(F.count(y).alias("k"), *(F.sum(v).alias(k) for k, v in terms.items())).filter(F.col("k") >= least)
    return sums.withColumn("slope", _weighted_slope({k: F.col(k) for k in terms})).select(*keys, "slope", _weighted_intercept("slope").alias("intercept"))


def _series(x: str, y: str, w: Column) -> Column:
    """A group's few years as one array."""
    return F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y"), w.alias("w"))))


def _middle(values: Column) -> Column:
    """Median of a sorted array."""
    n = F.size(values)
    return (F.get(values, ((n - 1) / 2).cast("int")) + F.get(values, (n / 2).cast("int"))) / 2


#: Slopes of all pairs of years of a series s.
_PAIRS = "flatten(transform(s, (a, i) -> transform(slice(s, i + 2, size(s)), b -> if(b.x > a.x, (b.y - a.y) / (b.x - a.x), NULL))))"


def _theil_sen(groups: DataFrame) -> DataFrame:
    """groups with series s: and ts_slope, ts_intercept."""
    out = groups.withColumn("m", F.array_sort(F.array_compact(F.expr(_PAIRS))))
    median = lambda k: _middle(F.array_sort(F.transform("s", lambda e: e[k].cast("double"))))
    return out.withColumn("ts_slope", _middle(F.col("m"))).withColumn("ts_intercept", median("y") - F.col("ts_slope") * median("x"))


def theil_sen(series: DataFrame, keys: tuple[str, ...], *, y: str = "value", x: str = "year", least: int = MIN_YEARS) -> DataFrame:
    """Median of the slopes of all pairs of years, and median(y) - slope * median(x).

    A group's series is an array of a few years, so its pairs are made in the row, without a join.
    """
    groups = series.filter(F.col(y).isNotNull()).groupBy(*keys).agg(_series(x, y, F.lit(1.0)).alias("s")).filter(F.size("s") >= least)
    return _theil_sen(groups).select(*keys, F.col("ts_slope").alias("slope"), F.col("ts_intercept").alias("intercept"))


def _influential(least: int) -> Column:
    """The year of series s without which the weighted slope moves most; sums without a year are the group's less its terms."""
    whole = {k: F.col(k) for k in _terms(F.lit(0), F.lit(0), F.lit(0))}

    def moved(e: Column) -> Column:
        own = _terms((e["x"] - CENTRE).cast("double"), e["y"], e["w"])
        shift = F.abs(_weighted_slope({k: whole[k] - own[k] for k in whole}) - _weighted_slope(whole))
        return F.struct(F.round(shift, 12).alias("shift"), (-e["x"]).alias("x"))

    return F.when(F.size("s") >= least, -F.array_max(F.transform("s", moved))["x"]).cast("int")


def influential_year(series: DataFrame, keys: tuple[str, ...], *, y: str = "value", x: str = "year", weight: str = "n", least: int = MIN_INFLUENCE) -> DataFrame:
    """The year whose removal moves the weighted slope most; the earliest of ties."""
    w = F.col(weight).cast("double")
    terms = _terms(_centred(x), F.col(y), w)
    groups = series.filter(F.col(y).isNotNull()).groupBy(*keys).agg(_series(x, y, w).alias("s"), *(F.sum(v).alias(k) for k, v in terms.items()))
    return groups.filter(F.size("s") >= least).select(*keys, _influential(least).alias("most_influential_year"))


def trend_table(zonal: DataFrame, keys: tuple[str, ...] = ("zone", "class"), *, y: str = "mean", weight: str = "n") -> DataFrame:
    """One row per group: weighted slope, unweighted r2 and p, Theil-Sen, their disagreement, and the influential year."""
    w = F.col(weight).cast("double")
    terms = _terms(_centred("year"), F.col(y), w)
    # all of it from one aggregate: sums, and the few years as an array
    groups = zonal.filter(F.col(y).isNotNull()).groupBy(*keys).agg(_series("year", y, w).alias("s"), *(v.alias(k) for k, v in _sums("year", y).items()), *(F.sum(v).alias(k) for k, v in terms.items()))
    enough = F.col("n") >= MIN_YEARS
    out = _theil_sen(_fit(groups)).withColumn("w_slope", _weighted_slope({k: F.col(k) for k in terms}))
    values = {
        "ols_slope": F.col("w_slope"), "ols_intercept": _weighted_intercept("w_slope"), "ols_r2": F.col("r2"), "ols_pvalue": F.col("p"),
        "theilsen_slope": F.col("ts_slope"), "theilsen_intercept": F.col("ts_intercept"), "most_influential_year": _influential(MIN_INFLUENCE),
    }
    out = out.select(*keys, F.col("n").cast("int").alias("n_years"), *(F.when(enough, v).alias(k) for k, v in values.items()))
    gap = F.abs(F.col("ols_slope") - F.col("theilsen_slope")) / F.greatest(F.abs("theilsen_slope"), F.lit(1e-6))
    out = out.withColumn("slope_disagreement", gap).withColumn("flagged", F.coalesce(F.col("slope_disagreement") > FLAG, F.lit(False)))
    return out.select(*keys, "n_years", "ols_slope", "ols_intercept", "ols_r2", "ols_pvalue", "theilsen_slope", "theilsen_intercept", "slope_disagreement", "flagged", "most_influential_year")


def flagged_report(trends: DataFrame, k: int = 20) -> DataFrame:
    """The k flagged groups that disagree most."""
    return trends.filter("flagged").orderBy(F.desc("slope_disagreement")).limit(k)


def cell_change(series: DataFrame, keys: tuple[str, ...], first: int, last: int, years: int, *, y: str = "value", x: str = "year") -> DataFrame:
    """(last - first) * 100, and the slope * 100, of the cells with a value in every year: one pass for both."""
    xs = (F.col(x) - CENTRE).cast("double")
    sums = series.filter(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.count(y).alias("k"), F.max(F.when(F.col(x) == first, F.col(y))).alias("a"), F.max(F.when(F.col(x) == last, F.col(y))).alias("b"), F.regr_slope(F.col(y), xs).alias("m")
    )
    return sums.filter(F.col("k") == years).select(*keys, ((F.col("b") - F.col("a")) * 100).alias("change_pp"), (F.col("m") * 100).alias("slope_pp"))


def trend_line(zone_year: DataFrame, trends: DataFrame | None = None, key: str = "zone", least: int = MIN_YEARS) -> DataFrame:
    """The line rebuilt from slope and means over the valid years, in percentage points.

    trends: (key, slope); without it, each group's own fit if it has years enough. One shuffle on the key.
    """
    by = Window.partitionBy(key)
    known = zone_year.filter("value IS NOT NULL").withColumns({"ym": F.avg("value").over(by), "xm": F.avg("year").over(by)})
    if trends is not None:
        known = known.join(trends.select(key, "slope"), key)
    else:
        sums = {k: v.over(by) for k, v in _sums("year", "value").items() if k in ("n", "sxx", "sxy")}
        known = known.withColumns(sums).filter(F.col("n") >= least).withColumn("slope", F.col("sxy") / _nonzero(F.col("sxx")))
    return known.select(key, "year", ((F.col("ym") + F.col("slope") * (F.col("year") - F.col("xm"))) * 100).alias("line_pp"))
