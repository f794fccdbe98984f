"""Histogram, percentile and colour-break queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hist, regress
from ..tables import cells, cells_sql
from .common import even, even_sql

YEARS = 7


def _levels(spark, d):
    """Every tenth of a value below the range, so that some cells are outside of it."""
    return cells(spark, d).filter("value IS NOT NULL").select("year", (F.col("value") * 1.2 - 0.1).alias("value"))


def _changes(spark, d):
    series = cells(spark, d, "supplier", nodata=False).groupBy("zone", "year").agg(F.avg("value").alias("value"))
    return regress.cell_change(series, ("zone",), 1995, 2001, YEARS)


def hist_levels(spark, d):
    return even(hist.histogram(_levels(spark, d), *hist.LEVEL, keys=("year",)))


def hist_change(spark, d):
    return even(hist.histogram(_changes(spark, d), *hist.CHANGE, value="change_pp"))


def hist_slope(spark, d):
    return even(hist.histogram(_changes(spark, d), *hist.SLOPE, value="slope_pp"))


def hist_percentiles(spark, d):
    return even(hist.percentiles(hist.histogram(_levels(spark, d), *hist.LEVEL)))


def hist_percentiles_by_year(spark, d):
    """One row per year with its percentiles as columns."""
    return even(hist.percentile_table(_levels(spark, d)), 9)


def range_stats(spark, d):
    return even(hist.range_stats(_levels(spark, d), 0.0, 1.0, keys=("year",)))


def colour_breaks(spark, d):
    return even(hist.colour_breaks(hist.histogram(_changes(spark, d), *hist.CHANGE, value="change_pp"), hist.EXTRA["change"]))


def colour_breaks_slope(spark, d):
    return even(hist.colour_breaks(hist.histogram(_changes(spark, d), *hist.SLOPE, value="slope_pp"), hist.EXTRA["slope"]))


_L = f"WITH {cells_sql()}, v AS (SELECT year, value * 1.2e0 - 0.1e0 AS value FROM cells WHERE value IS NOT NULL)"
_C = f"WITH {cells_sql('supplier', False)}, z AS (SELECT zone, year, avg(value) AS value FROM cells GROUP BY zone, year), c AS (SELECT zone, (max(CASE WHEN year = 2001 THEN value END) - max(CASE WHEN year = 1995 THEN value END)) * 100 AS change_pp, regr_slope(value, year - 2000e0) * 100 AS slope_pp FROM z GROUP BY zone HAVING count(value) = {YEARS})"


def _hist_sql(source: str, kind: tuple[float, float, int], value: str = "value", key: str = "") -> str:
    """CTE h: the histogram of a CTE."""
    low, high, bins = kind
    width = f"{(high - low) / bins!r}e0"
    k = f"{key}, " if key else ""
    frame = f"(SELECT {k}b FROM (SELECT unnest(range({bins})) AS b) AS r" + (f", (SELECT DISTINCT {key} FROM {source}) AS k)" if key else ")")
    on = f"f.b = n.bin AND f.{key} = n.{key}" if key else "f.b = n.bin"
    total = f"sum(count) OVER (PARTITION BY {key})" if key else "sum(count) OVER ()"
    return f"""n AS (SELECT {k}least(floor(({value} - ({low!r}e0)) / {width}), {bins - 1}) AS bin, count(*) AS count FROM {source} WHERE {value} BETWEEN {low!r} AND {high!r} GROUP BY ALL),
 h0 AS (SELECT {'f.' + key + ',' if key else ''} f.b AS bin, {low!r}e0 + f.b * {width} AS bin_left, {low!r}e0 + (f.b + 1) * {width} AS bin_right, coalesce(n.count, 0) AS count FROM {frame} f LEFT JOIN n ON {on}),
 h AS (SELECT *, coalesce(count / nullif({total}, 0), 0) AS share FROM h0)"""


def _pct_sql(key: str = "") -> str:
    """CTE q: percentiles of h."""
    part = f"PARTITION BY {key} " if key else ""
    k = f"{key}, " if key else ""
    wanted = ", ".join(f"({p!r}e0)" for p in hist.PERCENTILES)
    return f"""c0 AS (SELECT *, sum(count) OVER ({part}ORDER BY bin ROWS UNBOUNDED PRECEDING) AS cum, sum(count) OVER ({part}) AS total FROM h),
 c1 AS (SELECT c0.*, p.p AS percentile, total * p.p / 100 AS target FROM c0, (VALUES {wanted}) AS p(p)),
 q AS (SELECT {k}percentile, arg_min(CASE WHEN count > 0 THEN bin_left + (target - (cum - count)) / count * (bin_right - bin_left) ELSE bin_left END, bin) FILTER (cum >= target AND total > 0) AS value FROM c1 GROUP BY ALL)"""


def _breaks_sql(value: str, kind: tuple[float, float, int], extra: tuple[float, ...]) -> str:
    at = lambda p: f"(SELECT abs(value) FROM q WHERE percentile = {p!r})"
    named = [f"SELECT 'covers_{k}pct (p{a:g}/p{b:g})' AS name, greatest({at(a)}, {at(b)}) AS m" for k, (a, b) in hist.PAIRS.items()]
    named += [f"SELECT 'fixed_{x:g}', {x!r}e0" for x in extra]
    stops = ", ".join(f"m * {2 * p - 1!r}e0 AS stop{i}" for i, p in enumerate(hist.STOPS, 1))
    body = f"{_C}, {_hist_sql('c', kind, value)}, {_pct_sql()}, r AS ({' UNION ALL '.join(named)}), s AS (SELECT name, m, sum(CASE WHEN abs((bin_left + bin_right) / 2) <= m THEN count ELSE 0 END) / sum(count) AS share FROM r, h GROUP BY name, m) --\nSELECT *, {stops} FROM s"
    return even_sql(body, "", "m share " + " ".join(f"stop{i}" for i in range(1, 8)), "name")


_NAMES = {p: f"p{p:g}".replace(".", "_") for p in hist.PERCENTILES}
_BINS = ("bin count", "bin_left bin_right share")

QUERIES = {
    "hist_levels": (hist_levels, even_sql(f"{_L}, {_hist_sql('v', hist.LEVEL, key='year')} --\nSELECT * FROM h", f"year {_BINS[0]}", _BINS[1])),
    "hist_change": (hist_change, even_sql(f"{_C}, {_hist_sql('c', hist.CHANGE, 'change_pp')} --\nSELECT * FROM h", *_BINS)),
    "hist_slope": (hist_slope, even_sql(f"{_C}, {_hist_sql('c', hist.SLOPE, 'slope_pp')} --\nSELECT * FROM h", *_BINS)),
    "hist_percentiles": (hist_percentiles, even_sql(f"{_L}, {_hist_sql('v', hist.LEVEL)}, {_pct_sql()} --\nSELECT * FROM q", "", "percentile value")),
    "hist_percentiles_by_year": (
        hist_percentiles_by_year,
        even_sql(f"{_L}, {_hist_sql('v', hist.LEVEL, key='year')}, {_pct_sql('year')}, w AS (SELECT year, " + ", ".join(f"max(CASE WHEN percentile = {p!r} THEN value END) AS {n}" for p, n in _NAMES.items()) + " FROM q GROUP BY year) --\nSELECT * FROM (SELECT year, count(*) AS valid, min(value) AS min, max(value) AS max, avg(value) AS mean FROM v GROUP BY year) a JOIN w USING (year)", "year valid", "min max mean " + " ".join(_NAMES.values()), digits=9),
    ),
    "range_stats": (range_stats, even_sql(f"{_L} --\nSELECT year, count(value) AS valid, min(value) AS min, max(value) AS max, avg(value) AS mean, count(*) FILTER (value < 0) AS below, count(*) FILTER (value > 1) AS above FROM v GROUP BY year", "year valid below above", "min max mean")),
    "colour_breaks": (colour_breaks, _breaks_sql("change_pp", hist.CHANGE, hist.EXTRA["change"])),
    "colour_breaks_slope": (colour_breaks_slope, _breaks_sql("slope_pp", hist.SLOPE, hist.EXTRA["slope"])),
}
