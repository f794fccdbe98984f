"""Regression and change queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tdist import p_value_sql
from ..operators import regress, zonal
from ..tables import cells, cells_sql
from .common import even, even_sql

KEYS = ("zone", "class")
YEARS = 7


def _zonal(spark, d, every: bool = False):
    """(zone, class, year, n, mean): zones are nations."""
    return zonal.zonal_stats(cells(spark, d)).select(*KEYS, "year", "n", "mean")


def trend_ols(spark, d):
    return even(regress.ols(_zonal(spark, d), KEYS, y="mean").drop("t", "p"))


def trend_pvalue(spark, d):
    return even(regress.ols(_zonal(spark, d), KEYS, y="mean", years=YEARS).select(*KEYS, "t", "p"), 6)


def trend_weighted(spark, d):
    return even(regress.weighted_ols(_zonal(spark, d), KEYS, y="mean"))


def theil_sen(spark, d):
    return even(regress.theil_sen(_zonal(spark, d), KEYS, y="mean"))


def influential_year(spark, d):
    return even(regress.influential_year(_zonal(spark, d), KEYS, y="mean"))


def trend_table(spark, d):
    """The flagship: the whole trend table of every zone and class."""
    return even(regress.trend_table(_zonal(spark, d)), 5)


def trend_flags(spark, d):
    out = regress.trend_table(_zonal(spark, d)).select(*KEYS, "n_years", "flagged")
    return even(out)


def flagged_report(spark, d):
    return even(regress.flagged_report(regress.trend_table(_zonal(spark, d))).select(*KEYS, "slope_disagreement"), 4)


def _supplier_series(spark, d):
    return cells(spark, d, "supplier", nodata=False).groupBy("zone", "year").agg(F.avg("value").alias("value"))


def cell_change(spark, d):
    return even(regress.cell_change(_supplier_series(spark, d), ("zone",), 1995, 2001, YEARS).select("zone", "change_pp"))


def cell_slope(spark, d):
    return even(regress.cell_change(_supplier_series(spark, d), ("zone",), 1995, 2001, YEARS).select("zone", "slope_pp"))


def trend_line(spark, d):
    return even(regress.trend_line(_supplier_series(spark, d)))


_Z = f"WITH {cells_sql()}, z AS (SELECT zone, class, year, year - 2000e0 AS x, count(value) AS n, avg(value) AS y FROM cells WHERE value IS NOT NULL GROUP BY zone, class, year)"
_S = f"{_Z}, s AS (SELECT zone, class, count(*) AS k, avg(x) AS xm, avg(y) AS ym, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy FROM z GROUP BY zone, class HAVING count(*) >= 4), f AS (SELECT *, sxy / sxx AS slope, greatest(syy - sxy * sxy / sxx, 0e0) AS sse FROM s)"
_W = f"{_Z}, m AS (SELECT zone, class, count(*) AS k, sum(n * x) / sum(n) AS xm, sum(n * y) / sum(n) AS ym FROM z GROUP BY zone, class HAVING count(*) >= 4), w AS (SELECT z.zone, z.class, sum(n * (x - xm) * (y - ym)) / sum(n * (x - xm) * (x - xm)) AS slope, any_value(xm) AS xm, any_value(ym) AS ym, any_value(k) AS k FROM z JOIN m USING (zone, class) GROUP BY z.zone, z.class)"
_T = ", p AS (SELECT a.zone, a.class, median((b.y - a.y) / (b.x - a.x)) AS slope FROM z a JOIN z b ON a.zone = b.zone AND a.class = b.class AND a.year < b.year GROUP BY a.zone, a.class), h AS (SELECT zone, class, median(y) AS ym, median(year) AS xm, count(*) AS k FROM z GROUP BY zone, class HAVING count(*) >= 4), t AS (SELECT h.zone, h.class, p.slope, h.ym - p.slope * h.xm AS intercept FROM h JOIN p USING (zone, class))"
_L = """, l AS (SELECT a.zone, a.class, a.year AS gone, sum(b.n * b.x) / sum(b.n) AS xm, sum(b.n * b.y) / sum(b.n) AS ym FROM z a JOIN z b ON a.zone = b.zone AND a.class = b.class AND a.year <> b.year GROUP BY a.zone, a.class, a.year),
 o AS (SELECT l.zone, l.class, l.gone, sum(b.n * (b.x - l.xm) * (b.y - l.ym)) / sum(b.n * (b.x - l.xm) * (b.x - l.xm)) AS slope FROM l JOIN z b ON l.zone = b.zone AND l.class = b.class AND l.gone <> b.year GROUP BY l.zone, l.class, l.gone),
 i AS (SELECT zone, class, CAST(gone AS BIGINT) AS most_influential_year FROM (SELECT o.zone, o.class, o.gone, row_number() OVER (PARTITION BY o.zone, o.class ORDER BY round(abs(o.slope - w.slope), 12) DESC, o.gone) AS rn FROM o JOIN w USING (zone, class) WHERE w.k >= 5) WHERE rn = 1)"""
_DF = YEARS - 2
_TVALUE = f"CASE WHEN sse > 1e-14 * syy THEN slope / sqrt(sse / {_DF}e0 / sxx) END"
_PV = " ".join(f"WHEN {k} THEN {p_value_sql('tv', k - 2)}" for k in range(4, YEARS + 1))
_SUP = f"WITH {cells_sql('supplier', False)}, z AS (SELECT zone, year, avg(value) AS value FROM cells GROUP BY zone, year)"
_CH = f"{_SUP}, c AS (SELECT zone, (max(CASE WHEN year = 2001 THEN value END) - max(CASE WHEN year = 1995 THEN value END)) * 100 AS change_pp, regr_slope(value, year - 2000e0) * 100 AS slope_pp FROM z GROUP BY zone HAVING count(value) = {YEARS})"
_TABLE = f"""{_W}{_T}{_L}, s AS (SELECT zone, class, count(*) AS kk, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy FROM z GROUP BY zone, class HAVING count(*) >= 4),
 f AS (SELECT *, sxy / sxx AS slope0, greatest(syy - sxy * sxy / sxx, 0e0) AS sse FROM s), g AS (SELECT *, CASE WHEN sse > 1e-14 * syy THEN slope0 / sqrt(sse / (kk - 2) / sxx) END AS tv FROM f),
 tt AS (SELECT c.zone, c.class, c.n_years, w.slope AS ols_slope, w.ym - w.slope * (w.xm + 2000) AS ols_intercept, 1 - g.sse / nullif(g.syy, 0) AS ols_r2, CASE g.kk {_PV} END AS ols_pvalue, t.slope AS theilsen_slope, t.intercept AS theilsen_intercept,
 abs(w.slope - t.slope) / greatest(abs(t.slope), 1e-6) AS slope_disagreement, i.most_influential_year FROM (SELECT zone, class, count(*) AS n_years FROM z GROUP BY zone, class) c LEFT JOIN w USING (zone, class) LEFT JOIN g USING (zone, class) LEFT JOIN t USING (zone, class) LEFT JOIN i USING (zone, class)),
 trend AS (SELECT *, coalesce(slope_disagreement > 0.5, false) AS flagged FROM tt)"""

QUERIES = {
    "trend_ols": (trend_ols, even_sql(f"{_S} --\nSELECT zone, class, k AS n_years, slope, ym - slope * (xm + 2000) AS intercept, 1 - sse / syy AS r2 FROM f", "zone class n_years", "slope intercept r2")),
    "trend_pvalue": (trend_pvalue, even_sql(f"{_S}, g AS (SELECT zone, class, {_TVALUE} AS tv FROM f WHERE k = {YEARS}) --\nSELECT zone, class, tv AS t, {p_value_sql('tv', _DF)} AS p FROM g", "zone class", "t p", digits=6)),
    "trend_weighted": (trend_weighted, even_sql(f"{_W} --\nSELECT zone, class, slope, ym - slope * (xm + 2000) AS intercept FROM w", "zone class", "slope intercept")),
    "theil_sen": (theil_sen, even_sql(f"{_Z}{_T} --\nSELECT * FROM t", "zone class", "slope intercept")),
    "influential_year": (influential_year, even_sql(f"{_W}{_L} --\nSELECT * FROM i", "zone class most_influential_year")),
    "trend_table": (trend_table, even_sql(f"{_TABLE} --\nSELECT * FROM trend", "zone class n_years most_influential_year", "ols_slope ols_intercept ols_r2 ols_pvalue theilsen_slope theilsen_intercept slope_disagreement", "flagged", digits=5)),
    "trend_flags": (trend_flags, even_sql(f"{_TABLE} --\nSELECT * FROM trend", "zone class n_years", "", "flagged")),
    "flagged_report": (flagged_report, even_sql(f"{_TABLE} --\nSELECT * FROM trend WHERE flagged ORDER BY slope_disagreement DESC LIMIT 20", "zone class", "slope_disagreement", digits=4)),
    "cell_change": (cell_change, even_sql(f"{_CH} --\nSELECT * FROM c", "zone", "change_pp")),
    "cell_slope": (cell_slope, even_sql(f"{_CH} --\nSELECT * FROM c", "zone", "slope_pp")),
    "trend_line": (trend_line, even_sql(f"{_SUP}, m AS (SELECT zone, avg(value) AS ym, avg(year) AS xm, regr_slope(value, year - 2000e0) AS m FROM z GROUP BY zone HAVING count(value) >= 4) --\nSELECT zone, year, (ym + m * (year - xm)) * 100 AS line_pp FROM z JOIN m USING (zone)", "zone year", "line_pp")),
}
