"""Zone comparisons: one reading of the facts, the colours of missing values, tips, and the order of exports."""

import pytest

from zonalspark import plans
from zonalspark.functions import colour
from zonalspark.operators import compare

FOLDER = "/root/testdata/sf0.001"
ZY = "zone int, region int, year int, bucket string, value double, share double"
ONCE = [
    "choropleth_fills", "zone_tips", "region_median_excl_self", "region_comparison", "leaderboard_level", "leaderboard_change", "leaderboard_region", "leaderboard_titles",
    "region_ranking", "rank_region_nation", "trend_line", "composite_index", "bucket_shares", "export_levels", "export_change", "export_trend", "bucket_domain", "change_range_m",
]


@pytest.mark.parametrize("name", ONCE)
def test_facts_are_read_once(spark, name):
    plan = plans.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "l_suppkey" in line for line in plan.splitlines()) == 1


def zone_years(spark):
    rows = []
    for zone in (1, 2, 3):
        for year in (2000, 2001, 2002):
            if (zone, year) == (3, 2002):
                continue
            rows += [(zone, zone % 2, year, "I", None if (zone, year) == (2, 2002) else 0.4 + 0.1 * zone + 0.02 * (year - 2000), None)]
            rows += [(zone, zone % 2, year, b, None if b == "U" else 0.3 + 0.1 * zone + 0.01 * k, 0.25) for k, b in enumerate("FAGU")]
    return spark.createDataFrame(rows, ZY)


def test_fills_of_fixed_and_padded_domains_and_of_missing_values(spark):
    got = {r["zone"]: r for r in compare.fills(zone_years(spark), 2002, 2000, 2002).collect()}
    # the composite's ends are 0.35 and 0.75 whatever the values: 0.54 is at 0.475 of the way, 0.95 of it to yellow
    first = [int(a + (b - a) * 0.95 + 0.5) for a, b in zip(colour.channels("#b23a2e"), colour.channels("#e8c547"))]
    assert got[1]["I_level"] == "#" + "".join(f"{x:02x}" for x in first)
    assert got[2]["I_level"] == "#cccccc" and got[3]["I_level"] == "#e2e7e4"  # a year without a value, and no such year
    assert got[1]["U_level"] == got[3]["F_level"] == got[3]["I_change"] == got[2]["I_change"] == "#e2e7e4"
    # changes: half a range of 0.05, as no zone moves by more than 0.04; bucket F stays as it is
    assert got[1]["F_change"] == "#ffffff" and got[1]["I_change"] != "#326ea8"
    assert got[3]["dominant"] == "#e2e7e4" and got[1]["dominant"] == colour.BUCKET_COLOURS["F"]
    narrow = {r["zone"]: r for r in compare.fills(zone_years(spark), 2002, 2001, 2002).collect()}
    wide = (0.04 / 0.05 + 1) / 2, (0.02 / 0.05 + 1) / 2
    assert [got[1]["I_change"], narrow[1]["I_change"]] == [r[0] for r in spark.range(1).select(*(colour.to_hex(colour.change_colour(compare.F.lit(t))).alias(f"t{i}") for i, t in enumerate(wide))).toPandas().map(str.lower).T.values.tolist()]


def test_tips(spark):
    names = spark.createDataFrame([(1, "Aa"), (2, "Bb"), (3, "Cc")], "zone int, name string")
    got = {r["zone"]: r for r in compare.tips(zone_years(spark), names, 2001, 2000, 2001).collect()}
    assert got[1]["I_level"] == "Aa\nIEI 2001: 52%" and got[1]["F_level"] == "Aa\nIEI (Forest) 2001: 40%\nRegional median: 60%"
    assert got[2]["F_level"].endswith("Regional median: n/a") and got[1]["U_level"] == "Aa\nIEI (Urban Areas) 2001: n/a\nRegional median: n/a"
    assert got[1]["dominant"] == "Aa\nDominant class: Forest (25% share of area)"
    assert got[1]["I_change"].startswith("Aa\nIEI 2000→2001: ▲ +2.0") and got[1]["F_change"].startswith("Aa\nIEI (Forest) 2000→2001: → 0.0")


def test_exports_have_every_zone_and_year_in_the_order_of_numbers(spark):
    zones = spark.createDataFrame([(z, f"n{z}", z % 2) for z in (10, 2, 1, 3)], "zone int, name string, region int")
    levels = compare.export_levels(zone_years(spark), zones).collect()
    assert [(r["zone"], r["year"]) for r in levels] == [(z, y) for z in (1, 2, 3, 10) for y in (2000, 2001, 2002)]
    assert levels[-1]["I_pct"] is None and levels[8]["F_pct"] is None and levels[1]["I_pct"] == 52.0
    change = compare.export_change(zone_years(spark), zones, 2000, 2001).collect()
    assert [r["zone"] for r in change] == [1, 2, 3, 10] and change[0]["I_change_pp"] == 2.0 and change[3]["I_change_pp"] is None
    slopes = spark.createDataFrame([(1, "I", 0.0123456), (3, "F", -0.00001)], "zone int, bucket string, slope double")
    trend = compare.export_trend(slopes, zones).collect()
    assert [(r["zone"], r["region"], r["I_slope_pp_per_year"]) for r in trend] == [(1, 1, 1.235), (2, 0, None), (3, 1, None), (10, 0, None)]


def test_middle_values_against_all_others(spark):
    import random
    from statistics import median

    rng = random.Random(3)
    rows = [(z, rng.randrange(6), rng.choice([None, 1.0, 2.0, rng.random()])) for z in range(120)] + [(500, 77, 1.0), (501, 78, None)]
    got = {r["zone"]: r["median_others"] for r in compare.region_median_of_others(spark.createDataFrame(rows, "zone int, region int, value double")).collect()}
    for z, region, _ in rows:
        others = [v for k, r, v in rows if r == region and k != z and v is not None]
        assert got[z] == (pytest.approx(median(others)) if others else None)
