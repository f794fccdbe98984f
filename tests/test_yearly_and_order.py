import random

import pytest
from pyspark.sql import functions as F

from zonalspark.operators import order
from zonalspark.sources import yearly


def test_only_missing_and_changed_years_are_read(spark, tmp_path):
    def put(year, name, values):
        (tmp_path / f"in_{year}").mkdir(exist_ok=True)
        (tmp_path / f"in_{year}" / name).write_text("v\n" + "\n".join(map(str, values)) + "\n")

    for year in (2020, 2021, 2022):
        put(year, "a.csv", [year, 1])
    inputs = {y: [str(tmp_path / f"in_{y}")] for y in (2020, 2021, 2022)}
    target, read = str(tmp_path / "out"), []

    def compute(year, paths):
        read.append(year)
        return spark.read.option("header", True).csv(paths).agg(F.sum("v").alias("s"))

    def sums():
        return {r["year"]: r["s"] for r in spark.read.parquet(target).collect()}

    assert yearly.write_years(spark, inputs, compute, target) == [2020, 2021, 2022] == read
    assert yearly.write_years(spark, inputs, compute, target) == [] and len(read) == 3
    put(2021, "b.csv", [10])
    inputs[2023] = [str(tmp_path / "in_2023")]
    put(2023, "a.csv", [5])
    assert yearly.write_years(spark, inputs, compute, target) == [2021, 2023]
    assert sums() == {2020: 2021.0, 2021: 2032.0, 2022: 2023.0, 2023: 5.0}
    del inputs[2020]
    assert yearly.write_years(spark, inputs, compute, target) == [] and 2020 in sums()
    assert yearly.write_years(spark, inputs, compute, target, force=True) == [2021, 2022, 2023]


def test_a_year_that_breaks_off_is_not_done(spark, tmp_path):
    (tmp_path / "x.csv").write_text("v\n1\n")
    inputs = {2020: [str(tmp_path / "x.csv")], 2021: [str(tmp_path / "x.csv")]}

    def compute(year, paths):
        df = spark.read.option("header", True).csv(paths)
        return df.withColumn("v", F.raise_error(F.lit("stop"))) if year == 2021 else df

    target = str(tmp_path / "out")
    with pytest.raises(Exception, match="stop"):
        yearly.write_years(spark, inputs, compute, target)
    assert set(yearly.done_years(spark, target)) == {2020}
    assert yearly.write_years(spark, inputs, lambda y, p: spark.read.option("header", True).csv(p), target) == [2021]
    assert yearly.done_years(spark, str(tmp_path / "none")) == {}


def test_ranks_of_all_rows_without_one_partition(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.randrange(40), 7]), rng.choice("ab")) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, v int, k string")
    out = order.ranked(df, F.desc_nulls_last("v"), "k", partitions=9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan  # ranks were written; only offsets are added
    got = sorted(out.collect(), key=lambda r: r["place"])
    assert [r["place"] for r in got] == list(range(1, 701)) and {r["total"] for r in got} == {700}
    keys = [(-(r["v"] if r["v"] is not None else -1), r["k"]) for r in got]
    assert keys == sorted(keys)
    for r, key in zip(got, keys):
        assert r["rank"] == 1 + sum(k < key for k in keys) and r["dense"] == len({k for k in keys if k <= key})
    assert order.ranked(df.limit(0), "v").count() == 0
