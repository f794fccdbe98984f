import glob
import random
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from zonalspark.llm import hilbert_shards as hs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_takes_every_cell_by_single_steps(spark, dims, bits):
    side = 1 << bits
    df = spark.range(side**dims).select(*(hs.F.expr(f"cast(id div {side**i} % {side} as int)").alias(f"x{i}") for i in range(dims)))
    rows = df.select(*df.columns, hs.F.expr(hs.curve(df.columns, bits)).alias("h")).collect()
    path = [tuple(r)[:dims] for r in sorted(rows, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in rows) == list(range(side**dims))
    assert path[0] == (0,) * dims
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def docs_of(rng, n):
    out = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), f"src{min(19, int(rng.expovariate(0.2)))}"
        text = rng.choice([None, "", "é" * rng.randrange(300), "w " * int(10 ** (4 * rng.random()))])
        out.append((i, text, lang, source, len(text or "")))
    return out + [(n, "same", "en", "src0", 4)] * 700 + [(None, None, None, None, None), (n + 1, "ü" * 500_000, "fr", "", 500_000)]


@pytest.mark.parametrize("n", [0, 5, 1500])
def test_places(spark, monkeypatch, n):
    monkeypatch.setattr(hs, "PARTS", 64)
    rows = docs_of(random.Random(n), n) if n else [(i, "t", "en", "s", 1) for i in range(5)]
    got = [r.asDict() for r in hs.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    counts = [sum(r["shard"] == k for r in got) for k in range(24)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for k in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(counts[k]))
    assert {(r["law"], r["grown_shard"]) for r in got} <= {("rows", None)}


def test_order_and_cells(spark, monkeypatch):
    monkeypatch.setattr(hs, "PARTS", 16)
    rows = docs_of(random.Random(7), 900)
    got = [r.asDict() for r in hs.placed(spark.createDataFrame(rows, SCHEMA)).collect()]
    got.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(len(rows)))
    assert [r["curve"] for r in got] == sorted(r["curve"] for r in got)
    assert [(r["shard"], r["slot"]) for r in got] == sorted((r["shard"], r["slot"]) for r in got)
    # rows that share a bin of every dimension share a cell of the curve
    by = {}
    for r in got:
        by.setdefault((r["lang"], r["source"], r["n_chars"]), set()).add(r["curve"])
    assert all(len(x) == 1 for x in by.values()) and len({x for s in by.values() for x in s}) > 50


def test_cells_of_a_histogram():
    flat = hs.cells_of({b: 10 for b in range(hs.FINE + 1)}, 6)
    assert flat == sorted(flat) and set(flat) == set(range(64))
    hot = hs.cells_of({0: 1, 7: 1000, 4000: 1}, 3)
    assert hot[0] == 0 and hot[7] in (3, 4) and hot[4000] == 7
    assert set(hs.cells_of({}, 6)) == {0}


def test_dimensions_of_every_kind(spark):
    sql = """select id, array(-1e308D, double('nan'), double('infinity'), 1e308D, -0.5D, null)[id % 6] as d, id % 2 = 0 as b, date_add(date'2020-01-01', cast(id as int)) as day,
      timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int)) as t, timestamp_ntz'1960-01-01 00:00:00' as z, cast(id as decimal(20, 3)) as n, 'x' as shard, array(1) as a from range(100)"""
    df = spark.sql(sql)
    for dims in (("d",), ("b", "day"), ("t", "z", "n"), ("shard", "id")):
        got = hs.placed(df, dimensions=dims, bits=4)
        assert got.count() == 100 and got.columns.count("shard") == 1
    by_day = sorted(hs.placed(df, dimensions=("day",), bits=5).collect(), key=lambda r: r["rank"])
    assert [r["curve"] for r in by_day] == sorted(r["curve"] for r in by_day) and [r["day"] for r in by_day[:3]] != [r["day"] for r in by_day[-3:]]
    assert max(r["day"] for r in by_day if r["shard"] == 0) < min(r["day"] for r in by_day if r["shard"] == 20)
    with pytest.raises(ValueError):
        hs.placed(df, dimensions=("a",))
    with pytest.raises(ValueError):
        hs.placed(df, dimensions=("id", "n", "d"), bits=7)


def test_files_are_left_unread_by_a_filter_on_any_dimension(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, "t", f"l{rng.randrange(8)}", f"s{rng.randrange(8)}", rng.randrange(10_000)) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    hs.write(df, str(tmp_path / "h"), files=2)
    files = glob.glob(f"{tmp_path}/h/shard=*/*.parquet")
    assert 40 <= len(files) <= 50 and spark.read.parquet(str(tmp_path / "h")).count() == 6000

    def read(test):
        left = 0
        for f in files:
            columns = {c["path_in_schema"]: c["statistics"] for c in pq.read_metadata(f).row_group(0).to_dict()["columns"]}
            left += test({k: (s["min"], s["max"]) for k, s in columns.items() if s})
        return left / len(files)

    assert read(lambda s: s["lang"][0] <= "l3" <= s["lang"][1]) < 0.5
    assert read(lambda s: s["source"][0] <= "s3" <= s["source"][1]) < 0.5
    assert read(lambda s: s["n_chars"][0] <= 5000 <= s["n_chars"][1]) < 0.5
    assert read(lambda s: s["n_chars"][0] <= 5000 <= s["n_chars"][1] and s["lang"][0] <= "l3" <= s["lang"][1] and s["source"][0] <= "s3" <= s["source"][1]) < 0.1


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = hs.report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
