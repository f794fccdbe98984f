import random

import numpy as np
import pytest

from zonalspark.llm import exact_topk as tk

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(tk, "ROWS", 37)
    monkeypatch.setattr(tk, "QUERY_ROWS", 8)
    monkeypatch.setattr(tk, "CANDIDATE_ROWS", 90)
    monkeypatch.setattr(tk, "TILE", 3)
    rng = random.Random(2)
    vectors = [[round(rng.gauss(0, 0.3) * 8) / 8 for _ in range(10)] for _ in range(40)]
    rows = [(i, rng.choice(vectors)) for i in range(400)]
    rows += [(1000, None), (1020, [None] * 10), (1040, [float("nan")] + [0.0] * 9), (1060, [float("inf")] * 10), (1080, [0.0] * 10), (1100, [1.0] * 3), (1101, [1.0] * 3), (None, [0.5] * 10), (1120, []), (1121, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(4)
    assert sorted(tuple(r) for r in tk.report(df).collect()) == tk.brute_force(rows)


def test_large_scores_and_few_rows(spark):
    rows = [(0, [3e7, -3e7]), (1, [2e7, 1.0]), (2, [2e7, 1.0]), (20, [-5.0, 0.25])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in tk.report(df).collect()) == tk.brute_force(rows)
    assert tk.report(df.limit(0)).count() == 0
    assert tk.report(df.filter("vec_id = 0")).count() == 0


@pytest.mark.parametrize("unit", [1.0, 3e3, 3e6])
def test_every_kind_of_number(spark, unit):
    rng = random.Random(5)
    rows = [(i, [unit * rng.gauss(0, 1) for _ in range(7)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in tk.report(df).collect()) == tk.brute_force(rows)


def test_one_vector_and_one_id_for_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(tk, "ROWS", 16)
    rows = [(i, [0.5, 0.25]) for i in range(300)] + [(40, [0.125 * i, 1.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in tk.report(df).collect()) == tk.brute_force(rows)
    again = df.union(spark.createDataFrame([(300, [0.5, 0.25])] * 3, df.schema))  # repeated queries are asked once, repeated candidates rank
    got = [tuple(r) for r in again.transform(tk.report).collect()]
    assert sum(r[0] == 300 for r in got) == 20 and len({r for r in got if r[0] != 40}) == sum(r[0] != 40 for r in got)


def test_bounds_skip_most_scores():
    rng = np.random.RandomState(3)
    centres = rng.randint(-60, 60, (200, 64))
    own = rng.randint(0, 200, 4000)
    vectors = centres[own] + rng.randint(-4, 5, (4000, 64))
    q, c = tk.Vectors(np.arange(50), vectors[:50], 4), tk.Vectors(np.arange(4000), vectors, 4)
    whole = vectors[:50] @ vectors.T
    np.fill_diagonal(whole, -(2**62))
    lists = np.sort(tk.local_lists(q, c, 5), axis=1)[:, -5]
    cutoff = np.sort(whole, axis=1)[:, -5]
    assert (lists <= cutoff).all() and (lists > 0).all()  # safe, and of use
    at_q, at_c, scores, resolved = tk.survivors(q, c, lists)
    want = np.argwhere(whole >= lists[:, None])
    assert sorted(zip(at_q.tolist(), at_c.tolist())) == sorted(map(tuple, want.tolist())) and (scores == whole[at_q, at_c]).all()
    assert resolved < 0.1 * whole.size
    # norms that can't reach cutoff / lists in any list: the block is skipped
    small = tk.Vectors(np.arange(4000), vectors // 40, 4)
    assert tk.survivors(q, small, cutoff)[3] == 0


def test_heavy_stages_have_a_task_for_each_cell(spark):
    df = spark.range(40_000).selectExpr("id as vec_id", "array(sin(id), cos(id * 7), sin(id * id)) as embedding")
    found = tk.report(df)
    assert found.count() == 2000 * 20
    assert tk.groups_for(2000, 40_000, 16) == (1, 16) and tk.groups_for(5 * 10**7, 10**9, 16) == (1526, 3815)
