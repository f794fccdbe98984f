import hashlib
import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalspark.llm import fill_in_middle as fm

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_force(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    name = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(name[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 50:
        return n, "plain", None, None, text
    low, high = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(rng, n=300):
    words = ["a", "é", "日本語", "x" * 50, "<P", "P>", "<", " ", " ", "\x00", "🙂", "\x1f", "S>", "<S"]
    spaces = [" ", "  ", "\n", "\t\x0b\r\n", ""]
    out = ["".join(rng.choice(spaces) + rng.choice(words) for _ in range(rng.choice([1, 3, 10, 200]))) + rng.choice(["", " ", "\n\n"]) for _ in range(n)]
    return out + ["", " ", "\n \t", "a", " a", "a ", "x <P> y", "<S>", "q<M>", "w " * 20_000, " " * 50_000, "y" * 200_000, ("é" * 700 + "\n") * 300]


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [*enumerate(texts(rng)), (5, None), (5, "again and again"), (5, "again and again"), (-7, "a b c d e f")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, output string").repartition(3)
    got = sorted((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in fm.transform(df).collect())
    want = [(i, *brute_force(i, t)) for i, t in rows]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = sorted((tuple(r) for r in fm.report(df).collect()), key=key)
    assert digests == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows, strict=True)), key=key)
    assert fm.report(df.limit(0)).count() == 0


def test_ids_of_other_kinds(spark):
    df = spark.createDataFrame([("7", "a b c d"), (None, "a b c d"), ("é", "x")], "doc_id string, text string")
    got = {r["doc_id"]: r["n"] for r in fm.report(df).collect()}
    assert got == {"7": 4, None: 4, "é": 1}
    assert fm.numbers("7") == fm.numbers(7) and fm.numbers(None) == fm.numbers("")


def test_every_cut_of_small_and_large_steps():
    rng = random.Random(2)
    for text in texts(rng, 60)[:72]:
        data = np.frombuffer(text.encode(), np.uint8)
        units = UNITS.findall(text)
        for every, chunk in ((1, 3), (4, 7), (256, 1 << 16)):
            index = fm.Checkpoints(data, every, chunk)
            assert index.n == len(units) and index.n_points == len(text)
            assert index.units == list(range(0, len(units) + 1, every))  # a checkpoint every so many, and no more
            for k in {0, 1, len(units) // 2, len(units) - 1, len(units)} & set(range(len(units) + 1)):
                head = "".join(units[:k])
                assert index.cut(k) == (len(head.encode()), len(head))


def test_checkpoints_are_few_and_a_cut_scans_little(monkeypatch):
    data = np.frombuffer(b"word " * 400_000, np.uint8)
    index = fm.Checkpoints(data)
    assert len(index.units) == 400_000 // fm.EVERY + 1
    seen = []
    whole = fm.Checkpoints._ends
    monkeypatch.setattr(fm.Checkpoints, "_ends", lambda self, a, b: seen.append(b - a) or whole(self, a, b))
    assert index.cut(399_999) == (399_999 * 5 - 1, 399_999 * 5 - 1)
    assert sum(seen) <= fm.EVERY * 5 + fm.SCAN


@settings(max_examples=200, deadline=None)
@given(st.integers(), st.text(alphabet="a<>PSM \n\té", max_size=60))
def test_restored_exactly(doc_id, text):
    _, form, _, _, output = fm.rearranged(doc_id, np.frombuffer(text.encode(), np.uint8), rate=100)
    assert fm.restore(output, form).decode() == text


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = fm.report(spark.read.parquet(f"{folder}/documents.parquet"))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({fm.SQL})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 100
