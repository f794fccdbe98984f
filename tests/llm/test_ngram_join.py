import random

from zonalspark.llm import decontaminate as dc
from zonalspark.llm import graph
from zonalspark.llm import ngram_join as nj


def grams(text, n=5):
    words = dc.item_words(text)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_force(rows, threshold=0.8):
    sequences = {}
    for key, text in rows:
        sequences.setdefault(tuple(dc.item_words(text)), []).append(key)
    nodes = [s for s in sequences if s]
    sets = {s: grams(b" ".join(s).decode()) for s in nodes}
    links = {s: [t for t in nodes if t != s and len(sets[s] & sets[t]) >= threshold * len(sets[s] | sets[t]) - 1e-9] for s in nodes}
    label = {}
    for s in nodes:
        if s not in label:
            seen, todo = {s}, [s]
            while todo:
                for t in links[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            least = min(k for t in seen for k in sequences[t])
            label |= dict.fromkeys(seen, least)
    out = []
    for key, text in rows:
        s = tuple(dc.item_words(text))
        out.append((key, label[s] if s else key, len(links[s]) if s else 0))
    return sorted(out)


def corpus(n=140, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    rows, texts = [], []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            text = rng.choice(texts[:12]).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice([2, 5, 40, 100, 300])))
        texts.append(text)
    texts += [None, "", "...", "one two", "One, two!", "long " * 20_000]
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (512, 7):
        assert sorted(map(tuple, nj.report(docs, block=block).collect())) == brute_force(rows)
    kept = {r["doc_id"] for r in nj.one_of_each(docs).collect()}
    assert kept == {c for _, c, _ in brute_force(rows)}


def test_chained_buckets_and_near_copies_are_split(spark, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6))) for _ in range(300)]
    chain = [rng.choice(words) for _ in range(800)]
    texts = [" ".join(chain[i : i + 60]) for i in range(600)]  # each like the next, the ends unlike
    base = [rng.choice(words) for _ in range(300)]
    for _ in range(40):
        base[rng.randrange(300)] = rng.choice(words)
        texts.append(" ".join(base))
    rows = [(None if i % 3 == 0 else i % 50, t) for i, t in enumerate(texts)]  # ids repeat and miss
    want = brute_force([(-1 if i is None else i, t) for i, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    split = set()
    groups = nj._groups

    def watched(nodes, block):
        out = groups(nodes, block)
        split.update(r["band"] >= 0 for r in out.select("band").distinct().collect())  # its tables go when the links are there
        return out

    monkeypatch.setattr(nj, "_groups", watched)
    got = nj.report(docs, block=16, recall=0.9999)
    assert sorted((-1 if a is None else a, -1 if b is None else b, c) for a, b, c in map(tuple, got.collect())) == want
    assert split == {True, False}


def test_repeated_rows_extra_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "k"), (1, "a b c d e f", "k"), (1, "z", "k"), (None, "q r", "k"), (5, None, "k"), (5, None, "k")], "doc_id long, text string, node string")
    out = nj.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == [(0, "q r"), (1, "a b c d e f"), (1, "z"), (5, ""), (5, "")]
    assert nj.report(docs).count() == 6
    assert nj.report(docs.limit(0)).count() == 0 and nj.one_of_each(docs.limit(0)).count() == 0


def test_banding_reaches_its_recall():
    bands, rows = nj.bands_for(0.8, 0.995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.995 and bands * rows <= nj.MOST


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 103: 100}
