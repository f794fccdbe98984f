import random
import zlib

import numpy as np

from zonalspark.llm import toxicity as tx


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        sentences = [[rng.choice(words) for _ in range(rng.randrange(3, 12))] for _ in range(rng.randrange(1, 15))]
        bad = rng.random() < 0.25
        if bad:
            at = rng.choice(sentences)
            at.insert(rng.randrange(len(at)), rng.choice(["Grumble", "zzwort" + rng.choice(words)]))
        rows.append((i, ". ".join(" ".join(s) for s in sentences), int(bad)))
    return rows


def test_held_out_accuracy_and_location(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in tx.report(docs, labels).collect()}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    held = [(out[i], t, y) for i, t, y in rows if out[i]["held_out"]]
    right = sum(r["predicted"] == y for r, _, y in held) / len(held)
    assert right > 0.95
    located = [any(w in t.encode()[s["start"] : s["end"]].decode() for w in ("Grumble", "zzwort")) for r, t, y in held if y for s in r["offending"]]
    assert located and np.mean(located) > 0.9
    kept = {r["doc_id"] for r in tx.remove_toxic(docs, labels).collect()}
    assert kept == {i for i, r in out.items() if r["score"] < tx.THRESHOLD}


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (None, "..!", 5.0), (3, "a" * 5000 + " b" * 9000, 5.0), (3, "x", 5.0), (3, "x", 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0)], "doc_id long, toxic int")
    got = tx.report(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["score"] for r in got if r["doc_id"] in (1, 2)] == [0, 0]
    assert tx.remove_toxic(docs, labels).columns == docs.columns
    assert tx.report(docs.limit(0), labels).count() == 0
    assert tx.report(docs, labels.limit(0)).count() == 6


def plain_features(text):
    """Sentences of the text as lists of words, read one character at a time."""
    sentences, words, word = [], [], ""
    for c in text + ".":
        if c.isalnum() or ord(c) > 127:
            word += c
            continue
        if word:
            words.append(word)
            word = ""
        if c in "\n\r!.?" and words:
            sentences.append(words)
            words = []
    return sentences


def test_sentences_and_scores_against_a_plain_reading(spark):
    rows = [(i, t) for i, t, _ in corpus(60, 3)] + [(100, "One. two!three?\nfour  Émile é. x"), (101, "..."), (102, "a" * 3000 + ". b")]
    rng = np.random.RandomState(1)
    model = tx.Model(rng.normal(0, 0.4, 1 << tx.BITS).astype(np.float32), -2.0)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in tx.score(docs, model).collect()}
    for i, text in rows:
        none = 1.0
        for words in plain_features(text):
            z = model.bias
            for w in words:
                raw = w.encode()
                numbers, *_ = tx.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                assert len(numbers) == 1
                z += float(model.weights[numbers[0]].sum())
            none *= 1 - 1 / (1 + np.exp(-z))
        assert abs(got[i] - (1 - none)) < 1e-5


def test_telling_features_against_sets():
    rows = corpus(300, 5)
    own = [(set(np.unique(tx.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]).tolist()), y) for _, t, y in rows]
    n1, n0 = sum(y for _, y in own), sum(1 - y for _, y in own)
    ones, zeros = np.zeros(1 << tx.BITS), np.zeros(1 << tx.BITS)
    for _, t, y in rows:
        raw = t.encode()
        _, feature = tx._presence(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        (ones if y else zeros)[feature] += 1
    got = set(np.flatnonzero(tx._telling(ones, zeros, n1, n0, 15.0)).tolist())
    want = set()
    for f in set().union(*(s for s, _ in own)):
        a, b = sum(f in s and y for s, y in own), sum(f in s and not y for s, y in own)
        cells = [(a, n1, (a + b) / (n1 + n0)), (n1 - a, n1, 1 - (a + b) / (n1 + n0)), (b, n0, (a + b) / (n1 + n0)), (n0 - b, n0, 1 - (a + b) / (n1 + n0))]
        if 2 * sum(k * np.log(k / n / r) for k, n, r in cells if k) >= 15 and a / n1 > b / n0:
            want.add(f)
    assert got == want and want


def test_very_long_labelled_texts_and_repeats(spark):
    rows = corpus(300, 7) + [(9000, "plain words. " * 40_000, 0), (9001, "plain words. " * 20_000 + "Grumble here.", 1)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2]] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(rows[0][0], 1 - rows[0][2])], "doc_id long, toxic int")
    model = tx.fit(tx.training_rows(docs, labels))
    again = tx.fit(tx.training_rows(docs.repartition(7), labels))
    assert (model.weights == again.weights).all() and model.bias == again.bias and (model.weights != 0).any()
