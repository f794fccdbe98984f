import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalspark.llm import suffix_dedup as sd


def corpus(seed: int, n: int):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    say = lambda k: " ".join(word() for _ in range(k))
    passages = [say(rng.choice([15, 30, 60, 200])) for _ in range(6)]
    texts = []
    for _ in range(n):
        text = " ".join(rng.choice([say(rng.randrange(50)), rng.choice(passages)]) for _ in range(rng.randrange(1, 5)))
        if rng.random() < 0.3 and texts:
            text = rng.choice(texts) or ""
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "X", "éé"]) + text[at:]
        texts.append(text)
    return [*texts, None, "", "a" * 700, "a" * 350, "ab" * 400, "ba" * 150, "q" * 199, "q" * 199, "w" * 200, say(3000)]


def test_against_brute_force(spark):
    texts = corpus(1, 70)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [tuple(r)[1:] for r in sorted(sd.report(docs).collect())]
    assert got == sd.brute_force(texts)


def test_hot_seeds_and_short_strings(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 2)
    texts = corpus(2, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in sorted(sd.report(docs, length=40, seed=12).collect())]
    assert got == sd.brute_force(texts, 40)


def test_repeated_rows_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "x" * 10 + "y" * 300), (1, "x" * 10 + "y" * 300), (None, "z" * 150), (1, "k")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in sd.report(docs).collect())
    assert got == [(0, 150, 0), (1, 1, 0), (1, 310, 310), (1, 310, 310)]
    assert sd.report(docs.limit(0)).count() == 0


def test_a_seed_with_more_stretches_than_one_sort_holds(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", 8)
    rng = random.Random(4)
    letters = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    hot, sides = letters(30), [letters(40) for _ in range(4)]
    texts = [letters(20) + rng.choice(sides)[-rng.randrange(1, 40) :] + hot + rng.choice(sides)[: rng.randrange(1, 40)] + letters(20) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r)[1:] for r in sorted(sd.report(docs, length=60, seed=12).collect())]
    assert got == sd.brute_force(texts, 60) and sum(r[1] for r in got) > 1000


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30), st.integers(1, 30), st.data())
def test_longer_seeds_keep_every_start_once(seed, more, data):
    length, width = seed + more, more
    at = data.draw(st.integers(0, width))
    last = data.draw(st.integers(0, at))  # starts 0..last, each with the seed in it
    context = bytes(i % 251 for i in range(last + length))
    starts = []
    for cut, rest, place, part in sd.longer_seeds(context, at, width, length):
        assert context[cut : cut + len(part)] == part and cut + place in (at, at - (width + 1) // 2)
        own = range(len(part) - length + 1)
        assert all(s <= place and place + length - rest <= s + length for s in own)  # each string holds the longer seed
        starts += [cut + s for s in own]
    assert sorted(starts) == list(range(last + 1))


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=1, max_size=80), st.integers(1, 20))
def test_sorted_suffixes(text, length):
    data = np.frombuffer(text.encode() + bytes(length + 1), np.uint8)
    order, shared = sd.sorted_suffixes(data, np.arange(len(text)), length)
    cut = [bytes(data[i : i + length]) for i in range(len(text))]
    assert [cut[i] for i in order] == sorted(cut)
    for k in range(1, len(order)):
        a, b = cut[order[k - 1]], cut[order[k]]
        assert shared[k] == next((i for i in range(length) if a[i] != b[i]), length)


def test_texts_without_id_and_with_one_32_bit_hash(spark):
    passages = ["".join(chr(97 + (i * i * k) % 23) for i in range(260)) for k in (7, 11)]
    many = spark.range(400_000).selectExpr("id % 2 as side", f"concat(sha2(string(id), 256), if(id % 2 = 0, '{passages[0]}', '{passages[1]}' || ' longer'), 'end') as text")
    pair = many.groupBy(sd.F.hash("text").alias("h")).agg(sd.F.min_by("text", "side").alias("a"), sd.F.max_by("text", "side").alias("b"), sd.F.countDistinct("side").alias("n")).filter("n = 2").orderBy("h").first()
    texts = [pair["a"], pair["b"], *passages]
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (1, texts[2]), (2, texts[3])], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in sd.report(docs).collect()) == sorted(sd.brute_force(texts))
