import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from zonalspark.llm import packing as pk

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(histogram, limits):
    return sum(min(b for b in limits if b >= length) * rows - tokens for length, rows, tokens in histogram)


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        lengths = rng.sample(range(8, 200, 8), rng.randrange(1, 9))
        histogram = [(x, n := rng.randrange(1, 50), n * (x - rng.randrange(8))) for x in lengths]
        for k in (1, 2, 3, 20):
            got = pk.boundaries(histogram, k)
            ends = [c for n in range(min(k, len(lengths))) for c in itertools.combinations(sorted(lengths)[:-1], n)]
            assert got == sorted(got) and got[-1] == max(lengths) and len(got) <= k
            assert padding(histogram, got) == min(padding(histogram, [*c, max(lengths)]) for c in ends)


def test_boundaries_of_free_lengths():
    rng = random.Random(3)
    for _ in range(20):
        histogram = [(x, n := rng.randrange(1, 50), n * x) for x in rng.sample(range(1, 60), 7)]
        ends = [c for n in range(3) for c in itertools.combinations(sorted(x for x, _, _ in histogram)[:-1], n)]
        assert padding(histogram, pk.boundaries(histogram, 3)) == min(padding(histogram, [*c, max(histogram)[0]]) for c in ends)


def test_packing(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "b,", "é", "Walking"]) for _ in range(rng.choice([3, 10, 10, 40, 500])))) for i in range(300)] + [(900, None), (901, ""), (902, "w " * 10_000), (902, "w " * 10_000), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", pk.F.lit("mine")).withColumn("part", pk.F.lit(1)).repartition(3)
    packed = pk.written(pk.pack(docs, PATH, max_len=256, budget=2048, buckets=4), "packed")
    out = packed.collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids_of = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    want = Counter((i, s // 256, s, tuple(ids_of[i][s : s + 256])) for i, _ in rows for s in range(0, len(ids_of[i]), 256))
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in out) == want
    assert all(len(r["ids"]) == 2 * r["length"] for r in out)
    histogram = Counter()
    for (_, _, _, ids), k in want.items():
        histogram[len(ids)] += k
    limits = pk.boundaries([(n, k, n * k) for n, k in histogram.items()], 4)
    found = defaultdict(list)
    for r in out:
        assert r["padded_length"] == min(b for b in limits if b >= r["length"])
        found[r["bucket"], r["batch"]].append(r["slot"])
    for (bucket, batch), slots in found.items():
        room = max(2048 // limits[bucket], 1)
        full = batch < max(b for k, b in found if k == bucket)
        assert sorted(slots) == list(range(room if full else len(slots))) and len(slots) <= room
    # whole batches decode back to the texts
    texts = defaultdict(list)
    for b in pk.batches(packed).collect():
        ids = np.frombuffer(b["ids"], "<u2").reshape(len(b["doc_ids"]), b["padded_length"])
        assert ids.size <= 2048
        for key, n, own in zip(b["doc_ids"], b["lengths"], ids.tolist()):
            assert not any(own[n:])
            texts[key].append(own[:n])
    for i, t in rows[:300]:
        joined = min((list(itertools.chain(*order)) for order in itertools.permutations(texts[i])), key=lambda x: x != ids_of[i])
        plain = "".join(map(tokenizer.id_to_token, joined[:-1])).replace("</w>", "").encode("latin-1").decode()
        assert joined == ids_of[i] and plain == t.lower().replace(" ", "")
    assert pk.pack(docs.limit(0), PATH).count() == 0
    rounded = pk.pack(docs, PATH, step=64).select("padded_length").distinct().collect()
    assert all(r[0] % 64 == 0 for r in rounded)


def test_many_lengths_take_little_time():
    import time

    rng = random.Random(6)
    histogram = [(x, n := rng.randrange(1, 50), n * x) for x in range(1, 8193)]
    began = time.process_time()
    got = pk.boundaries(histogram, 16)
    assert time.process_time() - began < 6 and len(got) == 16 and got[-1] == 8192
    # no boundary can be moved by one for less padding
    least = padding(histogram[:], got)
    for k in range(15):
        for step in (-1, 1):
            assert padding(histogram, [b + step * (i == k) for i, b in enumerate(got)]) >= least
