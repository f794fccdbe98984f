import random

from hypothesis import given, settings
from hypothesis import strategies as st

from zonalspark.llm import decontaminate as dc


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "dé", "The", "x9"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 5, 12, 13, 20, 40]))) for i in range(9)] + [(90, None), (91, ""), (92, "..."), (93, None)]
    docs = [(i, rng.choice([say(30), items[i % 9][1], say(20) + ", " + items[i % 9][1] + "! " + say(rng.randrange(400))])) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "!!"), (502, "!!"), (503, "x " * 5000 + items[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    for extra in (items, [x for x in items if x[1] and len(x[1].split()) >= 12]):
        b = spark.createDataFrame(extra, "item_id long, text string")
        got = sorted(tuple(r)[:6] for r in dc.report(d, b).collect())
        assert got == sorted((i, *dc.brute_force(t, extra)) for i, t in docs)


def test_blocks_merge(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, None)], "doc_id long, text string")
    items = [("1", [b"a", b"b", b"c"]), ("2", [b"c", b"d"]), ("3", [b"g"])]
    one = dc._pass(docs, "text", items, 13).collect()[0]
    two = dc._pass(dc._pass(docs, "text", items[:1], 13).withColumnsRenamed({"__s": "s", "__n": "n", "__i": "i"}), "text", items[1:], 13)
    got = two.select(dc._merged("s", "__s").alias("m")).collect()[0]["m"]
    assert [tuple(x) for x in got] == [tuple(x) for x in one["__s"]] == [(0, 4), (6, 7)]


def test_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "k")], "doc_id long, text string, item_id string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(docs, none).columns == docs.columns
    assert dc.decontaminate(docs, none).count() == 1
    assert dc.report(docs.limit(0), none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab c", max_size=60), min_size=1, max_size=4), st.text("ab c", max_size=120))
def test_automaton(items, text):
    coded = [(str(i), w) for i, x in enumerate(items) if (w := dc.item_words(x))]
    spans, keys = dc.SuffixAutomaton(coded, 4).stream(dc.item_words(text))
    n, hit, n_items, _, _ = dc.brute_force(text, list(enumerate(items)), 4)
    assert (sum(e - s for s, e in spans), len(keys)) == (hit, n_items)


def test_null_and_repeated_item_ids(spark):
    items = [(None, "a b c d e f g h i j k l m n"), (7, "one two three"), (7, "four five"), (None, "six")]
    docs = [(1, "x a b c d e f g h i j k l m one two three"), (2, "four five six"), (3, "none")]
    got = sorted(tuple(r)[:6] for r in dc.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == sorted((i, *dc.brute_force(t, items)) for i, t in docs)
    assert [r[3] for r in got] == [2, 2, 0]


def test_windows_of_two_items_that_share_words(spark):
    a, b = [f"a{i}" for i in range(13)], [f"b{i}" for i in range(13)]
    b[:2] = a[-2:]
    items = [(1, " ".join(a)), (2, " ".join(b))]
    text = " ".join([*a, *b[2:], *(f"x{i}" for i in range(460))])
    got = tuple(dc.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()[0])
    assert got[:6] == (1, *dc.brute_force(text, items)) and got[2] == 24
