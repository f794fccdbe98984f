"""Intermediate tables: after an operator only those are left that its result reads."""

import os
import random
import uuid

import public_tokenizers
import pytest

from zonalspark.llm import _text, ngram_join, packing, suffix_dedup


def texts(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(40)]
    rows = [(i, base[i % 40] + (f" end{i}" if i % 3 else "")) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def left(folder):
    return {d for d in os.listdir(folder) if os.path.isdir(f"{folder}/{d}")}


def read(df):
    return {f.removeprefix("file://").removeprefix("file:").rsplit("/", 2)[-2] for f in df.inputFiles()}


@pytest.mark.parametrize("run", [
    lambda docs: ngram_join.report(docs, block=16), ngram_join.one_of_each, suffix_dedup.report, lambda docs: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")),
])
def test_only_what_the_result_reads_is_left(spark, tmp_path, run, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 5)  # hot seeds, so that their tables are made too
    monkeypatch.setattr(_text, "shared_folder", lambda spark, kind: f"file://{tmp_path}/{kind}-{uuid.uuid4().hex}")
    out = run(texts(spark))
    n = out.count()
    there = left(tmp_path)
    assert there and there <= read(out) and n > 0
    assert out.count() == n  # and the result can be read again
    assert _text._OPEN == []


def test_tables_go_when_an_operator_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(_text, "shared_folder", lambda spark, kind: f"file://{tmp_path}/{kind}-{uuid.uuid4().hex}")
    with pytest.raises(ZeroDivisionError), _text.scratch():
        _text.written(spark.range(3), "some")
        raise ZeroDivisionError
    assert left(tmp_path) == set()
    with _text.scratch() as outer:
        with _text.scratch() as keep:
            one, two = keep(_text.written(spark.range(3), "one")), _text.written(spark.range(3), "two")
        assert one.count() == 3 and len(left(tmp_path)) == 1 and two is not one
        outer(one)
    assert one.count() == 3
