"""Operator 4: toxicity by multiple-instance learning.

A sentence's score is a logistic function of the weights of its words; a
document's score is the noisy-or of its sentences, 1 - prod(1 - p). Only
documents have labels: the gradient of the document loss shares the blame among
the sentences, and the trained sentence scores then tell where the offence is.

A word's features are its hash and those of its beginnings and endings, so that
unseen forms of a seen stem count. Nothing but the text is ever an input.

The model is fit on a bounded sample of labelled rows (``max_rows`` documents of
each label, chosen by a hash of the id); scoring covers every whole text. Null and
empty texts have no sentence and score 0. Without labels of both kinds, or without
a telling word, every score is that of the untrained model. Repeated rows each get
a row; a document with several labels, or several rows, is a training row for each.
A text of any length is scored whole, in its task. No documents give no rows. A
score of exactly the threshold counts as toxic. Extra columns stay, but for those
named as the results of ``score``; ``remove_toxic`` keeps all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import U64, WORD, Hashes, forget, runs, slices, written

BITS = 20
PREFIXES = (3, 4, 5, 6, 7)
SUFFIXES = (4, 5)
#: Labelled documents of each label that the model is fit on, at most.
MAX_ROWS = 2000
THRESHOLD = 0.3
_END = np.zeros(256, bool)
_END[[10, 13, 33, 46, 63]] = True  # line ends ! . ?


def features(data: np.ndarray, offsets: np.ndarray):
    """(feature numbers by word, sentence of each word, document of each sentence, sentence spans) of a slice."""
    starts, ends = runs(WORD[data], offsets)
    hashes, n = Hashes(data, fold=True), len(starts)
    columns = [hashes.of(starts, ends)]
    size = ends - starts
    for k in PREFIXES:  # a shorter word has its beginning once more: the salt keeps it apart
        columns.append(hashes.of(starts, starts + np.minimum(size, k)) * U64(2 * k + 1))
    for k in SUFFIXES:
        columns.append(hashes.of(ends - np.minimum(size, k), ends) * U64(2 * k + 101))
    numbers = (np.stack(columns, 1) >> U64(64 - BITS)).astype(np.int32) if n else np.zeros((0, 1 + len(PREFIXES) + len(SUFFIXES)), np.int32)
    # a new sentence begins at the first word of a text and at the first after an end mark
    marks = np.flatnonzero(_END[data])
    document = np.searchsorted(offsets, starts, "right") - 1
    passed = np.searchsorted(marks, starts)
    new = np.ones(n, bool)
    new[1:] = (document[1:] != document[:-1]) | (passed[1:] != passed[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    spans = np.stack((starts[first], ends[last]), 1) if n else np.zeros((0, 2), np.int64)
    return numbers, np.cumsum(new) - 1, document[first], spans


@dataclass
class Model:
    """weights of hashed features, and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def sentences(self, numbers: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        z = np.bincount(sentence, self.weights[numbers].sum(1), n) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, document: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), n))


def _presence(data: np.ndarray, offsets: np.ndarray):
    """(document, feature) of a slice: each feature once for each document that has it."""
    numbers, sentence, document, _ = features(data, offsets)
    owner = document[sentence] if len(sentence) else np.zeros(0, np.int64)
    both = np.unique((owner[:, None] << BITS | numbers).ravel())
    return both >> BITS, (both & ((1 << BITS) - 1)).astype(np.int64)


def _telling(ones, zeros, n1, n0, evidence: float, log=np.log, where=np.where):
    """Whether documents of label 1 have a feature more often: a log-likelihood ratio of evidence or more."""
    rate = (ones + zeros) / (n1 + n0)
    gain = sum(where(k > 0, k * log(where(k > 0, k, 1.0) / n / where(k > 0, r, 1.0)), 0.0) for k, n, r in ((ones, n1, rate), (n1 - ones, n1, 1 - rate), (zeros, n0, rate), (n0 - zeros, n0, 1 - rate)))
    return (2 * gain >= evidence) & (ones / n1 > zeros / n0)


def _busy(data: np.ndarray, offsets: np.ndarray, used: np.ndarray):
    """(sentences of each document, document, sentence in it, features as places in used) of the words with a telling feature.

    All other features are one more place, whose weight stays 0.
    """
    numbers, sentence, document, _ = features(data, offsets)
    place = np.full(1 << BITS, len(used), np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    compact = place[numbers]
    rows = np.flatnonzero((compact < len(used)).any(axis=1))
    sizes = np.bincount(document, minlength=len(offsets) - 1)
    firsts = np.cumsum(sizes) - sizes
    owner = document[sentence[rows]]
    return sizes, owner, sentence[rows] - firsts[owner], compact[rows]


def _descend(y: np.ndarray, sizes: np.ndarray, sentence: np.ndarray, compact: np.ndarray, used: np.ndarray, rounds: int, rate: float, decay: float, clean: float) -> Model:
    """Adam on the loss of the document labels; label 0 has ``clean`` of the weight."""
    weights, bias = np.zeros(1 << BITS, np.float32), -5.0
    document = np.repeat(np.arange(len(y)), sizes)
    compact, word = np.unique(compact, axis=0, return_inverse=True)
    word = word.reshape(-1)
    w, m, v = (np.zeros(len(used) + 1) for _ in range(3))
    b_m = b_v = 0.0
    share = np.where(y == 1, (1 - clean) / y.sum(), clean / (len(y) - y.sum()))
    n_sentences = len(document)
    for step in range(1, rounds + 1):
        z = np.bincount(sentence, w[compact].sum(1)[word], n_sentences) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        whole = np.clip(noisy_or(p, document, len(y)), 1e-9, 1)
        pull = np.where(y == 1, -(1 - whole) / whole, 1.0) * share
        dz = pull[document] * p
        by_type = np.bincount(word, dz[sentence], len(compact))
        g = np.bincount(compact.ravel(), np.repeat(by_type, compact.shape[1]), len(used) + 1) + decay * w
        g[-1] = 0
        g_b = dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        b_m, b_v = 0.9 * b_m + 0.1 * g_b, 0.99 * b_v + 0.01 * g_b * g_b
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        bias -= rate * (b_m / c1) / (np.sqrt(b_v / c2) + 1e-8)
    weights[used] = w[:-1]
    return Model(weights, float(bias))


def _untrained() -> Model:
    return Model(np.zeros(1 << BITS, np.float32), -5.0)


def training_rows(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(id, text, y): at most max_rows labelled documents of each label, from rows whose crc32 of the id is not held out.

    A hash of the id decides who is in: the same rows on every run.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and id is not null").filter(~held_out(F.col("id")))
    few = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_rows) for y in (0, 1)]
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(few[0].union(few[1])), "id").select("id", "text", "y")


def fit(rows: DataFrame, *, rounds: int = 150, rate: float = 0.05, decay: float = 3e-5, evidence: float = 15.0, clean: float = 0.8) -> Model:
    """The model of labelled rows (id, text, y).

    Only features that documents of label 1 have significantly more often get a
    weight; the many that occur once or twice would only be learnt by heart. Texts
    stay in their tasks: these count the features, and then send the few words that
    have a telling one. The descent over these is on the driver.
    """
    rows = written(rows, "labelled")
    totals = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(totals) != {0, 1}:
        forget(rows)
        return _untrained()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for first, _, data, offsets in slices(batch.column(0)):
                document, feature = _presence(data, offsets)
                np.add.at(found, (y[first + document], feature), 1)
        used = np.flatnonzero(found.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(found[1, used]), pa.array(found[0, used])], names=["feature", "ones", "zeros"])

    counts = rows.select("text", "y").mapInArrow(count, "feature int, ones long, zeros long").groupBy("feature").agg(F.sum("ones").cast("double").alias("ones"), F.sum("zeros").cast("double").alias("zeros"))
    telling = _telling(F.col("ones"), F.col("zeros"), float(totals[1]), float(totals[0]), evidence, F.log, lambda c, a, b: F.when(c, a).otherwise(b))
    used = np.array(sorted(r[0] for r in counts.filter(telling).select("feature").collect()), np.int64)
    if not len(used):
        forget(rows)
        return _untrained()

    def busy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for first, last, data, offsets in slices(batch.column(0)):
                sizes, owner, sentence, compact = _busy(data, offsets, used)
                cuts = np.searchsorted(owner, np.arange(last - first + 1))
                for d in range(last - first):
                    a, b = cuts[d], cuts[d + 1]
                    out.append((int(sizes[d]), sentence[a:b].astype(np.int32).tobytes(), compact[a:b].tobytes()))
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *columns], names=["id", "y", "sentences", "sentence", "features"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("text", "id", "y").mapInArrow(busy, f"id {kind}, y int, sentences int, sentence binary, features binary")
    y, sizes, sentences, parts, before = [], [], [], [], 0
    for r in found.orderBy("id", "y", "sentences", "sentence", "features").toLocalIterator():
        y.append(r["y"])
        sizes.append(r["sentences"])
        sentences.append(np.frombuffer(r["sentence"], np.int32).astype(np.int64) + before)
        parts.append(np.frombuffer(r["features"], np.int32).reshape(-1, 1 + len(PREFIXES) + len(SUFFIXES)))
        before += r["sentences"]
    forget(rows)
    return _descend(np.array(y, float), np.array(sizes), np.concatenate(sentences), np.concatenate(parts), used, rounds, rate, decay, clean)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def score(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD, spans: bool = True) -> DataFrame:
    """docs with score, predicted and offending (sentences with a score of threshold or more, as byte spans)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    kind = "array<struct<start:int,end:int,score:double>>"
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(f"score double, offending {kind}").fields])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores, found = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for a, b, data, offsets in slices(batch.column(batch.schema.get_field_index(text))):
                numbers, sentence, document, where = features(data, offsets)
                p = own.sentences(numbers, sentence, len(document))
                scores[a:b] = noisy_or(p, document, b - a)
                for k in np.flatnonzero(p >= threshold).tolist() if spans else ():
                    base = int(offsets[document[k]])
                    found[a + int(document[k])].append({"start": int(where[k, 0]) - base, "end": int(where[k, 1]) - base, "score": float(p[k])})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(scores, 0, 1)), pa.array(found, arrow)], names=[*batch.schema.names, "score", "offending"])

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending."""
    model = fit(training_rows(docs, labels, max_rows=max_rows))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def remove_toxic(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> DataFrame:
    """docs without those whose score is THRESHOLD or more; all columns stay as they were."""
    model = fit(training_rows(docs, labels, max_rows=max_rows))
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("text"))
    return score(whole, model, spans=False).filter(F.col("score") < THRESHOLD).select("doc.*")
