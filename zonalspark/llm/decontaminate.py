"""Operator 7: benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items form one automaton. Training words
stream through it; the longest match that ends at each word tells which windows
(13 item words, or a shorter item whole) occur. A hash of every few consecutive
words only decides which stretches can hold a window at all; the automaton, on
the words themselves, decides what is hit.

The benchmark goes through the driver, block by block, and is broadcast: it has to
be a table of test items, of some hundred MB at most; each ``MAX_BLOCK_BYTES`` of it
are one automaton and one more operator in the same pass over the documents.

Null or word-less texts have no words and no hits. Repeated rows each get a row.
A text of any length is streamed whole. Items without words are in no document.
A null item_id counts as the empty string; items of one id count once, and hit by
the windows of each. An empty benchmark hits nothing; no documents give no rows.
Extra columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import U64, shingle_hashes, slices, word_hashes

WINDOW = 13
#: Words: ASCII letters and digits and all non-ASCII characters, ASCII capitals folded.
MAX_BLOCK_BYTES = 8 << 20


def item_words(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    _, starts, ends, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    return [data[s:e].lower() for s, e in zip(starts, ends, strict=True)]


class SuffixAutomaton:
    """Generalised suffix automaton over word ids, with the items of each state that is a window's."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.window = window
        self.owners: dict[int, set[str]] = {}
        self.whole: dict[int, list[tuple[int, str]]] = {}
        coded = [(key, [self.ids.setdefault(w, len(self.ids)) for w in words]) for key, words in items]
        for _, word_ids in coded:
            last = 0
            for c in word_ids:
                last = self._extend(last, c)
        for key, word_ids in coded:
            state = 0
            for n, c in enumerate(word_ids, 1):
                state = self._shorten(self.step[state][c])
                if n >= window:
                    self.owners.setdefault(state, set()).add(key)
            if len(word_ids) < window:
                # the shortest state of the suffix chain that still holds the whole item
                while self.length[self.link[state]] >= len(word_ids):
                    state = self.link[state]
                self.whole.setdefault(state, []).append((len(word_ids), key))

    def _shorten(self, state: int) -> int:
        """The state of the last ``window`` words of what state holds, or state if it holds no more."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        state = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = state
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return state

    def _clone(self, p: int, c: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        clone = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words (start, end) inside windows, merged; and the items hit."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = 0
        for at, word in enumerate(words):
            c = self.ids.get(word)
            if c is None:
                state = matched = 0
                continue
            while state and c not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.step[state]:
                state = self._shorten(self.step[state][c])
                matched = min(matched + 1, self.window)
            else:
                matched = 0
            reach = 0
            if matched == self.window:
                reach = matched
                items |= self.owners[state]
            p = state if self.whole else 0
            while p > 0:
                for size, key in self.whole.get(p, ()):
                    if size <= matched:
                        reach = max(reach, size)
                        items.add(key)
                p = self.link[p]
            if reach:
                start = at + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at + 1))
        return spans, items


def _matcher(items: list[tuple[str, list[bytes]]], window: int):
    automaton = SuffixAutomaton(items, window)
    gram = min([4, window, *(len(w) for _, w in items)])
    least = min([window, *(len(w) for _, w in items)]) - gram + 1
    hashes = []
    for _, words in items:
        data = b" ".join(words)
        h, _, _, bounds = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        hashes.append(shingle_hashes(h, bounds, gram)[0])
    seen = np.zeros(1 << 22, bool)
    if hashes:
        seen[np.concatenate(hashes) & U64((1 << 22) - 1)] = True

    def match(data: np.ndarray, offsets: np.ndarray):
        """For each document of a slice: words, spans of hit words, items, word starts and ends."""
        words, starts, ends, bounds = word_hashes(data, offsets)
        spans: dict[int, list] = {}
        found: dict[int, set] = {}
        total = len(words)
        if items and total >= gram:
            rolled, _ = shingle_hashes(words, np.array([0, total]), gram)
            hit = seen[rolled & U64((1 << 22) - 1)]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            for a, b in edge.reshape(-1, 2)[(edge[1::2] - edge[::2]) >= least]:
                a, b = int(a), int(b) + gram - 1
                doc = int(np.searchsorted(bounds, a, "right")) - 1
                while a < b:  # a run may go on into the next documents
                    while bounds[doc + 1] <= a:
                        doc += 1
                    upto = min(b, int(bounds[doc + 1]))
                    texts = [data[s:e].tobytes().lower() for s, e in zip(starts[a:upto], ends[a:upto], strict=True)]
                    got, keys = automaton.stream(texts)
                    if got:
                        first = a - int(bounds[doc])
                        spans.setdefault(doc, []).extend((s + first, e + first) for s, e in got)
                        found.setdefault(doc, set()).update(keys)
                    a = upto
        for doc, own in spans.items():  # stretches may share their last and first words
            own.sort()
            together = own[:1]
            for start, end in own[1:]:
                if start <= together[-1][1]:
                    together[-1] = (together[-1][0], max(end, together[-1][1]))
                else:
                    together.append((start, end))
            spans[doc] = together
        return np.diff(bounds), spans, found, starts, ends, bounds

    return match


SPANS = "array<struct<start:int,end:int>>"
_MATCHERS: dict = {}


def _matcher_of(key: str, items, window: int):
    """A worker's matcher of a block of items, made once for all its tasks; of the last two blocks."""
    if key not in _MATCHERS:
        while len(_MATCHERS) > 1:
            _MATCHERS.pop(next(iter(_MATCHERS)))
        _MATCHERS[key] = _matcher(items.value, window)
    return _MATCHERS[key]


def _pass(docs: DataFrame, text: str, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """docs with __n_words, __spans (in words, merged) and __items extended by one block of items."""
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(f"__n int, __s {SPANS}, __i array<string>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = _matcher_of(key, shared, window)
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            for first, last, data, offsets in slices(batch.column(batch.schema.get_field_index(text))):
                counts, spans, found, *_ = match(data, offsets)
                n_words += counts.tolist()
                for d in range(last - first):
                    all_spans.append([{"start": s, "end": e} for s, e in spans.get(d, [])])
                    all_items.append(sorted(found.get(d, ())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int32()), pa.array(all_spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(all_items, pa.list_(pa.string()))],
                names=[*batch.schema.names, "__n", "__s", "__i"],
            )

    return docs.mapInArrow(run, schema)


def _merged(a: str, b: str):
    """Union of two arrays of word spans as maximal disjoint spans."""
    both = F.array_sort(F.concat(F.col(a), F.col(b)))
    return F.aggregate(
        both,
        F.expr(f"cast(array() as {SPANS})"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", max_bytes: int = MAX_BLOCK_BYTES) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of bounded size; each block is one automaton and one pass."""
    block, size = [], 0
    for row in benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("k"), F.col(text).alias("t")).toLocalIterator():
        words = item_words(row["t"])
        if not words:
            continue
        if block and size + len(row["t"]) > max_bytes:
            yield block
            block, size = [], 0
        block.append((row["k"], words))
        size += len(row["t"])
    yield block


def match_items(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (default: all) of docs with n_words, spans of hit words, and items."""
    keep = carry if carry is not None else docs.columns
    out, prefix = docs.select(*dict.fromkeys([*keep, text])), "match_"
    for k, block in enumerate(item_blocks(benchmark, item_id, item_text)):
        out = _pass(out, text, block, window)
        if k == 0:
            out = out.withColumnsRenamed({"__n": prefix + "n", "__s": prefix + "s", "__i": prefix + "i"})
        else:
            out = out.withColumns({prefix + "s": _merged(prefix + "s", "__s"), prefix + "i": F.array_union(prefix + "i", "__i")}).drop("__n", "__s", "__i")
    return out.select(*keep, F.col(prefix + "n").alias("n_words"), F.col(prefix + "s").alias("spans"), F.col(prefix + "i").alias("items"))


def contamination(matches: DataFrame, coverage: int = 20) -> DataFrame:
    """matches with n_hit and contaminated: hit words are at least 1/coverage of all."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]).cast("long"))
    return matches.withColumn("n_words", F.col("n_words").cast("long")).withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated ones; all columns stay as they were."""
    text = options.pop("text", "text")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text"))
    return contamination(match_items(whole, benchmark, carry=["doc"], **options)).filter(~F.col("contaminated")).select("doc.*")


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: counts, a digest of the items hit, and the verdict."""
    out = contamination(match_items(docs, benchmark, carry=[doc_id]))
    return out.select(
        doc_id, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "contaminated", "spans",
    )


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, int, str, bool]:
    """The contract, word by word, for tests."""
    words, hit, keys = item_words(text), set(), set()
    for key, body in items:
        own = item_words(body)
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                keys.add("" if key is None else str(key))
    digest = hashlib.sha256(",".join(sorted(keys)).encode()).hexdigest()
    return len(words), len(hit), len(keys), digest, bool(hit) and 20 * len(hit) >= len(words)
