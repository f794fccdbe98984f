"""Operator 8: packing into optimal length buckets.

Texts become token ids once, each with an end id. A text of more than ``max_len``
tokens is cut into pieces of that length and a rest. The pieces are written with
the number of the task that made them and their rank among its pieces of one
length. The global histogram of piece lengths has at most max_len rows, whatever
the corpus; dynamic programming over it picks the ``buckets`` boundaries with the
least padding in all. (``step`` rounds lengths up first, for lengths that have to be
multiples.) Inside a bucket, every ``budget // boundary`` pieces form a batch; only
the last batch of a bucket can be smaller.

A piece's number in its bucket is its rank and the counts of the lengths and tasks
before it, sums over a small table: no piece has to be sorted or moved for it, and
no bucket has to be in one task.

A text without tokens (null, empty) has one piece, the end id. Pieces of one
length are numbered in the order in which their task read them; repeated rows are
each packed. A text of any length is encoded whole; its ids have to fit a task. An
empty table gives none. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._text import scratch, slices, written
from .token_output import BLOCK, encoder_of

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 65_536
#: Ids of pieces in one batch of rows.
IDS = 4 << 20


def boundaries(histogram: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[int]:
    """Ascending boundaries from (length, rows, tokens): least padding with at most so many buckets."""
    if not histogram:
        return []
    lengths, rows, tokens = (np.array(x, float) for x in zip(*sorted(histogram), strict=True))
    m = len(lengths)
    c, s = np.concatenate(([0], np.cumsum(rows))), np.concatenate(([0], np.cumsum(tokens)))
    # lengths i..j-1 padded to the last of them: the larger j, the larger the best i, as more rows at i cost more the longer the last one is
    cost = lambda i, j: lengths[j - 1] * (c[j] - c[i]) - (s[j] - s[i])
    best, choice = np.full(m + 1, np.inf), []
    best[0] = 0
    for layer in range(min(buckets, m)):
        now, at = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        stack = [(layer + 1, m, layer, m - 1)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            values = best[i] + cost(i, j)
            k = int(values.argmin())
            now[j], at[j] = values[k], first + k
            stack += [(low, j - 1, first, first + k), (j + 1, high, first + k, last)]
        choice.append(at)
        best = now
    out, end = [], m
    for at in reversed(choice):
        out.append(int(lengths[end - 1]))
        end = int(at[end])
    return out[::-1]


def pieces(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", max_len: int = MAX_LEN, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, rank): each text as pieces of at most max_len tokens.

    ids are little-endian, 2 bytes each or, of vocabularies over 65,536, 4. rank
    counts the pieces of that length before it in its task, which is part.
    """
    names = ["doc_id", "piece", "start", "length", "ids", "part", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = encoder_of(tokenizer_path), TaskContext.get().partitionId()
        width, end = encoder.dtype.itemsize, np.array([end_id], encoder.dtype).tobytes()
        seen: Counter[int] = Counter()
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1), BLOCK):
                ids, bounds = encoder.slice(data, offsets)
                bounds, d = bounds.tolist(), 0
                while d < last - first:
                    owners, rows = [], []
                    upto = bounds[d] + IDS
                    while d < last - first and (not rows or bounds[d + 1] <= upto):
                        raw = ids[bounds[d] : bounds[d + 1]].tobytes() + end
                        for k, at in enumerate(range(0, len(raw), max_len * width)):
                            own = raw[at : at + max_len * width]
                            n = len(own) // width
                            owners.append(first + d)
                            rows.append((k, k * max_len, n, own, part, seen[n]))
                            seen[n] += 1
                        d += 1
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners)), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, piece long, start long, length long, ids binary, part int, rank long")


def pack(docs: DataFrame, tokenizer_path: str, *, max_len: int = MAX_LEN, step: int = 1, buckets: int = BUCKETS, budget: int = BUDGET, **options) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, padded_length, bucket, batch, slot, ids (as in ``pieces``)."""
    with scratch() as keep:
        cut = keep(written(pieces(docs, tokenizer_path, max_len=max_len, **options), "pieces"))
        rounded = (F.ceil(F.col("length") / step) * step).cast("long")
        histogram = [tuple(r) for r in cut.groupBy(rounded.alias("rounded")).agg(F.count("*"), F.sum("length")).collect()]
        bounds = F.array(*map(F.lit, boundaries(histogram, buckets) or [max_len]))
        at = F.size(F.filter(bounds, lambda b: b < F.col("length"))).cast("int")
        counts = written(cut.groupBy("part", "length").agg(F.count("*").alias("n")).withColumn("bucket", at), "counts")
        # what comes before: other tasks in the bucket, then shorter lengths of the task in it
        tasks = counts.groupBy("bucket", "part").agg(F.sum("n").alias("n"))
        rest = Window.rowsBetween(Window.unboundedPreceding, -1)
        tasks = tasks.select("bucket", "part", F.coalesce(F.sum("n").over(rest.partitionBy("bucket").orderBy("part")), F.lit(0)).alias("others"))
        own = F.coalesce(F.sum("n").over(rest.partitionBy("bucket", "part").orderBy("length")), F.lit(0))
        before = keep(written(counts.withColumn("own", own).join(tasks, ["bucket", "part"]).select("part", "length", "bucket", (F.col("own") + F.col("others")).alias("before")), "offsets"))
    row = F.col("before") + F.col("rank")
    room = F.greatest(F.floor(F.lit(budget) / F.col("padded_length")), F.lit(1)).cast("long")
    return (
        cut.join(before, ["part", "length"])
        .withColumn("padded_length", F.get(bounds, F.col("bucket")).cast("long"))
        .select("doc_id", "piece", "start", "length", "padded_length", "bucket", F.floor(row / room).cast("long").alias("batch"), (row % room).cast("long").alias("slot"), "ids")
    )


def batches(packed: DataFrame, *, pad: bytes = b"\0\0") -> DataFrame:
    """(bucket, batch, padded_length, doc_ids, lengths, ids): each batch whole, its rows padded; at most a budget of ids.

    pad is one id, as wide as those of the pieces.
    """
    missing = F.repeat(F.hex(F.lit(pad)), (F.col("padded_length") - F.col("length")).cast("int"))
    row = F.struct("slot", "doc_id", "length", F.unhex(F.concat(F.hex("ids"), missing)).alias("ids"))
    whole = packed.groupBy("bucket", "batch").agg(F.first("padded_length").alias("padded_length"), F.array_sort(F.collect_list(row)).alias("r"))
    ids = F.aggregate("r", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return whole.select("bucket", "batch", "padded_length", F.col("r.doc_id").alias("doc_ids"), F.col("r.length").alias("lengths"), ids.alias("ids"))
