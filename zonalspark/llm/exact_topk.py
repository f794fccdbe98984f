"""Operator 9: exact top-k by inner product, in three phases with a uniform threshold.

A score is the sum of partial scores over ``LISTS`` runs of components, one list
for each run. Queries and candidates travel in blocks of rows. Queries are dealt
into groups, candidates into groups, and a cell is one group of each: a task holds
the queries of its cell and streams the candidates past them. Neither side is
ever whole in a task, and the number of cells follows the number of rows.

1. Some groups of candidates (the root of their number, which balances what the
   two phases send) gather their local lists: for each query the k best entries
   of every list, with their whole scores. The k-th best of all that is a safe
   cutoff, as k rows reach it.
2. The cutoff goes out with the query blocks. A row reaches it only if a partial
   score reaches cutoff / lists: a block whose norms rule that out for all lists is
   skipped. Else its lists are added one by one, and a row stays only while what
   it has and the norms of what is left can still reach the cutoff.
3. The scores of the rows that stay are resolved exactly, by list as long as many
   stay and row by row once they are few. A cell's own k-th score raises its
   cutoff as it goes on; it returns k rows a query at most.

Scores are integers, exact: in single precision where no sum can pass 2**24, in
doubles up to 2**53, else in 64-bit integers (a score that a long cannot hold is
not defined). Ties go to the smaller vec_id. Vectors that are null or hold a null
or non-finite component take no part, nor do vectors of another length than the
query's, nor null ids. Repeated rows are rows: each ranks as a candidate; a query
does not meet rows of its own id. A query repeated with the same vector is asked
once, one id with several vectors once for each. Fewer candidates than k: all of
them. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._text import written

LISTS = 4
#: Rows in a block, queries and candidates in a cell, and rows of a matrix of scores.
ROWS = 1024
QUERY_ROWS = 1 << 15
CANDIDATE_ROWS = 1 << 18
TILE = 512
#: Partitions that the cells are dealt to, at most; a partition takes its cells one after the other.
MOST_TASKS = 20_000
#: Share of a matrix below which scores are resolved row by row.
FEW = 0.02
_BLOCK = "dims int, width int, ids binary, vectors binary, keys binary, cutoffs binary"
_LOWEST = -(2**62)


def integers(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, of the vectors that take part."""
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    ok = F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.filter(F.coalesce(ok, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, v and, of queries, key and cutoff) of each partition in blocks of at most size vectors of one length."""
    asked = "key" in rows.columns

    def block(dims: int, parts: list[list]) -> pa.RecordBatch:
        vectors = np.concatenate([p[0] for p in parts])
        width = next(w for w in (2, 4, 8) if w == 8 or int(np.abs(vectors).max(initial=0)) < 1 << (8 * w - 1))
        ids, *rest = (np.concatenate([p[i] for p in parts]).tobytes() for i in range(1, len(parts[0])))
        values = [dims, width, ids, vectors.astype(f"<i{width}").tobytes(), *(rest or (None, None))]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["dims", "width", "ids", "vectors", "keys", "cutoffs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dims)
                part = batch.take(pa.array(own))
                arrays = [part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(own), dims), *(part.column(i).to_numpy(zero_copy_only=False) for i in (0, *range(2, part.num_columns)))]
                for a in range(0, len(own), size):
                    part = [x[a : a + size] for x in arrays]
                    if sum(len(p[1]) for p in held.get(dims, ())) + len(part[1]) > size:
                        yield block(dims, held.pop(dims))
                    held.setdefault(dims, []).append(part)
        for dims, parts in held.items():
            yield block(dims, parts)

    return rows.select("vec_id", "v", *(["key", "cutoff"] if asked else [])).mapInArrow(run, _BLOCK)


class Vectors:
    """Rows of one length: ids, exact components by list, and the norms that bound them."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, lists: int):
        self.ids, self.whole, self.dims = ids, whole, whole.shape[1]
        self.most = float(np.abs(whole).max(initial=0))
        self.cuts = np.linspace(0, self.dims, min(lists, max(self.dims, 1)) + 1).astype(int)
        squares = np.add.reduceat(np.square(whole, dtype=np.float64), self.cuts[:-1], axis=1) if self.dims else np.zeros((len(ids), 1))
        self.norms = np.sqrt(squares)
        #: Norm of what comes after each list.
        self.rest = np.sqrt(np.maximum(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1] - squares, 0))
        self._as: dict = {}

    def part(self, k: int, kind) -> np.ndarray:
        if (k, kind) not in self._as:
            self._as[k, kind] = np.ascontiguousarray(self.whole[:, self.cuts[k] : self.cuts[k + 1]], dtype=kind)
        return self._as[k, kind]

    def rows(self, a: int, b: int) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.whole, out.dims, out.most, out.cuts = self.ids[a:b], self.whole[a:b], self.dims, self.most, self.cuts
        out.norms, out.rest, out._as = self.norms[a:b], self.rest[a:b], {}
        return out


def _kind(q: Vectors, c: Vectors):
    most = q.most * c.most * max(q.dims, 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _own(q_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs of one id."""
    order = np.argsort(q_ids, kind="stable")
    low, high = (np.searchsorted(q_ids[order], ids, side) for side in ("left", "right"))
    n = high - low
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return order[at], np.repeat(np.arange(len(ids)), n)


def _whole(q: Vectors, c: Vectors, at_q: np.ndarray, at_c: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", q.whole[at_q].astype(np.int64), c.whole[at_c].astype(np.int64)) if q.dims else np.zeros(len(at_q), np.int64)


def local_lists(q: Vectors, c: Vectors, k: int) -> np.ndarray:
    """Phase 1: whole scores of the rows that are among the k best of a list, by query; the lowest number fills up."""
    kind, n = _kind(q, c), min(k + 1, len(c.ids))  # one more, as a query may be its own best
    own = _own(q.ids, c.ids)
    found = []
    for part in range(len(q.cuts) - 1):
        scores = q.part(part, kind) @ c.part(part, kind).T
        found.append(np.argpartition(scores, len(c.ids) - n, axis=1)[:, len(c.ids) - n :])
    at = np.sort(np.concatenate(found, axis=1), axis=1)
    scores = _whole(q, c, np.repeat(np.arange(len(q.ids)), at.shape[1]), at.ravel()).reshape(at.shape)
    again = np.zeros(at.shape, bool)
    again[:, 1:] = at[:, 1:] == at[:, :-1]  # one row counts once
    for i, j in zip(*own, strict=True):
        again[i] |= at[i] == j
    scores[again] = _LOWEST
    return scores


def survivors(q: Vectors, c: Vectors, cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3: (query, candidate, score) of every score of cutoff or more, and how many scores were resolved whole."""
    lists, none = len(q.cuts) - 1, np.zeros(0, np.int64)
    kind = _kind(q, c)
    bar = -(-cutoff // lists)  # the smallest whole number that is at least cutoff / lists
    live = np.flatnonzero((q.norms * c.norms.max(axis=0, initial=0) * (1 + 1e-9) >= bar[:, None]).any(axis=1))
    if not len(live) or not len(c.ids):
        return none, none, none, 0
    least, scores = cutoff[live], np.zeros((len(live), len(c.ids)), kind)
    reach = np.zeros(len(live))
    few = None
    for part in range(lists):
        scores += q.part(part, kind)[live] @ c.part(part, kind).T
        if part == lists - 1:
            break
        reach += q.norms[live, part] * c.norms[:, part].max()
        bound = np.floor(least - q.rest[live, part] * c.rest[:, part].max() * (1 + 1e-9) - 1e-6)
        if not (bound > -reach).any():
            continue  # every row could still reach the cutoff
        may = scores >= np.clip(bound, -(2.0**62), 2.0**62).astype(kind)[:, None] if kind is np.int64 else scores >= np.nextafter(bound.astype(kind), kind(-np.inf))[:, None]
        if np.count_nonzero(may) <= FEW * may.size:
            at_q, at_c = np.nonzero(may)
            known = scores[at_q, at_c].astype(np.float64)
            keep = known + q.rest[live[at_q], part] * c.rest[at_c, part] * (1 + 1e-9) + 1e-6 >= least[at_q]
            few = live[at_q[keep]], at_c[keep]
            break
    if few is not None:
        at_q, at_c = few
        values = _whole(q, c, at_q, at_c)
        keep = values >= cutoff[at_q]
        resolved = len(values)
    else:
        # a float of the cutoff may be rounded down, never up
        line = least.astype(kind) if kind is np.int64 else np.nextafter(least.astype(kind), kind(-np.inf))
        at_q, at_c = np.nonzero(scores >= line[:, None])
        values = scores[at_q, at_c].astype(np.int64)
        at_q, resolved = live[at_q], scores.size
        keep = values >= cutoff[at_q]
    keep &= q.ids[at_q] != c.ids[at_c]
    return at_q[keep], at_c[keep], values[keep], resolved


class Best:
    """The k best rows of each query so far, and the score and id that a further one has to beat."""

    def __init__(self, n: int, k: int, cutoff: np.ndarray):
        self.k, self.cutoff, self.last = k, cutoff.copy(), np.full(n, np.iinfo(np.int64).max)
        self.parts: list[tuple] = []
        self.held, self.full = 0, max(4 * n * k, 1 << 16)

    def add(self, at_q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = (scores > self.cutoff[at_q]) | (ids < self.last[at_q])
        self.parts.append((at_q[keep], ids[keep], scores[keep]))
        self.held += len(self.parts[-1][0])
        if self.held > self.full:
            self.rows()

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at_q, ids, scores = (np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((ids, -scores, at_q))
        at_q, ids, scores = at_q[order], ids[order], scores[order]
        place = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
        kth = place == self.k - 1
        self.cutoff[at_q[kth]], self.last[at_q[kth]] = scores[kth], ids[kth]
        keep = place < self.k
        self.parts, self.held = [(at_q[keep], ids[keep], scores[keep])], int(keep.sum())
        return self.parts[0]


class _Cell:
    """The queries of a cell by length of vector; takes the candidates block by block."""

    def __init__(self, k: int, lists: int):
        self.k, self.lists, self.blocks, self.ready = k, lists, {}, {}

    def query(self, dims: int, ids: np.ndarray, whole: np.ndarray, keys: np.ndarray, cutoffs: np.ndarray) -> None:
        self.blocks.setdefault(dims, []).append((ids, whole, keys, cutoffs))

    def tiles(self, dims: int) -> list[dict]:
        if dims not in self.ready:
            self.ready[dims] = []
            if dims in self.blocks:
                ids, whole, keys, cutoffs = (np.concatenate(x) for x in zip(*self.blocks.pop(dims), strict=True))
                q = Vectors(ids, whole, self.lists)
                for a in range(0, len(ids), TILE):
                    cut = cutoffs[a : a + TILE]
                    self.ready[dims].append({"q": q.rows(a, a + TILE), "keys": keys[a : a + TILE], "best": Best(len(cut), self.k, cut), "top": np.full((len(cut), self.k), _LOWEST)})
        return self.ready[dims]

    def gather(self, c: Vectors) -> None:
        for tile in self.tiles(c.dims):
            both = np.concatenate((tile["top"], local_lists(tile["q"], c, self.k)), axis=1)
            tile["top"] = np.partition(both, both.shape[1] - self.k, axis=1)[:, both.shape[1] - self.k :]

    def resolve(self, c: Vectors) -> None:
        for tile in self.tiles(c.dims):
            at_q, at_c, scores, _ = survivors(tile["q"], c, tile["best"].cutoff)
            tile["best"].add(at_q, c.ids[at_c], scores)

    def gathered(self) -> Iterator[pa.RecordBatch]:
        for tile in (t for tiles in self.ready.values() for t in tiles):
            at_q, at = np.nonzero(tile["top"] > _LOWEST)
            yield pa.RecordBatch.from_arrays([pa.array(tile["keys"][at_q]), pa.array(tile["top"][at_q, at])], names=["key", "score"])

    def resolved(self) -> Iterator[pa.RecordBatch]:
        for tile in (t for tiles in self.ready.values() for t in tiles):
            at_q, ids, scores = tile["best"].rows()
            yield pa.RecordBatch.from_arrays([pa.array(tile["keys"][at_q]), pa.array(tile["q"].ids[at_q]), pa.array(ids), pa.array(scores)], names=["key", "query_id", "vec_id", "score"])


def _met(queries: DataFrame, candidates: DataFrame, groups: tuple[int, int], used: int, k: int, lists: int, gather: bool) -> DataFrame:
    """Every group of queries with each of the first ``used`` groups of candidates, cell by cell."""
    g, h = groups
    columns = ["dims", "width", "ids", "vectors", "keys", "cutoffs"]
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    asked = queries.select(dealt(g).alias("g"), number(used).alias("h"), F.lit(0).alias("side"), *columns)
    given = candidates.withColumn("h", dealt(h)).filter(F.col("h") < used).select(number(g).alias("g"), "h", F.lit(1).alias("side"), *columns)
    cells = asked.union(given).repartition(min(g * used, MOST_TASKS), "g", "h").sortWithinPartitions("g", "h", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names)}
                if (row["g"], row["h"]) != now:
                    if cell:
                        yield from cell.gathered() if gather else cell.resolved()
                    now, cell = (row["g"], row["h"]), _Cell(k, lists)
                ids = np.frombuffer(row["ids"], np.int64)
                whole = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(len(ids), row["dims"])
                if row["side"] == 0:
                    cell.query(row["dims"], ids, whole.astype(np.int64), np.frombuffer(row["keys"], np.int64), np.frombuffer(row["cutoffs"], np.int64))
                else:
                    (cell.gather if gather else cell.resolve)(Vectors(ids, whole, lists))
        if cell:
            yield from cell.gathered() if gather else cell.resolved()

    return cells.mapInArrow(run, "key long, score long" if gather else "key long, query_id long, vec_id long, score long")


def groups_for(queries: int, rows: int, tasks: int) -> tuple[int, int]:
    """(groups of queries, groups of candidates): bounded cells, and some for each of so many tasks if there are blocks enough."""
    g = max(1, math.ceil(queries / QUERY_ROWS))
    return g, max(1, math.ceil(rows / CANDIDATE_ROWS), min(math.ceil(rows / ROWS), math.ceil(tasks / g)))


def top_k(vectors: DataFrame, query: str, *, k: int = 20, scale: int = 64, lists: int = LISTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best of every row that query (SQL on vec_id) selects."""
    spark = vectors.sparkSession
    n, asked_n = vectors.select(F.col(vec_id).alias("vec_id")).agg(F.count("*"), F.count_if(F.expr(query))).collect()[0]
    groups = groups_for(asked_n, n, 4 * spark.sparkContext.defaultParallelism)
    rows = integers(vectors, vec_id=vec_id, embedding=embedding, scale=scale)
    candidates = blocks(rows, ROWS)
    # numbered once and written: a repeated query gets one number, whatever is computed again
    asked = written(rows.filter(query).dropDuplicates().withColumn("key", F.monotonically_increasing_id()), "queries")
    unknown = asked.withColumn("cutoff", F.lit(_LOWEST))
    first = _met(blocks(unknown, ROWS), candidates, groups, math.isqrt(groups[1] - 1) + 1, k, lists, True)
    # WindowGroupLimit keeps k rows a query in each task before the shuffle
    best = Window.partitionBy("key").orderBy(F.desc("score"))
    cutoffs = first.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select("key", F.col("score").alias("cutoff"))
    known = asked.join(cutoffs, "key", "left").select("vec_id", "v", "key", F.coalesce("cutoff", F.lit(_LOWEST)).alias("cutoff"))
    found = _met(blocks(known, ROWS), candidates, groups, groups[1], k, lists, False)
    ranked = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, "vec_id % 20 = 0")


def brute_force(rows: list[tuple], k: int = 20, scale: int = 64) -> list[tuple]:
    """The contract, pair by pair, for tests."""
    ok = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)
