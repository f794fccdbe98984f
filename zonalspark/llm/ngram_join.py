"""Operator 6: n-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Words are runs of ASCII letters and digits and of non-ASCII characters, ASCII
capitals folded; an n-gram is five words, or all words of a shorter text. Texts
with the same word sequence are one node; only one of them goes on.

1. Each text gets its MinHash bands; rows and bands follow from the recall that
   is asked for at the threshold.
2. Nodes that share a band meet by a shuffle on the band's hash. A bucket gives
   one edge for each member, to its smallest: never all pairs.
3. Components of these edges hold all candidates. A small component is one task.
   A large one is split into blocks of ``block`` nodes, and a task takes one or two
   blocks and counts the links of each node exactly. What is split is the
   component, if its nodes share most buckets (many near copies), or each of its
   buckets, if chance hits chain many small groups: whichever sends fewer n-gram
   sets. In buckets, a pair counts in the first band that it shares. A hot group
   is more tasks, not a larger one; the links come out as counts and as a forest,
   never as pairs.
4. Components of the verified forest are the classes.

Texts without a word (null, empty, marks only) are alone and have no links.
Repeated rows are copies: same class, and only one of them goes on. Ids may repeat
and be null: a text is named by 128 bits of the SHA-256 of both. A null doc_id
sorts before all others; of several smallest ids none is preferred, they are the
same. A text is taken whole, whatever its length; its n-gram set has to fit a task.
An empty table gives no rows. Other columns play no part in ``report``, and stay as
they are in ``one_of_each``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._text import U64, mix, row_mark, scratch, shingle_hashes, slices, word_hashes, written
from .graph import components

N = 5
THRESHOLD = 0.8
RECALL = 0.995
#: Nodes in a block of a component.
BLOCK = 512
#: Hash functions at most.
MOST = 128


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the threshold within so many hashes."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches that recall")


def _node(words: np.ndarray) -> bytes | None:
    """128 bits of a text's word sequence; none without words."""
    return xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None


def with_bands(docs: DataFrame, text: str, bands: int, rows: int, n: int) -> DataFrame:
    """docs without the text, with node and bands."""
    keep = [c for c in docs.columns if c != text]
    schema = T.StructType([*docs.select(*keep).schema.fields, *T._parse_datatype_string("node binary, bands array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.RandomState(11)
        flip = random.randint(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)
        odd = random.randint(0, 1 << 31, bands * rows, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        for batch in batches:
            nodes, found = [], []
            for first, last, data, offsets in slices(batch.column(batch.schema.get_field_index(text))):
                words, _, _, bounds = word_hashes(data, offsets)
                grams, at = shingle_hashes(words, bounds, n)
                nodes += [_node(words[bounds[d] : bounds[d + 1]]) for d in range(last - first)]
                full = np.flatnonzero(np.diff(at))
                out = np.zeros((last - first, bands), np.int64)
                if len(full):
                    short = (grams >> U64(32)).astype(np.uint32)
                    least = np.empty((len(full), bands * rows), U64)
                    for k in range(bands * rows):
                        least[:, k] = np.minimum.reduceat((short ^ flip[k]) * odd[k], at[:-1][full])
                    for j in range(bands):
                        h = np.full(len(full), j + 1, U64)
                        for k in range(j * rows, (j + 1) * rows):
                            h = mix(h * U64(0x9E3779B97F4A7C15) + least[:, k])
                        out[full, j] = h.view(np.int64)
                has = np.diff(at) > 0
                found += [out[d] if has[d] else None for d in range(last - first)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(nodes, pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=[*keep, "node", "bands"])

    return docs.select(*keep, text).mapInArrow(run, schema)


def _with_grams(wanted: DataFrame, n: int) -> DataFrame:
    """(node, bands, groups, grams): the n-gram set of each wanted text as sorted 64-bit hashes."""
    schema = T.StructType([wanted.schema[c] for c in ("node", "bands", "groups")] + [T.StructField("grams", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for first, last, data, offsets in slices(batch.column(0)):
                words, _, _, bounds = word_hashes(data, offsets)
                grams, at = shingle_hashes(words, bounds, n)
                sets += [np.unique(grams[at[d] : at[d + 1]]).tobytes() for d in range(last - first)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())], names=["node", "bands", "groups", "grams"])

    return wanted.select("text", "node", "bands", "groups").mapInArrow(run, schema)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share, as a matrix."""
    n = len(sets)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    out = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(64, (8 << 20) // n)
    for first in range(0, len(values), width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((n, min(width, len(values) - first)), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


def _links(blocks: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links, whole) of each node in each task's blocks; root is the smallest linked one there, and that of its class if the group is whole."""

    def settle(rows: list[tuple], band: int, across: bool, whole: bool) -> list[tuple]:
        sets = [np.frombuffer(r[3], U64) for r in rows]
        sizes = np.array([len(s) for s in sets], float)
        shared = shared_counts(sets)
        linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        if across:  # pairs inside a block are another task's
            block = np.array([r[1] for r in rows])
            linked &= block[:, None] != block[None, :]
        if band > 0:  # pairs that share an earlier band are that bucket's
            bands = np.array([r[2] for r in rows])
            for earlier in range(band):
                linked &= bands[:, None, earlier] != bands[None, :, earlier]
        names = [r[0] for r in rows]
        # hang every node of a linked set under its smallest
        root = list(range(len(rows)))
        for start in sorted(range(len(rows)), key=names.__getitem__):
            if root[start] != start:
                continue
            todo = [start]
            while todo:
                for j in np.flatnonzero(linked[todo.pop()]).tolist():
                    if root[j] == j and names[j] > names[start]:
                        root[j] = start
                        todo.append(j)
        return [(names[i], names[root[i]], int(k), whole) for i, k in enumerate(linked.sum(1)) if k]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.bool_())], names=["node", "root", "links", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, out = None, [], []
        for batch in batches:
            for comp, band, i, j, nb, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (comp, band, i, j, nb) != current:
                    if rows:
                        out += settle(rows, current[1], current[2] != current[3], current[1] < 0 and current[4] == 1)
                    current, rows = (comp, band, i, j, nb), []
                    if len(out) > 10_000:
                        yield batch_of(out)
                        out = []
                rows.append(row)
        if rows:
            out += settle(rows, current[1], current[2] != current[3], current[1] < 0 and current[4] == 1)
        yield batch_of(out)

    keys = ["comp", "band", "i", "j"]
    return blocks.select(*keys, "nb", "node", "block", "bands", "grams").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node binary, root binary, links long, whole boolean")


def _groups(nodes: DataFrame, block: int) -> DataFrame:
    """(node, comp, band, nb): the groups of candidates that a node is verified in, and into how many blocks each is split.

    comp is a component (band -1) or, of components that split better so, a bucket.
    """
    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    buckets = written(banded.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader")).filter("n > 1"), "buckets")
    mates = written(banded.join(buckets, ["band", "bucket"]), "mates")
    found = components(mates.select("node", "leader"), "node", "leader")
    members = written(found.union(found.select(F.col("root").alias("node"), "root").distinct()), "members")
    parts = lambda n: F.ceil(F.col(n) / block).cast("int")
    sizes = written(members.groupBy("root").agg(F.count("*").alias("size")).withColumn("nb", parts("size")), "sizes")
    whole = lambda chosen: members.join(chosen, "root").select("node", F.col("root").alias("comp"), F.lit(-1).alias("band"), "nb")
    if sizes.filter("nb > 1").isEmpty():
        return whole(sizes.select("root", "nb"))
    # sets sent if each bucket is split: a node goes once to each of its buckets for each of their blocks
    large = written(members.join(sizes.filter("nb > 1"), "root"), "large")
    sent = mates.join(large, "node").groupBy("root", "size", "nb").agg(F.sum(parts("n")).alias("sent"))
    by_bucket = written(sent.filter(F.col("sent") < F.col("size") * F.col("nb")).select("root"), "by_bucket")
    split = mates.join(written(large.join(by_bucket, "root").select("node"), "split"), "node")
    return whole(sizes.join(by_bucket, "root", "left_anti").select("root", "nb")).union(split.select("node", F.encode(F.col("bucket").cast("string"), "utf-8").alias("comp"), "band", parts("n").alias("nb")))


def _known(docs: DataFrame, doc_id: str, text: str, n: int, threshold: float, recall: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row; and (node, first, n_links) of every node, first being the smallest (doc_id, node) of its class."""
    bands, rows = bands_for(threshold, recall)
    plain = docs.select(F.col(doc_id).alias("doc_id"), row_mark(doc_id, text).alias("mark"), F.col(text).alias("text"))
    signed = written(with_bands(plain, "text", bands, rows, n), "bands")
    nodes = written(signed.filter("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "mark")).alias("own"), F.first("bands").alias("bands")), "nodes")
    groups = _groups(nodes, block).groupBy("node").agg(F.collect_list(F.struct("comp", "band", "nb")).alias("groups"))
    wanted = nodes.join(groups, "node").select("own.mark", "node", "bands", "groups")
    # repeated rows are combined before the shuffle
    texts = plain.select("mark", "text").dropDuplicates(["mark"]).join(wanted, "mark")
    in_groups = _with_grams(texts, n).select("node", "bands", "grams", F.explode("groups").alias("g")).select("node", "bands", "grams", "g.*")
    placed = in_groups.withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")
    blocks = placed.select("*", other).select("comp", "band", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "nb", "node", "block", "bands", "grams")
    links = written(_links(blocks, threshold), "links")
    roots, forest = links.filter("whole").select("node", "root"), links.filter("not whole").select("node", "root")
    if not forest.isEmpty():
        found = components(forest, "node", "root")
        roots = roots.union(found).union(found.select(F.col("root").alias("node"), "root").distinct())
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    names = nodes.select("node", F.struct("own.doc_id", "node").alias("alone"))
    linked = names.join(roots, "node")
    firsts = linked.groupBy("root").agg(F.min("alone").alias("first"))
    linked = linked.join(firsts, "root").join(counts, "node").select("node", "first", "n_links")
    known = written(names.join(linked, "node", "left").select("node", F.coalesce("first", "alone").alias("first"), "n_links"), "known")
    return signed, known


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, block: int | None = None) -> DataFrame:
    """doc_id, node, first (of its class: doc_id and node), class_id, n_links, for every row of docs.

    class_id is the smallest doc_id of the class; n_links counts the other texts
    (not copies) whose similarity is the threshold or more.
    """
    with scratch() as keep:
        rows, known = (keep(df) for df in _known(docs, doc_id, text, n, threshold, recall, block or BLOCK))
    # all copies of a text have one node: a join of files, whose large keys Spark can split
    out = rows.select("doc_id", "node").join(known, "node", "left")
    return out.select(
        "doc_id", "node", F.coalesce("first", F.struct("doc_id", "node")).alias("first"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its class and the number of its links."""
    return classes(docs, **options).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class, the smallest doc_id; texts without words all stay.

    Of repeated rows with one doc_id and the same words, one stays.
    """
    options = {"doc_id": "doc_id", "text": "text", "n": N, "threshold": THRESHOLD, "recall": RECALL, "block": BLOCK} | options
    doc_id, text = options["doc_id"], options["text"]
    with scratch() as keep:
        _, known = _known(docs, **options)
        firsts = keep(written(known.select("first.doc_id", "first.node").distinct().select(F.col("doc_id").alias("first_id"), F.col("node").alias("first_node")), "firsts"))
    named = with_nodes(docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id")))
    # repeated rows are combined before the shuffle
    once = named.filter("node is not null").groupBy("doc_id", "node").agg(F.first("doc").alias("doc"))
    kept = once.join(firsts, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node")), "left_semi").select("doc.*")
    return kept.union(named.filter("node is null").select("doc.*"))


def with_nodes(whole: DataFrame) -> DataFrame:
    """(doc, doc_id, node) without signatures."""
    schema = T.StructType([whole.schema["doc"], whole.schema["doc_id"], T.StructField("node", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            for first, last, data, offsets in slices(batch.column(1)):
                words, _, _, bounds = word_hashes(data, offsets)
                nodes += [_node(words[bounds[d] : bounds[d + 1]]) for d in range(last - first)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(nodes, pa.binary())], names=["doc", "doc_id", "node"])

    return whole.select("doc", "text", "doc_id").mapInArrow(run, schema)
