"""Operator 10: removal of byte strings that start more than once, by hash-compared suffixes.

Every start of a ``length``-byte string is a suffix cut to ``length`` bytes;
starts with equal strings are repeats. Prefix polynomial hashes give the hash of
any substring at once, so suffixes compare by hashes:

1. In each text, neighbouring starts whose strings have the same smallest seed
   hash form a stretch. Equal strings have equal smallest seeds in equal places,
   so a string that occurs again has a stretch with the same seed there. A
   stretch is one row: its seed, a digest of all the bytes it spans (128 bits of
   BLAKE2b), its place. The rows are written once and all later steps read them.
2. Stretches whose seed occurs once hold no repeat. Stretches with the same bytes
   are one suffix: with the same seed and digest they are repeats at every start.
3. One stretch for each digest of a seed with several goes on, with its bytes.
   The suffixes that begin at the seeds are mergesorted, and so are the prefixes
   before them, read backwards: two suffixes compare by their common extension,
   found by binary search on the prefix hashes. In sorted order, neighbours that
   share enough bytes form classes, and a start is a repeat if another stretch is
   in its class on both sides. Neighbours that count as equal are compared byte
   by byte.
4. A seed with more stretches than ``GROUP`` is made longer: the
   starts in the first half before the seed all hold some bytes more before it,
   the others some bytes more after it. The stretch becomes two with longer
   seeds, which meet fewer others. After at most log2(length - seed) such steps
   the seed is the string.

All starts of a corpus as suffixes would take 8 bytes for each byte of text;
the stretches are about one row for 55 bytes. Counts are combined before every
shuffle, and joins on a popular seed are joins of files, which Spark can split.

Null is the empty text. Texts shorter than ``length`` lose nothing. Repeated
rows, with or without an id, repeat each other: all their bytes that strings of
``length`` cover go. A text of any length is taken whole, in one row; its bytes
have to fit a task. An empty table gives no rows. Other columns play no part,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import U64, Hashes, forget, scratch, slices, text_mark, trim_powers, written

LENGTH = 200
SEED = 80
#: Stretches of one seed in one task at most, and stretches in one sort.
GROUP = 1_000
CHUNK = 4_000
#: Bytes of stretches in one batch.
CONTEXTS = 8 << 20


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, seed: int):
    """(document, first start, last start, seed hash) of every stretch in a slice; starts count in the slice."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none.astype(U64)
    at = np.arange(n - seed + 1)
    hashes = Hashes(data).of(at, at + seed)
    width, least, span = length - seed + 1, hashes, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n - length + 1], least[width - span : width - span + n - length + 1])
    valid = np.zeros(n - length + 1, bool)
    new = np.zeros(n - length + 1, bool)
    new[1:] = (least[1:] != least[:-1]) | (hashes[: n - length] == least[:-1])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= length:
            valid[a : b - length + 1] = True
            new[a] = True
    first = np.flatnonzero(new & valid)
    # a stretch ends before the next one, or with its text
    document = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(first[1:], n) - 1, offsets[document + 1] - length)
    return document, first, last, least[first]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A text's key is its id and a 128-bit digest of it, so that repeated and missing ids do no harm."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))


def stretch_rows(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first_doc, _, data, offsets in slices(batch.column(2)):
                document, first, last, least = stretches(data, offsets, length, seed)
                raw = memoryview(data.tobytes())
                base, one, two = offsets[document], *digests([raw[a:b] for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least.view(np.int64)), one, two, pa.array(ids[first_doc + document]), batch.column(1).take(pa.array(first_doc + document)), pa.array((first - base).astype(np.int32)), pa.array((last - base).astype(np.int32))],
                    names=["seed", "d1", "d2", "doc", "mark", "first", "last"],
                )
                trim_powers()

    return keyed.mapInArrow(run, "seed long, d1 long, d2 long, doc long, mark binary, first int, last int")


def digests(parts: list) -> tuple[pa.Array, pa.Array]:
    """128 bits of each part's BLAKE2b, as two columns."""
    both = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in parts), np.int64).reshape(-1, 2)
    return pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the suffixes at a and b share, up to length: binary search on prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), length, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = hashes.of(a, a + middle) == hashes.of(b, b + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at starts, and what each shares with the one before it, at most length bytes.

    A bottom-up mergesort: all merges of a round search at once for the place of
    each suffix in the other run; a comparison takes log(length) hash probes.
    """
    hashes, n = Hashes(data), len(starts)
    order, size = np.arange(n), 1

    def less(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        a, b = starts[x], starts[y]
        shared = common_extension(hashes, a, b, length)
        full = shared == length
        return np.where(full, ties, data[a + np.where(full, 0, shared)] < data[b + np.where(full, 0, shared)])

    while size < n:
        place = np.arange(n)
        run = place // size
        base = np.minimum((run ^ 1) * size, n)
        low, high = base.copy(), np.minimum(base + size, n)
        while len(at := np.flatnonzero(low < high)):
            middle = (low[at] + high[at]) // 2
            # of equal suffixes, those of the left run come first
            goes = less(order[middle], order[at], run[at] % 2 == 1)
            low[at] = np.where(goes, middle + 1, low[at])
            high[at] = np.where(goes, high[at], middle)
        merged = np.empty(n, np.int64)
        merged[run // 2 * 2 * size + (place - run * size) + (low - base)] = order
        order, size = merged, size * 2
    shared = np.zeros(n, np.int64)
    if n > 1:
        a, b = starts[order[:-1]], starts[order[1:]]
        shared[1:] = common_extension(hashes, a, b, length)
        raw = data.tobytes()
        for k, (x, y, m) in enumerate(zip(a.tolist(), b.tolist(), shared[1:].tolist(), strict=True), 1):
            if raw[x : x + m] != raw[y : y + m]:  # a collision: count the bytes
                shared[k] = next(i for i in range(m) if raw[x + i] != raw[y + i])
    return order, shared


def repeated_starts(contexts: list[bytes], seeds: list[int], length: int) -> list[np.ndarray]:
    """For each stretch (its bytes, where its seed begins) the starts, from its own, that another stretch repeats.

    Stretches of different seeds may be mixed: they share less than a seed.
    """
    n, gap = len(contexts), bytes(length)
    forward = np.frombuffer(b"".join(x for c in contexts for x in (c, gap)), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    begins = np.concatenate(([0], np.cumsum(sizes + length)))[:-1]
    at = np.array(seeds)
    reach, before = sizes - at, at  # bytes after and before the beginning of the seed
    backward = np.concatenate((forward[::-1], np.zeros(length, np.uint8)))
    classes = []
    for data, starts, own in ((np.concatenate((forward, np.zeros(length, np.uint8))), begins + at, reach), (backward, len(forward) - begins - at, before)):
        order, shared = sorted_suffixes(data, starts, length)
        classes.append((order, shared, own))
    last = sizes - length
    out: list[list[int]] = [[] for _ in range(n)]
    for d in range(int(before.max()) + 1):  # starts d bytes before their seed
        member = np.flatnonzero((before >= d) & (before - d <= last))
        if len(member) < 2:
            continue
        key = np.zeros(n, np.int64)
        for (order, shared, _), need in zip(classes, (length - d, d), strict=True):
            group = np.empty(n, np.int64)
            group[order] = np.cumsum(shared < need)
            key = key * (n + 1) + group
        _, inverse, counts = np.unique(key[member], return_inverse=True, return_counts=True)
        for k in member[counts[inverse] > 1].tolist():
            out[k].append(int(before[k]) - d)
    return [np.array(sorted(x), np.int64) for x in out]


def _spans(starts: np.ndarray, length: int) -> list[dict]:
    """Runs of neighbouring starts as spans of bytes."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    firsts, lasts = starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]
    return [{"start": a, "end": b + length} for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]


SPANS = "array<struct<start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _packed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, key and the text as zstandard: what travels in a shuffle."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("doc"), text_mark(text).alias("mark"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack((t or "").encode()) for t in batch.column(3).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], names=["doc_id", "doc", "mark", "packed"])

    return keyed.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, doc long, mark binary, packed binary")


_RIM = "key long, width int, doc long, mark binary, first int, at int, context binary"
_RIM_KINDS = pa.schema([("key", pa.int64()), ("width", pa.int32()), ("doc", pa.int64()), ("mark", pa.binary()), ("first", pa.int32()), ("at", pa.int32()), ("context", pa.binary())])


def _rims(wanted: DataFrame, length: int, seed: int) -> DataFrame:
    """The bytes of each wanted stretch, and where its seed begins in them; width: how far at most a start is before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc, mark, packed, wants in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = unpack(packed)
                data = np.frombuffer(text, np.uint8)
                at = np.arange(len(data) - seed + 1)
                hashes = Hashes(data).of(at, at + seed).view(np.int64)
                for w in wants:
                    first, last = w["first"], w["last"]
                    place = int(np.argmax(hashes[first : first + length - seed + 1] == w["seed"]))
                    out.append((w["seed"], length - seed, doc, mark, first, place, text[first : last + length]))
                    held += last + length - first
                if held > CONTEXTS:
                    yield _rim_batch(out)
                    out, held = [], 0
                trim_powers()
            yield _rim_batch(out)

    return wanted.mapInArrow(run, _RIM)


def _rim_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_RIM_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RIM_KINDS, strict=True)], schema=_RIM_KINDS)


def longer_seeds(context: bytes, at: int, width: int, length: int) -> list[tuple[int, int, int, bytes]]:
    """(bytes cut off in front, width, place of the seed, bytes) of the two stretches with longer seeds that have the starts of this one."""
    half, out = (width + 1) // 2, []
    if at >= half:  # starts half bytes before the seed or more
        out.append((0, width - half, at - half, context[: at - half + length]))
    first = max(0, at - half + 1)
    if len(context) - first >= length:
        out.append((first, half - 1, at - first, context[first:]))
    return out


def _longer(rims: DataFrame, length: int) -> DataFrame:
    """Stretches as two each with longer seeds, keyed by them, and their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, width, doc, mark, first, at, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for cut, rest, place, part in longer_seeds(context, at, width, length):
                    key = xxhash.xxh3_64_intdigest(part[place : place + length - rest], rest + 1)
                    out.append((key - (key >> 63 << 64), rest, doc, mark, first + cut, place, part))
            whole = _rim_batch(out)
            yield pa.RecordBatch.from_arrays([*whole.columns, *digests(whole.column(6).to_pylist())], names=[*_RIM_KINDS.names, "d1", "d2"])

    return rims.select(*_RIM_KINDS.names).mapInArrow(run, _RIM + ", d1 long, d2 long")


def _sorted_rims(rims: DataFrame, length: int) -> DataFrame:
    """Spans of the repeats inside the rims; a seed's stretches are in one task, a bounded number."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        starts = repeated_starts([r[4] for r in rows], [r[3] for r in rows], length)
        trim_powers()
        spans = [[{"start": r[2] + s["start"], "end": r[2] + s["end"]} for s in _spans(x, length)] for r, x in zip(rows, starts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array(spans, _SPANS)], names=["doc", "mark", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group: list[tuple] = []
        current = None
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != current:
                    if len(rows) + len(group) > CHUNK and rows:
                        yield settle(rows)
                        rows = []
                    rows, group, current = rows + group if group else rows, [], key
                group.append(tuple(row))
        if rows or group:
            yield settle(rows + group)

    return rims.select("key", "doc", "mark", "first", "at", "context").repartition("key").sortWithinPartitions("key").mapInArrow(run, f"doc long, mark binary, spans {SPANS}")


def _settled(rims: DataFrame, length: int) -> Iterator[DataFrame]:
    """Spans (doc, mark, spans) of the repeats inside the rims; seeds with too many stretches are made longer until none has."""
    while True:
        hot = written(rims.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("key"), "hot")
        if hot.isEmpty():
            yield _sorted_rims(rims, length)
            return
        yield _sorted_rims(rims.join(hot, "key", "left_anti"), length)
        parts = written(_longer(rims.join(hot, "key", "left_semi"), length), "longer")
        classes = written(parts.groupBy("key", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("width", "doc", "mark", "first", "at", "context")).alias("one")), "classes")
        span = F.struct(F.col("first").alias("start"), (F.col("first") + F.length("context")).alias("end"))
        yield parts.join(written(classes.filter("n > 1").select("key", "d1", "d2"), "equal"), ["key", "d1", "d2"]).select("doc", "mark", F.array(span).alias("spans"))
        rims = classes.filter("one.width > 0").select("key", "one.*")


def repeated_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Spans of bytes to remove, by document key (doc, mark); they may overlap."""
    rows = written(stretch_rows(_keyed(docs, doc_id, text), length, seed), "stretches")
    differ = (F.min("d1") < F.max("d1")) | (F.min("d2") < F.max("d2"))
    seeds = written(rows.groupBy("seed").agg(F.count("*").alias("n"), differ.alias("mixed")).filter("n > 1").select("seed", "mixed"), "seeds")
    again = written(rows.join(seeds, "seed"), "repeats")
    forget(rows, seeds)
    full = F.array(F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("end"))).alias("spans")
    mixed = again.filter("mixed").drop("mixed")
    classes = written(mixed.groupBy("seed", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "mark", "first", "last")).alias("one")), "classes")
    equal = written(classes.filter("n > 1").select("seed", "d1", "d2"), "equal")
    wants = classes.groupBy("one.doc", "one.mark").agg(F.collect_list(F.struct("seed", "one.first", "one.last")).alias("wants"))
    rims = written(_rims(_packed(docs, doc_id, text).drop("doc_id").dropDuplicates(["doc", "mark"]).join(wants, ["doc", "mark"]), length, seed), "rims")
    out = again.filter("not mixed").select("doc", "mark", full).union(mixed.join(equal, ["seed", "d1", "d2"]).select("doc", "mark", full))
    for found in _settled(rims, length):
        out = out.union(found)
    # a set: rows with one id and text have the same spans
    spans = written(out.groupBy("doc", "mark").agg(F.flatten(F.collect_set("spans")).alias("spans")), "spans")
    return spans


def cut_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_bytes, spans (merged, in bytes) and kept (the remaining bytes) of every document."""
    with scratch() as keep:
        spans = keep(repeated_spans(docs, doc_id=doc_id, text=text, length=length, seed=seed))
    joined = _packed(docs, doc_id, text).join(spans, ["doc", "mark"], "left").select("doc_id", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            sizes, merged, kept = [], [], []
            for packed, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = unpack(packed)
                out: list[list[int]] = []
                for a, b in sorted((s["start"], s["end"]) for s in own or ()):
                    if out and a <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], b)
                    else:
                        out.append([a, b])
                cuts = [0, *(x for s in out for x in s), len(raw)]
                sizes.append(len(raw))
                merged.append([{"start": a, "end": b} for a, b in out])
                kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(merged, _SPANS), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_bytes long, spans {SPANS}, kept binary")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: bytes, bytes and spans removed, and the SHA-256 of what is left."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]).cast("long"))
    return cut_documents(docs, **options).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The contract, string by string, for tests."""
    raw = [(t or "").encode() for t in texts]
    count: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            count[r[i : i + length]] = count.get(r[i : i + length], 0) + 1
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out
