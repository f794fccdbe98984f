"""Vectorised helpers over the UTF-8 bytes of an Arrow text column.

Texts are handled as whole documents, in slices of documents of about
``max_bytes``; a longer document is a slice of its own. Null is the empty text.
"""

from __future__ import annotations

import ctypes
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 1 << 64)
_TABLE = np.random.RandomState(7).randint(0, 1 << 62, 256).astype(U64) * U64(4) + U64(1)
#: ASCII capitals hash as their small letters.
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

#: Word bytes: ASCII letters and digits, and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n."""
    if len(_POWERS[0]) <= n:
        for k, base in enumerate((BASE, _INV)):
            steps = np.full(n + 1, base, U64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def trim_powers(keep: int = 1 << 21) -> None:
    """Forget the powers that one very long document needed."""
    for k in (0, 1):
        if len(_POWERS[k]) > keep:
            _POWERS[k] = _POWERS[k][:keep].copy()


def release() -> None:
    """Gives memory that is free back to the system: a worker lives on, for tasks of other kinds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library has no such call
        pass


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(29))


class Hashes:
    """Prefix polynomial hashes of a byte slice: any substring's hash in O(1)."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        n = len(data)
        pw, self.inverse = powers(n)
        self.prefix = np.zeros(n + 1, U64)
        terms = (_FOLDED if fold else _TABLE)[data]
        terms *= pw[:n]
        np.cumsum(terms, out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])


def slices(column, max_bytes: int = 1 << 20):
    """Yields (first, last, bytes, offsets) of runs of whole documents."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        last = min(last, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    release()


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that don't cross documents."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts[(cuts > 0) & (cuts <= n)] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hashes, starts, ends, first word of each document and the end) of a slice."""
    starts, ends = runs(WORD[data], offsets)
    return Hashes(data, fold=True).of(starts, ends), starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, n: int):
    """Hashes of n consecutive words, and the bounds by document.

    A document with fewer words, but not none, has one shingle: all its words.
    """
    total = len(words)
    if total >= n:
        rolled = np.zeros(total - n + 1, U64)
        for j in range(n):
            rolled += words[j : total - n + 1 + j] * U64(pow(BASE, 2 * j + 3, 1 << 64))
        rolled = mix(rolled)
    else:
        rolled = np.zeros(0, U64)
    counts = np.diff(bounds)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(made)
    out_bounds = np.concatenate(([0], ends))
    index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(bounds[:-1] - out_bounds[:-1], made)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if not len(short):
        return rolled[index], out_bounds
    out = np.empty(len(index), U64)
    whole = np.ones(len(index), bool)
    whole[out_bounds[:-1][short]] = False
    out[whole] = rolled[index[whole]]
    for d in short:
        h = U64(counts[d])
        for w in words[bounds[d] : bounds[d + 1]]:
            h = mix(np.array([h], U64) * U64(BASE) + w)[0]
        out[out_bounds[d]] = h
    return out, out_bounds


def text_mark(text: str) -> Column:
    """128 bits of a text's SHA-256; with an id the key of a text, so that repeated and missing ids do no harm."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def row_mark(doc_id: str, text: str) -> Column:
    """128 bits of the SHA-256 of an id and its text: one key, never null, for rows that are the same in both."""
    named = F.concat(F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("")), F.lit("\0"), F.coalesce(F.col(text), F.lit("")))
    return F.unhex(F.substring(F.sha2(named, 256), 1, 32))


def shared_folder(spark, kind: str) -> str:
    """A fresh folder in the one that the cluster shares (spark.checkpoint.dir).

    Only on one machine and where that setting is absent, as in tests, a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df, kind: str):
    """df as a table in the shared folder: lineage ends there and survives lost executors."""
    path = shared_folder(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


#: Tables of the scopes that are open, the innermost last.
_OPEN: list[list] = []


@contextmanager
def scratch():
    """Tables written inside are deleted at the end, but for those that are given to what this yields: a result reads them."""
    kept = []

    def keep(df):
        kept.append(df)
        return df

    _OPEN.append([])
    try:
        yield keep
    finally:
        tables = _OPEN.pop()
        forget(*(t for t in tables if not any(t is k for k in kept)))
        if _OPEN:
            _OPEN[-1] += kept


def forget(*tables) -> None:
    """Deletes tables of ``written`` that nothing reads any more: all that was made of them is written too."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
