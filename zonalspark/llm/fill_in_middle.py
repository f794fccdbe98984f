"""Operator 12: fill-in-the-middle, with a sparse index of checkpoints in each text.

A unit is a run of other characters with the ASCII white space before it, or the
white space that ends the text. While a text's units are counted, chunk by chunk,
a checkpoint is recorded every ``EVERY`` units: units, bytes and code points so
far. A cut after k units is found by binary search among the checkpoints and a
short scan of the bytes from there. What is kept of a text is its checkpoints, not
its units.

Two cuts, drawn from a hash of the seed and the id, part a text into prefix,
middle and suffix; the form says in which order they are put out, each behind its
mark. ``restore`` gives the exact text back.

A null text is the empty one; the empty text, and a text that holds a mark, stays
plain, as ``rate`` says for others. Two equal cuts give an empty middle, which is
no special case. A null id has the seed alone as its name; rows with one id are cut
by the same numbers, repeated rows alike. Ids of any type work: their decimal or
text form is hashed. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import slices

#: Units between checkpoints, and bytes counted, or scanned for a cut, at a time.
EVERY, CHUNK, SCAN = 256, 1 << 16, 1 << 11
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
#: Of a hundred texts, those that are rearranged, and of a hundred of these, those with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
SPACE = np.zeros(256, bool)
SPACE[9:14] = SPACE[32] = True


class Checkpoints:
    """The units of a text's bytes: how many, and a checkpoint every so many of them."""

    def __init__(self, data: np.ndarray, every: int = EVERY, chunk: int = CHUNK):
        self.data = data
        self.units, self.bytes, self.points = [0], [0], [0]
        n = points = 0
        for a in range(0, len(data), chunk):
            b = min(a + chunk, len(data))
            ends = self._ends(a, b)
            at = ends[every - 1 - n % every :: every]
            if len(at):
                # code points in the stretches between the checkpoints, never kept for each byte
                cuts = np.concatenate(([a], at[:-1]))
                stretch = [_points(data[s:e]) for s, e in zip(cuts.tolist(), at.tolist(), strict=True)]
                self.units += range((n // every + 1) * every, (n // every + 1 + len(at)) * every, every)
                self.bytes += at.tolist()
                self.points += (points + np.cumsum(stretch)).tolist()
            n += len(ends)
            points += _points(data[a:b])
        self.n, self.n_points = n, points

    def _ends(self, a: int, b: int) -> np.ndarray:
        """Bytes in (a, b] at which a unit ends."""
        space = SPACE[self.data[a : b + 1]]
        before = space[: b - a]
        if b < len(self.data):
            return np.flatnonzero(~before & space[1:]) + (a + 1)
        last = np.empty(b - a, bool)
        last[:-1] = ~before[:-1] & before[1:]
        last[-1] = True  # the text ends: with a word or with white space
        return np.flatnonzero(last) + (a + 1)

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first k units."""
        i = bisect_right(self.units, k) - 1
        n, at, points = self.units[i], self.bytes[i], self.points[i]
        while n < k:
            b = min(at + SCAN, len(self.data))
            ends = self._ends(at, b)
            if n + len(ends) >= k:
                b = int(ends[k - n - 1])
            n, points, at = n + len(ends), points + _points(self.data[at:b]), b
        return at, points


def _points(data: np.ndarray) -> int:
    """Code points that begin in these bytes."""
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


def numbers(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(name[k : k + 8], 16) for k in (0, 8, 16, 24))


def rearranged(doc_id, data: np.ndarray, *, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output)."""
    index, text = Checkpoints(data), data.tobytes()
    h1, h2, h3, h4 = numbers(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return index.n, "plain", None, None, text
    low, high = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    (a, prefix), (b, both) = index.cut(low), index.cut(high)
    spm = h4 % 100 < suffix_first
    first, rest = PREFIX + text[:a], SUFFIX + text[b:]
    return index.n, "spm" if spm else "psm", prefix, both - prefix, (rest + first if spm else first + rest) + MIDDLE + text[a:b]


def restore(output: bytes, form: str) -> bytes:
    """The text that gave this output: no piece holds a mark, and no mark ends as another begins."""
    if form == "plain":
        return output
    (at, mark) = (len(PREFIX), SUFFIX) if form == "psm" else (len(SUFFIX), PREFIX)
    second, third = output.index(mark), output.index(MIDDLE)
    one, two, middle = output[at:second], output[second + len(mark) : third], output[third + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def transform(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", digests: bool = False, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output, or digests of the output and of the text restored from it."""
    last = ["output_sha256", "restored_sha256"] if digests else ["output"]
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, {', '.join(f'{c} string' for c in last)}"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(last)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in slices(batch.column(1)):
                rows = []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    n, form, prefix, middle, output = rearranged(ids[first + i].as_py(), data[a:b], **options)
                    rows.append((n, form, prefix, middle, *((hashlib.sha256(output).hexdigest(), hashlib.sha256(restore(output, form)).hexdigest()) if digests else (output.decode(),))))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(first, end - first), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *last])

    return docs.select(doc_id, text).mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    return transform(docs, digests=True)


_UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SQL = f"""
with cut as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_UNITS}') as u, sha256('42:' || coalesce(doc_id::varchar, '')) as h
  from documents
), drawn as (
  select *, len(u) as n, {', '.join(f"('0x' || substr(h, {8 * k + 1}, 8))::bigint as h{k + 1}" for k in range(4))} from cut
), parted as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from drawn
), pieces as (
  select *, array_to_string(u[:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from parted
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from pieces
"""
