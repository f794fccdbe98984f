"""Operator 5: token ids in files of independent zstandard frames with a seek table.

File format. One frame for each document: its ids, little-endian, in 2 bytes if
the vocabulary fits and else 4. Then two skippable frames: the directory (a
small header with the width of an id, and the doc_ids, zstandard-compressed)
and, last, the seek table of the public seekable format: for each frame its
compressed size, its plain size and the low 32 bits of its XXH64, then the
number of frames, a descriptor and the magic number. A reader finds the table
from the end of the file, and reads and decompresses only the frames it wants.

Null is the empty text; an empty document still has its end id. Repeated
doc_ids keep their rows, next to each other, in no order among themselves. A null
doc_id sorts first. An empty table gives no files and no rows. Other columns play
no part. A frame holds one document and the seek table has 4 bytes for its size:
a document of 4 GiB of ids or more is an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._text import U64, Hashes, runs, shared_folder, slices

#: Fixed values of the public seekable format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DESCRIPTOR = 0x80  # entries have checksums
FOOTER = struct.Struct("<IBI")
DIRECTORY = struct.Struct("<BBxxI")  # version, bytes of an id, number of documents

#: Bytes of text that are encoded at once; words are remembered beyond it.
BLOCK = 4 << 20
_SPACE = np.ones(256, bool)
_SPACE[[10, 32]] = False


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _same_bytes(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which strings of these sizes, at ``at`` in a and ``bt`` in b, are equal; 8 bytes at a time. Both have 8 bytes to spare."""
    same = np.ones(len(sizes), bool)
    left, right = (np.lib.stride_tricks.sliding_window_view(x, 8) for x in (a, b))
    for k in range(0, int(sizes.max(initial=0)), 8):
        own = np.flatnonzero(sizes > k)
        if k >= 64:  # long ones one by one
            for w in own.tolist():
                n = sizes[w]
                same[w] &= bool((a[at[w] : at[w] + n] == b[bt[w] : bt[w] + n]).all())
            break
        x, y = left[at[own] + k].view("<u8")[:, 0], right[bt[own] + k].view("<u8")[:, 0]
        rest = np.minimum(sizes[own] - k, 8).astype(U64)
        keep = np.where(rest == 8, U64(2**64 - 1), (U64(1) << (rest % U64(8) * U64(8))) - U64(1))
        same[own] &= (x & keep) == (y & keep)
    return same


class WordIds:
    """Words met so far, by hash, with their bytes and ids; forgotten when there are too many."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, U64)
        self.text_at, self.size, self.id_at, self.n = (np.zeros(0, np.int32) for _ in range(4))
        self.text, self.ids = np.zeros(8, np.uint8), np.zeros(0, self.dtype)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        at = np.searchsorted(self.hashes, hashes)
        found = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        found[inside] = self.hashes[at[inside]] == hashes[inside]
        return np.where(found, at, -1)

    def add(self, hashes: np.ndarray, texts: list[bytes], ids: list[np.ndarray]) -> None:
        size, n = np.array([len(t) for t in texts], np.int64), np.array([len(x) for x in ids], np.int64)
        text_at, id_at = len(self.text) - 8 + np.cumsum(size) - size, len(self.ids) + np.cumsum(n) - n
        self.text = np.concatenate((self.text[:-8], np.frombuffer(b"".join(texts), np.uint8), np.zeros(8, np.uint8)))
        self.ids = np.concatenate((self.ids, *ids)).astype(self.dtype)
        order = np.argsort(both := np.concatenate((self.hashes, hashes)), kind="stable")
        self.hashes = both[order]
        for name, new in (("text_at", text_at), ("size", size), ("id_at", id_at), ("n", n)):
            setattr(self, name, np.concatenate((getattr(self, name), new.astype(np.int32)))[order])


class WordEncoder:
    """Encodes texts word by word, each different word once as long as it is remembered.

    For tokenizers whose normaliser and splitter never look across a space or a
    line end, as those of word_bpe_49k: the ids of a text are those of its words.
    """

    SEPARATOR = "\x01"
    #: Words that are remembered, about, and bytes of a word that is.
    WORDS, LONG = 1 << 20, 256

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = _tokenizer(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.separator = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.known = WordIds(self.dtype)

    def words(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each word; many go through the tokenizer as one text, with a separator that none of them has."""
        out: list[np.ndarray] = []
        for k in range(0, len(texts), 2000):
            part = texts[k : k + 2000]
            ids = None
            if len(self.separator) == 1:
                joined = f" {self.SEPARATOR} ".join(part)
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
                cuts = np.flatnonzero(ids == self.separator[0])
            if ids is not None and len(cuts) == len(part) - 1:
                starts = np.concatenate(([0], cuts + 1))
                ends = np.concatenate((cuts, [len(ids)]))
                out += [ids[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            else:
                out += [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice of documents, and the bounds by document."""
        starts, ends = runs(_SPACE[data], offsets)
        hashes, sizes = np.empty(len(starts), U64), ends - starts
        # hashes in parts, as the prefix hashes take 8 times the text
        part = 1 << 20
        for a in range(0, len(data), part):
            i, j = np.searchsorted(starts, [a, a + part])
            if i < j:
                lo, hi = int(starts[i]), int(ends[j - 1])
                hashes[i:j] = Hashes(data[lo:hi]).of(starts[i:j] - lo, ends[i:j] - lo)
        different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, size, padded = starts[first], sizes[first], np.concatenate((data, np.zeros(8, np.uint8)))
        known = self.known
        if len(known.hashes) + len(different) > self.WORDS:
            known.clear()
        place = known.find(different)
        new = np.flatnonzero(place < 0)
        if len(new):
            raw = data.tobytes()
            texts = [raw[s : s + n] for s, n in zip(at[new].tolist(), size[new].tolist(), strict=True)]
            known.add(different[new], texts, self.words([t.decode() for t in texts]))
            place = known.find(different)
        # a word must be the one that is remembered, byte by byte
        if not ((size == known.size[place]).all() and (sizes == size[inverse]).all() and _same_bytes(padded, at, known.text, known.text_at[place].astype(np.int64), size).all() and _same_bytes(padded, starts, padded, at[inverse], sizes).all()):
            raise ValueError("two words share a 64-bit hash")  # the caller encodes this slice text by text
        counts = known.n[place][inverse].astype(np.int64)
        ends_out = np.cumsum(counts)
        total = int(ends_out[-1]) if len(ends_out) else 0
        index = np.arange(total) + np.repeat(known.id_at[place][inverse] - (ends_out - counts), counts)
        bounds = np.concatenate(([0], ends_out))[np.searchsorted(starts, offsets)]
        out = known.ids[index], bounds
        if (size > self.LONG).any():  # very long words would fill the memory
            known.clear()
        return out

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        try:
            return self.encode(data, offsets)
        except ValueError:
            raw = data.tobytes()
            ids = [np.array(self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids, self.dtype) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            return np.concatenate(ids), np.concatenate(([0], np.cumsum([len(x) for x in ids])))


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """A worker's encoder; it remembers words from task to task."""
    return WordEncoder(path)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class FrameWriter:
    """Writes one file; documents come in order."""

    def __init__(self, sink, width: int, level: int = 1):
        self.sink, self.width = sink, width
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.entries, self.keys = bytearray(), []

    def add(self, key: int | None, ids: bytes) -> None:
        frame = self.pack(ids)
        self.sink.write(frame)
        self.entries += struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
        self.keys.append(key)

    def close(self) -> None:
        keys = pa.array(self.keys, pa.int64())
        valid = np.packbits(np.asarray(keys.is_valid()))
        body = self.pack(valid.tobytes() + np.asarray(keys.fill_null(0)).astype("<i8").tobytes())
        directory = _skippable(SKIPPABLE_DIRECTORY, DIRECTORY.pack(1, self.width, len(keys)) + body)
        frame = directory
        entries = bytes(self.entries) + struct.pack("<III", len(frame), 0, 0)
        self.sink.write(frame)
        self.sink.write(_skippable(SKIPPABLE_SEEK_TABLE, entries + FOOTER.pack(len(entries) // 12, DESCRIPTOR, SEEKABLE_MAGIC)))
        self.sink.close()


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n, descriptor, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError("not a file of seekable frames")
        table = self._at(end - FOOTER.size - 12 * n, 12 * n)
        self.table = np.frombuffer(table, "<u4").reshape(n, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0].astype(np.int64))))
        directory = self._at(int(self.starts[n - 1]), int(self.table[n - 1, 0]))
        magic, _ = struct.unpack_from("<II", directory)
        _, self.width, self.n = DIRECTORY.unpack_from(directory, 8)
        body = zstandard.ZstdDecompressor().decompress(directory[8 + DIRECTORY.size :])
        nulls = (self.n + 7) // 8
        valid = np.unpackbits(np.frombuffer(body[:nulls], np.uint8), count=self.n).astype(bool)
        self.keys = [k if ok else None for k, ok in zip(np.frombuffer(body[nulls:], "<i8").tolist(), valid.tolist(), strict=True)]
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _at(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def lengths(self) -> np.ndarray:
        """Ids of each document, from the table alone."""
        return self.table[: self.n, 1].astype(np.int64) // self.width

    def document(self, k: int) -> np.ndarray:
        packed, plain, checksum = self.table[k].tolist()
        ids = self.unpack(self._at(int(self.starts[k]), packed), max_output_size=plain or 1)
        if len(ids) != plain or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(ids, f"<u{self.width}")


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Writes docs in ascending doc_id order; returns the manifest (part, file, n_docs, n_tokens).

    Each task writes its files under a name of its own attempt; the manifest
    names those of the attempts that count, so lost executors leave no trace in it.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        filesystem, root = pafs.FileSystem.from_uri(folder)
        part = context.partitionId()
        name = f"part-{part:06d}-{context.taskAttemptId()}.zst"
        writer, encoder, n_docs, n_tokens = None, None, 0, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            if not keys:
                continue
            if writer is None:
                encoder = encoder_of(tokenizer_path)
                filesystem.create_dir(root, recursive=True)
                writer = FrameWriter(filesystem.open_output_stream(f"{root}/{name}", compression=None), encoder.dtype.itemsize)
            end = np.array([end_id], encoder.dtype).tobytes()
            for first, last, data, offsets in slices(batch.column(1), BLOCK):
                ids, bounds = encoder.slice(data, offsets)
                raw, width, at = ids.tobytes(), encoder.dtype.itemsize, bounds.tolist()
                for k in range(last - first):
                    writer.add(keys[first + k], raw[at[k] * width : at[k + 1] * width] + end)
                n_docs += last - first
                n_tokens += len(ids) + last - first
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [n_docs], "n_tokens": [n_tokens]}, pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return ordered.mapInArrow(run, "part int, file string, n_docs long, n_tokens long")


def read_tokens(spark: SparkSession, folder: str, manifest: list[tuple[str, int]]) -> DataFrame:
    """Documents of the files (file, ids before it): doc_id, start, n_tokens, ids_crc32."""
    files = spark.createDataFrame(manifest, "file string, base long").repartition(max(1, len(manifest)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with filesystem.open_input_file(f"{root}/{file}") as source:
                    reader = FrameReader(source)
                    sizes = reader.lengths()
                    starts = base + np.concatenate(([0], np.cumsum(sizes)))[:-1]
                    for a in range(0, reader.n, 10_000):
                        b = min(a + 10_000, reader.n)
                        crc = [zlib.crc32(reader.document(k).astype("<u4").tobytes()) for k in range(a, b)]
                        yield pa.RecordBatch.from_arrays([pa.array(reader.keys[a:b], pa.int64()), pa.array(starts[a:b]), pa.array(sizes[a:b]), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, *, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Writes docs, reads the files back, and returns what the files say of each document.

    The driver holds one row for each file, as many as there are partitions.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    base, manifest = 0, []
    for row in sorted(write_tokens(docs, folder, tokenizer_path, end_id=end_id).collect()):
        manifest.append((row["file"], base))
        base += row["n_tokens"]
    return read_tokens(spark, folder, manifest)
