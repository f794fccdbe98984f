import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zonalspark.llm import token_output as to

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_force(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark):
    rng = random.Random(5)
    bits = ["a", "Hello,", "it's", "\x01", "x\x01y", "né", "é", "ΑΣ", " ", "\t", "\x1c", "<|endoftext|>", "12", "  ", "\n", "日本", "!?,", "z" * 90, "z" * 89 + "y", "İ"]
    rows = [(i * 3 % 101, " ".join(rng.choices(bits, k=rng.randrange(60)))) for i in range(101)] + [(500, None), (501, ""), (502, "word " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, to.round_trip(docs, PATH).collect())) == brute_force(rows)
    assert to.round_trip(docs.limit(0), PATH).collect() == []
    twice = to.round_trip(spark.createDataFrame([(7, "a", 1), (7, "a b", 1), (8, "c", 1)], "doc_id long, text string, start int"), PATH)
    assert [r["n_tokens"] for r in twice.orderBy("start").collect()][-1] == 2


def test_random_access_and_checksums():
    class Sink(io.BytesIO):
        def close(self):
            self.kept = self.getvalue()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    sink = Sink()
    writer = to.FrameWriter(sink, 2)
    for k, ids in enumerate(([5, 6], [], [7] * 1000)):
        writer.add([9, None, 11][k], np.array(ids, "<u2").tobytes())
    writer.close()
    reader = to.FrameReader(Source(sink.kept))
    assert reader.keys == [9, None, 11] and reader.lengths().tolist() == [2, 0, 1000]
    assert reader.document(2).tolist() == [7] * 1000 and reader.document(1).tolist() == []
    import zstandard

    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(sink.kept)[:4] == np.array([5, 6], "<u2").tobytes()
    broken = bytearray(sink.kept)
    broken[reader.starts[2] + 6] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        to.FrameReader(Source(bytes(broken))).document(2)
