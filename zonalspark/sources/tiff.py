"""The TIFF format: directories, blocks and their compression, classic and large files.

A file is read by ranges: its directory first, then of the tables of block offsets
only the entries that are asked for, then the bytes of those blocks. The first image
is read; several bands lie side by side or one after the other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Fixed values of the format: sizes of field types, tags, kinds of samples, and compressions.
_SIZES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 7: "c", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, PACKED, COLOUR, STRIPS, BANDS, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, KIND, SCALE, TIE, GEO_KEYS, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
_KINDS = {1: "u", 2: "i", 3: "f"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS, ZSTD = 1, 5, 8, 32946, 32773, 50000
COMPRESSIONS = {"none": NONE, "lzw": LZW, "deflate": DEFLATE, "zstd": ZSTD}
#: Keys of the projection: the model (1 projected, 2 geographic), the raster type, and the EPSG number of either model.
_MODEL, _RASTER, _GEOGRAPHIC, _PROJECTED = 1024, 1025, 2048, 3072
_LZW_CLEAR, _LZW_END, _LZW_MOST = 256, 257, 4094

Read = Callable[[int, int], bytes]


@dataclass(frozen=True)
class Field:
    """Where the values of a tag are: in the file, or in the directory itself."""

    kind: int
    count: int
    place: int
    own: bytes = b""

    def values(self, read: Read, order: str, first: int = 0, last: int | None = None) -> tuple:
        """The values from first to last, and no others."""
        last = self.count if last is None else last
        size = struct.calcsize(_SIZES[self.kind])
        raw = self.own[first * size : last * size] if self.own else read(self.place + first * size, (last - first) * size)
        return struct.unpack(f"{order}{last - first}{_SIZES[self.kind]}", raw)


@dataclass(frozen=True)
class Layout:
    """What a directory says of an image and of its blocks."""

    order: str
    width: int
    height: int
    dtype: str
    bands: int
    apart: bool
    packed: int
    predictor: int
    nodata: float | None
    block_width: int
    block_height: int
    offsets: Field = field(repr=False)
    sizes: Field = field(repr=False)
    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0
    epsg: int | None = None

    @property
    def across(self) -> int:
        return -(-self.width // self.block_width)

    @property
    def down(self) -> int:
        return -(-self.height // self.block_height)


def layout(read: Read) -> Layout:
    """The layout of a file's first image."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(order + "H", head[2:4])[0] if order else None
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    word, number, entry = ("Q", "Q", 20) if big else ("I", "H", 12)
    at = struct.unpack_from(order + word, head, 8 if big else 4)[0]
    size = struct.calcsize(number)
    n = struct.unpack(order + number, read(at, size))[0]
    raw = read(at + size, n * entry)
    tags: dict[int, Field] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HH{word}", raw, k * entry)
        if kind not in _SIZES:
            continue
        inside = raw[k * entry + 4 + struct.calcsize(word) : (k + 1) * entry]
        length = struct.calcsize(f"{order}{count}{_SIZES[kind]}")
        tags[tag] = Field(kind, count, 0, inside[:length]) if length <= len(inside) else Field(kind, count, struct.unpack(order + word, inside)[0])
    get = lambda tag, other=None: tags[tag].values(read, order) if tag in tags else other
    width, height, bits, bands = get(WIDTH)[0], get(HEIGHT)[0], get(BITS, (1,)), get(BANDS, (1,))[0]
    kind, packed, predictor = get(KIND, (1,))[0], get(PACKED, (1,))[0], get(PREDICTOR, (1,))[0]
    if kind not in _KINDS or len(set(bits)) > 1 or bits[0] not in (8, 16, 32, 64) or packed not in (NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS, ZSTD) or predictor not in (1, 2, 3):
        raise ValueError(f"samples of kind {kind} and {bits} bits, compression {packed} or predictor {predictor}")
    tiled = TILES in tags
    block = (get(TILE_WIDTH)[0], get(TILE_HEIGHT)[0]) if tiled else (width, min(get(STRIP_ROWS, (height,))[0], height))
    scale, tie, keys = get(SCALE, (1.0, 1.0, 0.0)), get(TIE, (0.0,) * 6), get(GEO_KEYS, ())
    epsg = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    return Layout(
        order, width, height, f"{order}{_KINDS[kind]}{bits[0] // 8}", bands, bands > 1 and get(PLANAR, (1,))[0] == 2, packed, predictor,
        float(b"".join(get(NODATA)).strip(b"\0 ")) if NODATA in tags else None, *block, tags[TILES if tiled else STRIPS], tags[TILE_BYTES if tiled else STRIP_BYTES],
        tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1], epsg.get(_PROJECTED, epsg.get(_GEOGRAPHIC)),
    )


def blocks(read: Read, at: Layout, rows: tuple[int, int], columns: tuple[int, int], band: int = 0) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, first column, values) of the blocks in these rows and columns of blocks; nodata is NaN."""
    plane = band * at.across * at.down if at.apart else 0
    for r in range(*rows):
        first, last = plane + r * at.across + columns[0], plane + r * at.across + columns[1]
        places, sizes = at.offsets.values(read, at.order, first, last), at.sizes.values(read, at.order, first, last)
        for c, place, size in zip(range(*columns), places, sizes, strict=True):
            row, col = r * at.block_height, c * at.block_width
            # a block of no bytes is one without values
            values = decoded(read(place, size), at, band) if size else np.full((at.block_height, at.block_width), np.nan)
            values = values[: at.height - row, : at.width - col].astype(float)
            yield row, col, np.where(values == at.nodata, np.nan, values) if at.nodata is not None else values


def decoded(raw: bytes, at: Layout, band: int = 0) -> np.ndarray:
    """The values of one band of a block."""
    dtype, bands = np.dtype(at.dtype), 1 if at.apart else at.bands
    width = at.block_width * bands
    size = width * dtype.itemsize
    raw = unpacked(raw, at.packed, size * at.block_height)
    rows = len(raw) // size  # the last strip may have fewer
    if at.predictor == 3:
        planes = np.cumsum(np.frombuffer(raw, np.uint8, rows * size).reshape(rows, -1, bands), axis=1, dtype=np.uint8)
        # the most significant bytes of a row come first
        bytewise = planes.reshape(rows, dtype.itemsize, width).transpose(0, 2, 1)
        values = np.ascontiguousarray(bytewise).view(f">{dtype.kind}{dtype.itemsize}").reshape(rows, at.block_width, bands)
    else:
        values = np.frombuffer(raw, dtype, rows * width).reshape(rows, at.block_width, bands)
        if at.predictor == 2:
            # differences are of the bits, whatever they stand for
            bits = np.cumsum(values.view(f"{at.order}u{dtype.itemsize}"), axis=1, dtype=f"u{dtype.itemsize}")
            values = bits.view(dtype.newbyteorder("="))
    return values[:, :, 0 if at.apart else band]


def unpacked(raw: bytes, packed: int, size: int) -> bytes:
    """The bytes of a block of so many at most."""
    if packed in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(raw)
    if packed == ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
    if packed == LZW:
        return _from_lzw(raw, size)
    return _from_packbits(raw) if packed == PACKBITS else raw


def _from_packbits(raw: bytes) -> bytes:
    out, k = bytearray(), 0
    while k < len(raw):
        n = raw[k]
        if n < 128:
            out += raw[k + 1 : k + 2 + n]
            k += n + 2
        else:
            if n > 128:
                out += raw[k + 1 : k + 2] * (257 - n)
            k += 1 + (n > 128)
    return bytes(out)


def _from_lzw(raw: bytes, size: int) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first; a width grows one code early."""
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    words, out, length = single.copy(), [], 0
    held = bits = 0
    width, last = 9, None
    for byte in raw:
        held = (held << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == _LZW_CLEAR:
            words, width, last = single.copy(), 9, None
            continue
        if code == _LZW_END:
            break
        if last is None:
            word = words[code]
        else:
            word = words[code] if code < len(words) else last + last[:1]
            words.append(last + word[:1])
            if len(words) >= (1 << width) - 1 and width < 12:
                width += 1
        out.append(word)
        last = word
        length += len(word)
        if length >= size:
            break
    return b"".join(out)[:size]


def _to_lzw(data: bytes) -> bytes:
    single = {bytes([i]): i for i in range(256)}
    words, width, nxt, held, bits = dict(single), 9, 258, _LZW_CLEAR, 9
    out, word = bytearray(), b""

    def put(code: int) -> None:
        nonlocal held, bits
        held = (held << width) | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    for k in range(len(data)):
        longer = word + data[k : k + 1]
        if longer in words:
            word = longer
            continue
        put(words[word])
        words[longer] = nxt
        nxt += 1
        if nxt >= _LZW_MOST:
            put(_LZW_CLEAR)
            words, width, nxt = dict(single), 9, 258
        elif nxt >= 1 << width:
            width += 1
        word = data[k : k + 1]
    if word:
        put(words[word])
        nxt += 1
        if nxt >= 1 << width and width < 12:
            width += 1
    put(_LZW_END)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)


def encoded(values: np.ndarray, packed: int, predictor: int) -> bytes:
    """The bytes of a block of one band, little-endian."""
    dtype = values.dtype.newbyteorder("<")
    values = np.ascontiguousarray(values, dtype)
    rows = len(values)
    if predictor == 3:
        planes = values.astype(dtype.newbyteorder(">")).view(np.uint8).reshape(rows, -1, dtype.itemsize).transpose(0, 2, 1).reshape(rows, -1)
        raw = np.diff(planes, axis=1, prepend=np.zeros((rows, 1), np.uint8)).astype(np.uint8).tobytes()
    elif predictor == 2:
        bits = values.view(f"<u{dtype.itemsize}")
        raw = np.diff(bits, axis=1, prepend=np.zeros((rows, 1), bits.dtype)).astype(bits.dtype).tobytes()
    else:
        raw = values.tobytes()
    if packed == DEFLATE:
        return zlib.compress(raw)
    if packed == ZSTD:
        import zstandard

        return zstandard.ZstdCompressor().compress(raw)
    return _to_lzw(raw) if packed == LZW else raw


def assembled(
    packed_blocks: list[bytes], *, width: int, height: int, dtype: np.dtype, block: tuple[int, int], tiled: bool, packed: int, predictor: int = 1,
    x0: float = 0.0, y0: float = 0.0, dx: float = 1.0, dy: float = 1.0, nodata: float | None = None, epsg: int | None = None, big: bool | None = None,
) -> Iterator[bytes]:
    """A file of one band in pieces: the head with its directory, then the blocks. big: by size if not given."""
    kind = {"u": 1, "i": 2, "f": 3}[dtype.kind]
    sizes = [len(b) for b in packed_blocks]
    big = sum(sizes) + 24 * len(sizes) > 4_000_000_000 if big is None else big
    word, number, long, inside = ("Q", "Q", 16, 8) if big else ("I", "H", 4, 4)
    geographic = epsg is not None and 4000 <= epsg < 5000
    keys = [] if epsg is None else [1, 1, 0, 3, _MODEL, 0, 1, 2 if geographic else 1, _RASTER, 0, 1, 1, _GEOGRAPHIC if geographic else _PROJECTED, 0, 1, epsg]
    shape = [(TILE_WIDTH, 4, [block[0]]), (TILE_HEIGHT, 4, [block[1]]), (TILES, long, [0] * len(sizes)), (TILE_BYTES, long, sizes)] if tiled else [(STRIPS, long, [0] * len(sizes)), (STRIP_ROWS, 4, [block[1]]), (STRIP_BYTES, long, sizes)]
    tags = sorted([
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [dtype.itemsize * 8]), (PACKED, 3, [packed]), (COLOUR, 3, [1]), (BANDS, 3, [1]), (PREDICTOR, 3, [predictor]), (KIND, 3, [kind]), *shape,
        (SCALE, 12, [dx, dy, 0.0]), (TIE, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), *([(GEO_KEYS, 3, keys)] if keys else []), *([(NODATA, 2, [bytes([b]) for b in f"{nodata:g}\0".encode()])] if nodata is not None else []),
    ])
    bodies = {tag: struct.pack(f"<{len(v)}{_SIZES[t]}", *v) for tag, t, v in tags}
    head = 16 if big else 8
    at = head + struct.calcsize("<" + number) + len(tags) * (20 if big else 12) + struct.calcsize("<" + word)
    places = {}
    for tag, body in bodies.items():
        if len(body) > inside:
            places[tag] = at
            at += len(body)
    starts = (at + np.cumsum([0, *sizes])[:-1]).tolist()
    bodies[TILES if tiled else STRIPS] = struct.pack(f"<{len(sizes)}{word}", *starts)
    yield struct.pack("<2sHHHQ", b"II", 43, 8, 0, head) if big else struct.pack("<2sHI", b"II", 42, head)
    yield struct.pack("<" + number, len(tags)) + b"".join(struct.pack(f"<HH{word}", tag, t, len(v)) + (struct.pack("<" + word, places[tag]) if tag in places else bodies[tag].ljust(inside, b"\0")) for tag, t, v in tags) + struct.pack("<" + word, 0)
    yield b"".join(bodies[tag] for tag in places)
    yield from packed_blocks
