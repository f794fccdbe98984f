"""Tiles as PNG files in folders by zoom and column: a sink whose files get their names at the commit."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .rasters import _system

_HEAD = b"\x89PNG\r\n\x1a\n"


def png(pixels: np.ndarray) -> bytes:
    """An image of rows, columns and four channels (red, green, blue, alpha) of eight bits."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = np.concatenate((np.zeros((len(pixels), 1), np.uint8), pixels.astype(np.uint8).reshape(len(pixels), -1)), axis=1)
    return _HEAD + chunk(b"IHDR", struct.pack(">2I5B", pixels.shape[1], pixels.shape[0], 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def from_png(raw: bytes) -> np.ndarray:
    """The pixels of a file of ``png``."""
    if raw[:8] != _HEAD:
        raise ValueError("not a PNG file")
    at, body, shape = 8, b"", (0, 0)
    while at < len(raw):
        size, kind = struct.unpack_from(">I4s", raw, at)
        part = raw[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", raw, at + 8 + size)[0] != zlib.crc32(kind + part):
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            shape = struct.unpack_from(">2I", part)
        body += part if kind == b"IDAT" else b""
        at += 12 + size
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(shape[1], -1)[:, 1:].reshape(shape[1], shape[0], 4)


def coloured(tiles: DataFrame, rgb, cells: str = "cells") -> DataFrame:
    """tiles with ``rgba``: four numbers for each cell in turn; rgb gives struct(r, g, b) of a cell. Without a value: 0, transparent."""
    def pixel(v: Column) -> Column:
        colour = rgb(v)
        return F.when(v.isNull(), F.array(*[F.lit(0)] * 4)).otherwise(F.array(*(colour[n].cast("int") for n in "rgb"), F.lit(255)))

    return tiles.withColumn("rgba", F.flatten(F.transform(cells, pixel)))


@dataclass
class Written(WriterCommitMessage):
    """(path as written, final path) of the files of a task."""

    files: list[tuple[str, str]]


class TileWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.size, self.run = options["path"], int(options["size"]), uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        system, inside = _system(self.path)
        done = []
        system.create_dir(f"{inside}/_writing-{self.run}")
        for row in iterator:
            place = f"{inside}/_writing-{self.run}/{uuid.uuid4().hex}.png"
            with system.open_output_stream(place) as out:
                out.write(png(np.array(row["rgba"], np.uint8).reshape(self.size, self.size, 4)))
            done.append((place, f"{inside}/{row['z']}/{row['x']}/{row['y']}.png"))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, inside = _system(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        for folder in sorted({path.rsplit("/", 1)[0] for _, path in files}):
            system.create_dir(folder)
        for place, path in files:
            system.move(place, path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, inside = _system(self.path)
        if system.get_file_info(f"{inside}/_writing-{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{inside}/_writing-{self.run}")


class TileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "png_tiles"

    def schema(self) -> str:
        return "z int, x int, y int, rgba array<int>"

    def writer(self, schema, overwrite: bool) -> TileWriter:
        return TileWriter(dict(self.options))


def write_pngs(tiles: DataFrame, path: str, size: int) -> None:
    """Tiles (z, x, y, rgba) as path/z/x/y.png. Files of a failed attempt never get a name; a tile that is there is replaced."""
    tiles.sparkSession.dataSource.register(TileSink)
    tiles.select("z", "x", "y", "rgba").write.format("png_tiles").option("path", path).option("size", size).mode("append").save()
