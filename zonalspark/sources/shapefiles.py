"""Polygon shapefiles, zipped or not, as a data source: record ranges for partitions.

The index (.shx) says where each record is, so a member is read by many tasks. Of a
member that is stored plainly a task reads its own bytes; one that is packed has to be
unpacked up to the task's last record, so ranges are thousands of records. Attributes
alone come from the table (.dbf): no byte of the geometry is read. With a box, records
whose own bounds, in their heads, are apart from it are left out before they are parsed.
"""

from __future__ import annotations

import re
import struct
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.geometry import RING
from .files import one_shapefile
from .rasters import _system, files_of

#: Records of a partition.
RECORDS = 20_000
_HEAD = 100


def rings_of(record: bytes) -> list[list[tuple[float, float]]]:
    """Rings of one polygon record: box, counts, first point of each ring, points."""
    if len(record) < 44 or struct.unpack_from("<i", record)[0] not in (5, 15, 25):
        return []
    n, m = struct.unpack_from("<2i", record, 36)
    firsts = [*struct.unpack_from(f"<{n}i", record, 44), m]
    xy = struct.unpack_from(f"<{2 * m}d", record, 44 + 4 * n)
    return [[(xy[2 * i], xy[2 * i + 1]) for i in range(a, b)] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]


def meets(record: bytes, box: tuple[float, float, float, float]) -> bool:
    """Whether the bounds in a record's head meet a box (min_x, min_y, max_x, max_y)."""
    if len(record) < 36:
        return False
    a, b, c, d = struct.unpack_from("<4d", record, 4)
    return a <= box[2] and c >= box[0] and b <= box[3] and d >= box[1]


class Members:
    """The three parts of a shapefile, by ranges; counts the bytes that were read of each."""

    def __init__(self, path: str):
        system, inside = _system(path)
        self.read_bytes: dict[str, int] = {}
        self.archive = zipfile.ZipFile(system.open_input_file(inside)) if path.lower().endswith(".zip") else None
        shape = one_shapefile(self.archive.namelist()) if self.archive else inside
        self.names = {ext: re.sub(r"\.shp$", ext, shape, flags=re.I) for ext in (".shp", ".shx", ".dbf")}
        self.system = system
        if self.archive:  # names may be written in other cases
            there = {n.lower(): n for n in self.archive.namelist()}
            self.names = {ext: there.get(n.lower(), n) for ext, n in self.names.items()}

    def size(self, ext: str) -> int | None:
        name = self.names[ext]
        if self.archive:
            return self.archive.getinfo(name).file_size if name in self.archive.namelist() else None
        from pyarrow import fs

        info = self.system.get_file_info(name)
        return info.size if info.type == fs.FileType.File else None

    def read(self, ext: str, place: int, size: int) -> bytes:
        if self.archive:
            with self.archive.open(self.names[ext]) as part:
                part.seek(place)  # packed members are unpacked up to here, plain ones are not read
                out = part.read(size)
        else:
            with self.system.open_input_file(self.names[ext]) as part:
                out = part.read_at(size, place)
        self.read_bytes[ext] = self.read_bytes.get(ext, 0) + len(out)
        return out

    def records(self) -> int | None:
        """Records by the size of the index; None without one."""
        size = self.size(".shx")
        return None if size is None else (size - _HEAD) // 8

    def geometry(self, first: int, last: int) -> Iterator[bytes]:
        """The records from first to before last."""
        if self.records() is None:
            raw, at = self.read(".shp", 0, self.size(".shp")), _HEAD
            while at < len(raw):
                words = struct.unpack_from(">i", raw, at + 4)[0]
                yield raw[at + 8 : at + 8 + 2 * words]
                at += 8 + 2 * words
            return
        index = struct.unpack(f">{2 * (last - first)}i", self.read(".shx", _HEAD + 8 * first, 8 * (last - first)))
        if last > first:
            spans = [(2 * a, 2 * n) for a, n in zip(index[::2], index[1::2], strict=True)]
            start = min(a for a, _ in spans)
            raw = self.read(".shp", start, max(a + n + 8 for a, n in spans) - start)
            for a, n in spans:
                yield raw[a - start + 8 : a - start + 8 + n]

    def attributes(self, names: list[str], first: int, last: int | None) -> Iterator[list[str | None]]:
        """The named fields of the rows from first to before last, as text."""
        rows, head, size = struct.unpack_from("<IHH", self.read(".dbf", 0, 32), 4)
        table, fields, at, place = self.read(".dbf", 0, head), {}, 32, 1
        while table[at] != 0x0D:
            name = table[at : at + 11].split(b"\0")[0].decode()
            fields[name] = (place, place + table[at + 16])
            place += table[at + 16]
            at += 32
        last = rows if last is None else min(last, rows)
        raw = self.read(".dbf", head + first * size, (last - first) * size)
        for k in range(last - first):
            row = raw[k * size : (k + 1) * size]
            yield [(row[slice(*fields[n])].decode("utf-8", "replace").strip() or None) if n in fields else None for n in names]


@dataclass
class Records(InputPartition):
    """Records of a file from first to before last; all of them if last is None."""

    path: str
    first: int
    last: int | None

    def __post_init__(self):
        self.value = None


class ShapeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.pattern = options["path"], options.get("pattern", "*.zip")
        self.names = [n for n in options.get("names", "").split("\0") if n]
        self.geometry, self.records = options.get("geometry", "true") == "true", int(options.get("records", RECORDS))
        self.box = tuple(float(x) for x in options["box"].split(",")) if "box" in options else None

    def partitions(self) -> list[Records]:
        paths = files_of(self.path, self.pattern)
        with ThreadPoolExecutor(16) as pool:
            counts = list(pool.map(lambda p: Members(p).records(), paths))
        out = []
        for path, n in zip(paths, counts, strict=True):
            out += [Records(path, 0, None)] if n is None else [Records(path, a, min(a + self.records, n)) for a in range(0, n, self.records)]
        return out

    def read(self, partition: Records) -> Iterator[tuple]:
        if not isinstance(partition, Records):  # Spark asks so for an empty list of partitions
            return
        members, name = Members(partition.path), partition.path.rsplit("/", 1)[-1]
        rows = members.attributes(self.names, partition.first, partition.last)
        if not self.geometry:
            for k, row in enumerate(rows, partition.first):
                yield (name, k, *row)
            return
        last = partition.last if partition.last is not None else members.records() or 0
        for k, (row, record) in enumerate(zip(rows, members.geometry(partition.first, last), strict=True), partition.first):
            if self.box is None or meets(record, self.box):
                yield (name, k, *row, rings_of(record))


class ShapeSource(DataSource):
    """Options: path, names (of attributes, parted by a zero character), pattern, geometry, records (of a partition), box."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        columns = "".join(f", `{n}` string" for n in self.options.get("names", "").split("\0") if n)
        return f"file string, recno int{columns}" + (f", rings array<{RING}>" if self.options.get("geometry", "true") == "true" else "")

    def reader(self, schema) -> ShapeReader:
        return ShapeReader(dict(self.options))


def read_shapefiles(spark: SparkSession, folder: str, names: list[str], pattern: str = "*.zip", geometry: bool = True, *, box: tuple[float, float, float, float] | None = None, records: int = RECORDS) -> DataFrame:
    """(file, recno, names..., rings) of polygon shapefiles, zipped or (pattern *.shp) not; many tasks for each.

    geometry=False reads only the attribute tables. box: records whose bounds meet it.
    """
    spark.dataSource.register(ShapeSource)
    out = spark.read.format("shapefile").option("path", folder).option("names", "\0".join(names)).option("pattern", pattern).option("geometry", str(geometry).lower()).option("records", records)
    return (out.option("box", ",".join(map(repr, box))) if box and geometry else out).load()
