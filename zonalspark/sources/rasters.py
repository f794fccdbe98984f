"""TIFF rasters as tile tables, and tile tables as TIFF files: a data source with windows for partitions.

Reading: a partition is a window of a file's blocks, read by byte ranges; the driver
reads no more of a file than its directory. ``rows`` and ``columns``, or filters on
``file``, ``row`` and ``col``, leave out windows and blocks that they can't meet.

Writing: a task writes a complete file for each window of the grid, and the commit
gives them their names, with an index beside them that other programs open as one
raster. No raster is whole anywhere: a task holds the packed blocks of one window.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from . import tiff

BLOCKS = "file string, row int, col int, h int, w int, cells array<double>"
#: Pixels on a side of a window that a task reads or writes.
WINDOW = 4096
_PLACES = ["file", "x0", "y0", "dx", "dy", "width", "height"]


def _system(path: str):
    """(file system, path in it); a path without a scheme is one of this machine or a mounted one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files_of(path: str, pattern: str) -> list[str]:
    """The files below a folder (or the file) whose names match, sorted."""
    from pyarrow import fs

    system, inside = _system(path)
    info = system.get_file_info(inside)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    head = path[: len(path) - len(inside)] if path.endswith(inside) else ""
    found = system.get_file_info(fs.FileSelector(inside, recursive=True))
    return sorted(head + f.path for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, pattern))


class Ranges:
    """Reads ranges of a file, and counts their bytes."""

    def __init__(self, path: str):
        system, inside = _system(path)
        self.file, self.bytes = system.open_input_file(inside), 0

    def __call__(self, place: int, size: int) -> bytes:
        out = self.file.read_at(size, place)
        self.bytes += len(out)
        return out

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


@dataclass
class Window(InputPartition):
    """Blocks of a file: from the first to before the last, down and across."""

    path: str
    layout: tiff.Layout
    rows: tuple[int, int]
    columns: tuple[int, int]

    def __post_init__(self):
        self.value = None


def windows(path: str, at: tiff.Layout, size: int, rows: tuple[int, int], columns: tuple[int, int]) -> Iterator[Window]:
    """The windows of a file, of about size * size pixels, whose blocks meet these pixel rows and columns (first, before last)."""
    span = lambda ends, block, n: (max(0, ends[0] // block), min(n, -(-min(ends[1], n * block) // block)))
    (top, bottom), (left, right) = span(rows, at.block_height, at.down), span(columns, at.block_width, at.across)
    wide = max(1, size // at.block_width)
    high = max(1, size * size // (at.block_width * at.block_height * wide))
    for r in range(top, bottom, high):
        for c in range(left, right, wide):
            yield Window(path, at, (r, min(r + high, bottom)), (c, min(c + wide, right)))


class TiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.pattern = options["path"].split(","), options.get("pattern", "*.tif")
        self.size, self.band = int(options.get("window", WINDOW)), int(options.get("band", 0))
        ends = lambda name: tuple(int(x) for x in options[name].split(":")) if name in options else (0, 1 << 62)
        #: Pixels asked for; and the first pixels of the blocks asked for, by filters.
        self.rows, self.columns = ends("rows"), ends("columns")
        self.starts = {"row": (0, 1 << 62), "col": (0, 1 << 62)}
        self.names: set[str] | None = None

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            column, value = getattr(f, "attribute", ()), getattr(f, "value", None)
            if column == ("file",) and isinstance(f, EqualTo):
                self.names = {value} if self.names is None else self.names & {value}
            elif column in (("row",), ("col",)) and isinstance(value, int):
                low, high = self.starts[column[0]]
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    low = max(low, value + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    high = min(high, value + (not isinstance(f, LessThan)))
                self.starts[column[0]] = low, high
            yield f  # Spark holds the rows against it too

    def partitions(self) -> list[Window]:
        paths = [p for path in self.paths for p in files_of(path, self.pattern)]
        paths = [p for p in paths if self.names is None or p.rsplit("/", 1)[-1] in self.names]

        def layout(path: str) -> tiff.Layout:
            with Ranges(path) as read:
                return tiff.layout(read)

        out = []
        with ThreadPoolExecutor(16) as pool:
            for path, at in zip(paths, pool.map(layout, paths), strict=True):
                if not 0 <= self.band < at.bands:
                    raise ValueError(f"{path} has {at.bands} bands")
                # a block that starts at or after the first wanted one, and before the last
                within = lambda ends, starts, block: (max(ends[0], starts[0]), min(ends[1], starts[1]))
                rows, columns = within(self.rows, self.starts["row"], at.block_height), within(self.columns, self.starts["col"], at.block_width)
                if rows[0] < rows[1] and columns[0] < columns[1]:
                    out += windows(path, at, self.size, rows, columns)
        return out

    def read(self, partition: Window) -> Iterator[tuple]:
        if partition is None or not isinstance(partition, Window):  # Spark asks so for an empty list of partitions
            return
        name = partition.path.rsplit("/", 1)[-1]
        with Ranges(partition.path) as read:
            for row, col, values in tiff.blocks(read, partition.layout, partition.rows, partition.columns, self.band):
                cells = pa.array(values.ravel(), mask=np.isnan(values.ravel()))
                lists = pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)
                whole = [pa.array([v], pa.int32()) for v in (row, col, *values.shape)]
                yield pa.RecordBatch.from_arrays([pa.array([name]), *whole, lists], names=["file", "row", "col", "h", "w", "cells"])


@dataclass
class Written(WriterCommitMessage):
    """(path as written, final path, first row, first column, height, width) of the files of a task."""

    files: list[tuple[str, str, int, int, int, int]]


class TiffWriter(DataSourceWriter):
    """Blocks to files by window. Rows come by window, as ``write_tiff`` deals them."""

    def __init__(self, options: dict, overwrite: bool):
        get = lambda name, other: type(other)(options.get(name, other))
        self.path, self.overwrite = options["path"], overwrite
        self.size, self.tile = get("window", WINDOW), get("tile", 256)
        self.width, self.height = int(options["width"]), int(options["height"])
        self.x0, self.y0, self.dx, self.dy = get("x0", 0.0), get("y0", 0.0), get("dx", 1.0), get("dy", 1.0)
        self.dtype, self.nodata = np.dtype(get("dtype", "f4")), get("nodata", -9999.0)
        self.epsg = int(options["epsg"]) if "epsg" in options else None
        self.packed = tiff.COMPRESSIONS[get("compression", "zstd")]
        self.predictor = int(options.get("predictor", 1 if self.packed == tiff.NONE else 3 if self.dtype.kind == "f" else 2))
        self.run = uuid.uuid4().hex
        if self.size % self.tile or self.tile % 16:
            raise ValueError("a window has to be whole tiles, and a tile a multiple of 16 pixels")

    def _file(self, key: tuple[int, int], tiles: dict[tuple[int, int], np.ndarray]) -> tuple:
        """Writes the file of a window from its tiles by (tile row, tile column)."""
        row, col = key[0] * self.size, key[1] * self.size
        h, w = min(self.size, self.height - row), min(self.size, self.width - col)
        down, across = -(-h // self.tile), -(-w // self.tile)
        blocks = [self._pack(tiles.pop((r, c), None)) for r in range(row // self.tile, row // self.tile + down) for c in range(col // self.tile, col // self.tile + across)]
        system, inside = _system(self.path)
        name = f"r{row:08d}_c{col:08d}.tif"
        place = f"{inside}/_writing-{self.run}/{uuid.uuid4().hex}-{name}"
        system.create_dir(f"{inside}/_writing-{self.run}")
        with system.open_output_stream(place) as out:
            for piece in tiff.assembled(blocks, width=w, height=h, dtype=self.dtype, block=(self.tile, self.tile), tiled=True, packed=self.packed, predictor=self.predictor, x0=self.x0 + col * self.dx, y0=self.y0 - row * self.dy, dx=self.dx, dy=self.dy, nodata=self.nodata, epsg=self.epsg):
                out.write(piece)
        return place, f"{inside}/{name}", row, col, h, w

    def _pack(self, values: np.ndarray | None) -> bytes:
        if values is None:
            return b""  # a tile without values takes no bytes
        kept = np.where(np.isnan(values), self.nodata, values)
        return tiff.encoded((np.rint(kept) if self.dtype.kind != "f" else kept).astype(self.dtype), self.packed, self.predictor)

    def write(self, iterator: Iterator) -> Written:
        """The tiles of one window at a time; a block may lie over several tiles and windows end at its row's key."""
        done, now, tiles = [], None, {}
        for row in iterator:
            key = row["window_row"], row["window_col"]
            if key != now:
                if tiles:
                    done.append(self._file(now, tiles))
                now, tiles = key, {}
            values = np.array([np.nan if v is None else v for v in row["cells"]], float).reshape(row["h"], row["w"])
            tile_row, tile_col = row["row"] // self.tile, row["col"] // self.tile
            if (tile_row, tile_col) not in tiles:
                tiles[tile_row, tile_col] = np.full((self.tile, self.tile), np.nan)
            r, c = row["row"] - tile_row * self.tile, row["col"] - tile_col * self.tile
            into = tiles[tile_row, tile_col][r : r + row["h"], c : c + row["w"]]
            into[:] = np.where(np.isnan(values), into, values)
        if tiles:
            done.append(self._file(now, tiles))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, inside = _system(self.path)
        files = sorted(f for m in messages if m is not None for f in m.files)
        old = [f.path for f in system.get_file_info(fs.FileSelector(inside, allow_not_found=True)) if f.type == fs.FileType.File]
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{self.path} has files")
        for path in old:
            system.delete_file(path)
        system.create_dir(inside)
        for place, path, *_ in files:
            system.move(place, path)
        with system.open_output_stream(f"{inside}/index.vrt") as out:
            out.write(self._index(sorted((p.rsplit("/", 1)[-1], *rest) for _, p, *rest in files)).encode())
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, inside = _system(self.path)
        if system.get_file_info(f"{inside}/_writing-{self.run}").type == fs.FileType.Directory:
            system.delete_dir(f"{inside}/_writing-{self.run}")

    def _index(self, files: list[tuple[str, int, int, int, int]]) -> str:
        """The files as one raster: the index format that raster programs share."""
        kind = {"f4": "Float32", "f8": "Float64", "u1": "Byte", "u2": "UInt16", "i2": "Int16", "u4": "UInt32", "i4": "Int32"}.get(self.dtype.str[1:], "Float64")
        box = lambda what, x, y, w, h: f'<{what} xOff="{x}" yOff="{y}" xSize="{w}" ySize="{h}"/>'
        parts = "".join(f'<ComplexSource><SourceFilename relativeToVRT="1">{name}</SourceFilename><SourceBand>1</SourceBand>{box("SrcRect", 0, 0, w, h)}{box("DstRect", col, row, w, h)}<NODATA>{self.nodata:g}</NODATA></ComplexSource>' for name, row, col, h, w in files)
        srs = f"<SRS>EPSG:{self.epsg}</SRS>" if self.epsg else ""
        return f'<VRTDataset rasterXSize="{self.width}" rasterYSize="{self.height}">{srs}<GeoTransform>{self.x0!r}, {self.dx!r}, 0.0, {self.y0!r}, 0.0, {-self.dy!r}</GeoTransform><VRTRasterBand dataType="{kind}" band="1"><NoDataValue>{self.nodata:g}</NoDataValue>{parts}</VRTRasterBand></VRTDataset>\n'


class TiffSource(DataSource):
    """Options of both ways: path, window. Of reading: pattern, band, rows and columns ("first:before last"). Of writing: those of ``write_tiff``."""

    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema: T.StructType) -> TiffReader:
        return TiffReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> TiffWriter:
        return TiffWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiffSource)


def read_tiff(spark: SparkSession, folder: str, pattern: str = "*.tif", *, rows: tuple[int, int] | None = None, columns: tuple[int, int] | None = None, window: int = WINDOW, band: int = 0) -> DataFrame:
    """(file, row, col, h, w, cells): the blocks of each file, row and col of the first cell; nodata and NaN are null.

    rows, columns: (first, before last) pixels; only blocks that hold some of them are read.
    """
    register(spark)
    out = spark.read.format("tiff").option("path", folder).option("pattern", pattern).option("window", window).option("band", band)
    for name, ends in (("rows", rows), ("columns", columns)):
        out = out.option(name, f"{ends[0]}:{ends[1]}") if ends else out
    return out.load()


def write_tiff(
    blocks: DataFrame, path: str, *, width: int, height: int, mode: str = "error", window: int = WINDOW, tile: int = 256, compression: str = "zstd", dtype: str = "f4", nodata: float = -9999.0,
    x0: float = 0.0, y0: float = 0.0, dx: float = 1.0, dy: float = 1.0, epsg: int | None = None, predictor: int | None = None,
) -> None:
    """Blocks (row, col, h, w, cells) as a folder of TIFF files, one for each window that has values, and an index of them.

    Blocks of any size: they are cut at the edges of tiles. Where blocks overlap, either value stays.
    """
    register(blocks.sparkSession)
    out = cut(blocks, tile).withColumns({"window_row": F.expr(f"row div {window}"), "window_col": F.expr(f"col div {window}")})
    parts = max(1, -(-width // window) * -(-height // window))
    tasks = min(parts, max(200, 4 * blocks.sparkSession.sparkContext.defaultParallelism))
    ready = out.repartition(tasks, "window_row", "window_col").sortWithinPartitions("window_row", "window_col")
    options = {"path": path, "width": width, "height": height, "window": window, "tile": tile, "compression": compression, "dtype": dtype, "nodata": nodata, "x0": x0, "y0": y0, "dx": dx, "dy": dy}
    options |= {k: v for k, v in (("epsg", epsg), ("predictor", predictor)) if v is not None}
    ready.write.format("tiff").options(**options).mode("append" if mode == "error" else mode).save()


def cut(blocks: DataFrame, tile: int) -> DataFrame:
    """Blocks cut at multiples of tile, down and across; a block inside of a tile stays as it is."""
    first = lambda at: F.floor(F.col(at) / tile).cast("int")
    last = lambda at, n: F.floor((F.col(at) + F.col(n) - 1) / tile).cast("int")
    each = blocks.select("row", "col", "h", "w", "cells", F.explode(F.sequence(first("row"), last("row", "h"))).alias("r")).select("*", F.explode(F.sequence(first("col"), last("col", "w"))).alias("c"))
    top, left = F.greatest(F.col("row"), F.col("r") * tile), F.greatest(F.col("col"), F.col("c") * tile)
    bottom, right = F.least(F.col("row") + F.col("h"), (F.col("r") + 1) * tile), F.least(F.col("col") + F.col("w"), (F.col("c") + 1) * tile)
    own = each.withColumns({"top": top, "left": left, "rows": bottom - top, "columns": right - left})
    lines = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda k: F.slice("cells", (F.col("top") - F.col("row") + k) * F.col("w") + F.col("left") - F.col("col") + 1, F.col("columns")))
    inside = (F.col("rows") == F.col("h")) & (F.col("columns") == F.col("w"))
    # made apart from the new names: inside of the lambda those would be taken for the old ones
    parts = own.withColumn("part", F.when(inside, F.col("cells")).otherwise(F.flatten(lines)))
    return parts.select(F.col("top").alias("row"), F.col("left").alias("col"), F.col("rows").alias("h"), F.col("columns").alias("w"), F.col("part").alias("cells"))


def placement(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    """(file, x0, y0, dx, dy, width, height) of each file: what a Grid is made of. Only directories are read."""
    paths = spark.createDataFrame([(p,) for p in files_of(folder, pattern)], "path string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                with Ranges(path) as read:
                    at = tiff.layout(read)
                rows.append((path.rsplit("/", 1)[-1], at.x0, at.y0, at.dx, at.dy, at.width, at.height))
            if rows:
                kinds = [pa.string(), *[pa.float64()] * 4, *[pa.int32()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_PLACES)

    return paths.mapInArrow(run, "file string, x0 double, y0 double, dx double, dy double, width int, height int")


def in_grid(blocks: DataFrame, places: DataFrame, *, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """Blocks of several files with row and col of one grid; places: (file, x0, y0), a row for each file."""
    shift = places.select("file", F.round((F.lit(y0) - F.col("y0")) / dy).cast("int").alias("down"), F.round((F.col("x0") - x0) / dx).cast("int").alias("right"))
    # the blocks of a file meet its one row: few files, however many blocks
    return blocks.join(shift, "file").select("file", (F.col("row") + F.col("down")).alias("row"), (F.col("col") + F.col("right")).alias("col"), "h", "w", "cells")


def pixels(blocks: DataFrame) -> DataFrame:
    """(file, row, col, value) of blocks."""
    out = blocks.select("file", "row", "col", "w", F.posexplode("cells").alias("k", "value"))
    return out.select("file", (F.col("row") + F.floor(F.col("k") / F.col("w"))).cast("int").alias("row"), (F.col("col") + F.col("k") % F.col("w")).cast("int").alias("col"), "value")


def tiff_bytes(values: np.ndarray, *, x0: float = 0.0, y0: float = 0.0, dx: float = 1.0, dy: float = 1.0, nodata: float | None = None, rows: int = 256, pack: bool = True) -> bytes:
    """One small band as a little-endian TIFF in strips of so many rows."""
    packed = tiff.DEFLATE if pack else tiff.NONE
    strips = [tiff.encoded(values[a : a + rows], packed, 1) for a in range(0, len(values), rows)]
    return b"".join(tiff.assembled(strips, width=values.shape[1], height=len(values), dtype=values.dtype, block=(values.shape[1], rows), tiled=False, packed=packed, x0=x0, y0=y0, dx=dx, dy=dy, nodata=nodata))
