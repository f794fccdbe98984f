"""Operator 11: shards along a Hilbert curve over several columns.

Each dimension is quantised to 2**bits cells of about equal numbers of rows, in the
order of its values, so that a file's least and greatest values bound a box. The
cells of a row give its index on the curve, by a table of the curve's states. Rows
are sorted by that index and the order is cut into shards, and these into files, of
as many rows each (law ``rows``: at most one more or less): neighbours on the curve
are near in every dimension, so a filter on any of them leaves most files unread.

All is DataFrame or SQL functions. Places come from sums, with no global sort: rows
before a cell of the curve, rows before a part of that cell, and the row's number in
its part. A cell with many rows (copies, a hot source) is dealt into parts by a hash
of the row's own number, so that no part has more than about 1/PARTS of all rows.

A dimension is a string, a number, a boolean, a date or a time. Nulls come first; NaN
counts as infinity. Ties have any order, but one: rows with the same index are in the
order of part and of their number in the input. Repeated rows are rows. A null text
has no bytes: size 8, crc 0. An empty table gives no rows. A column of the input with
the name of a new one is replaced.
"""

from __future__ import annotations

import math
import os.path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._text import written

SHARDS = 24
DIMENSIONS = ("lang", "source", "n_chars")
BITS = 6
#: Values of a dimension are first counted in so many bins, in their order.
FINE = 4096
#: A cell with a share of the rows is dealt into that share of so many parts.
PARTS = 4096
#: Dimensions times bits: the curve has at most 2**18 cells, so that a table of them can be broadcast.
MOST_BITS = 18
_FAR = 1e300


def states(dims: int) -> tuple[list[int], list[int]]:
    """(digit of the index, next state) at state * 2**dims + the dimensions' bits, for a curve over so many dimensions.

    A state is the corner where the curve enters a cube and the axis that it leaves along; within, the corners are
    passed in the order of a Gray code that is turned and mirrored so.
    """
    corners = 1 << dims
    turn = lambda x, by: ((x << by % dims) | (x >> (dims - by % dims))) & (corners - 1)
    gray = [w ^ (w >> 1) for w in range(corners)]
    place = {g: w for w, g in enumerate(gray)}
    ones = lambda w: (~w & (w + 1)).bit_length() - 1  # trailing ones
    enters = lambda w: 0 if w == 0 else gray[(w - 1) // 2 * 2]
    axis = lambda w: 0 if w == 0 else ones(w - 1 if w % 2 == 0 else w) % dims
    digits, following = [], []
    for state in range(corners * dims):
        corner, along = divmod(state, dims)
        for bits in range(corners):
            w = place[turn(bits ^ corner, dims - (along + 1) % dims)]
            digits.append(w)
            following.append((corner ^ turn(enters(w), along + 1)) * dims + (along + axis(w) + 1) % dims)
    return digits, following


def curve(cells: list[str], bits: int = BITS) -> str:
    """SQL for the index on the curve of a point with these cells (SQL) from 0 to 2**bits - 1."""
    n = len(cells)
    digits, following = (f"array({', '.join(map(str, x))})" for x in states(n))
    point = " + ".join(f"shiftleft(shiftright(p.x{i}, j) & 1, {i})" for i in range(n))
    step = f"transform(array(s.state * {1 << n} + {point}), k -> named_struct('h', s.h * {1 << n} + {digits}[k], 'state', {following}[k]))[0]"
    at = ", ".join(f"'x{i}', cast({c} as int)" for i, c in enumerate(cells))
    return f"transform(array(named_struct({at})), p -> aggregate(sequence({bits - 1}, 0, -1), named_struct('h', 0L, 'state', 0), (s, j) -> {step}, s -> s.h))[0]"


def _value(column: Column, kind: T.DataType, skip: int = 0) -> Column:
    """A double in the order of the column; of strings, of six bytes after those that all have in common."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), skip + 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        column = F.unix_date(column)
    elif isinstance(kind, T.TimestampNTZType):
        column = column.cast("timestamp")
    elif not isinstance(kind, (T.NumericType, T.BooleanType, T.TimestampType)):
        raise ValueError(f"a dimension has to be a string, a number, a boolean, a date or a time, not {kind.simpleString()}")
    value = column.cast("double")
    return F.when(F.isnan(value), _FAR).otherwise(F.greatest(F.lit(-_FAR), F.least(F.lit(_FAR), value)))


def bins(docs: DataFrame, dimensions: tuple[str, ...]) -> list[Column]:
    """The bin of each dimension: 0 for null, else from 1 to FINE in the order of the values, by their logarithms above the least one if numbers."""
    kinds = [docs.schema[c].dataType for c in dimensions]
    columns = [F.col(f"`{c}`") for c in dimensions]
    raw = [c if isinstance(k, T.StringType) else _value(c, k) for c, k in zip(columns, kinds, strict=True)]
    row = docs.agg(*(f(c).alias(f"{name}{i}") for i, c in enumerate(raw) for name, f in (("low", F.min), ("high", F.max)))).collect()[0]
    out = []
    for i, (column, kind) in enumerate(zip(columns, kinds, strict=True)):
        low, high, skip = row[f"low{i}"], row[f"high{i}"], 0
        string = isinstance(kind, T.StringType)
        if string and low is not None:
            ends = [low.encode(), high.encode()]
            skip = len(os.path.commonprefix(ends))
            low, high = (float(int.from_bytes(x[skip : skip + 6].ljust(6, b"\0"), "big")) for x in ends)
        value = _value(column, kind, skip)
        if low is None or high <= low:
            out.append(F.when(value.isNull(), 0).otherwise(1))
            continue
        share = (value - low) / (high - low) if string else F.log1p(value - low) / math.log1p(high - low)
        out.append(F.when(value.isNull(), 0).otherwise(1 + F.greatest(F.lit(0), F.least(F.lit(FINE - 1), F.floor(share * FINE)))).cast("int"))
    return out


def cells_of(histogram: dict[int, int], bits: int) -> list[int]:
    """The cell of each bin from 0 to FINE: by the rows before it and half of its own."""
    total, before, out = sum(histogram.values()), 0, []
    for b in range(FINE + 1):
        n = histogram.get(b, 0)
        out.append(min((1 << bits) - 1, ((2 * before + n) << bits) // (2 * total)) if total else 0)
        before += n
    return out


def indexed(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """(doc, the row; curve, its index). One scan of the dimensions for their ends, one for their histograms (FINE bins each)."""
    if not dimensions or len(dimensions) * bits > MOST_BITS:
        raise ValueError(f"at least one dimension, and dimensions times bits at most {MOST_BITS}")
    fine = bins(docs, dimensions)
    counts = docs.select(F.explode(F.array(*(F.struct(F.lit(i).alias("d"), b.alias("b")) for i, b in enumerate(fine)))).alias("x")).groupBy("x.d", "x.b").count().collect()
    cells = [cells_of({r["b"]: r["count"] for r in counts if r["d"] == i}, bits) for i in range(len(fine))]
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.struct(*(b.alias(f"b{i}") for i, b in enumerate(fine))).alias("bins"))
    return out.select("doc", F.expr(curve([f"array({', '.join(map(str, c))})[bins.b{i}]" for i, c in enumerate(cells)], bits)).alias("curve"))


def placed(docs: DataFrame, *, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """docs with curve (the index), rank (from 0, over all rows), shard and slot (from 0, in its shard)."""
    # written with a number for each row: what is numbered, counted and dealt below is the same rows
    rows = written(indexed(docs, dimensions, bits).withColumn("row", F.monotonically_increasing_id()), "curve")
    total = rows.count()
    block = F.shiftright("curve", len(dimensions) * bits // 2)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.groupBy("curve").agg(F.count("*").alias("n")).withColumn("block", block)
    # at most 2**9 blocks of the curve, and then the cells of each
    blocks = found.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(before().orderBy("block")), F.lit(0)).alias("first"))
    cells = found.join(F.broadcast(blocks), "block").select(
        "curve",
        (F.col("first") + F.coalesce(F.sum("n").over(before("block").orderBy("curve")), F.lit(0))).alias("first"),
        F.expr(f"greatest(1L, (n * {PARTS} + {total} - 1) div greatest({total}, 1))").alias("parts"),
    )
    cells = written(cells, "cells")
    dealt = rows.join(F.broadcast(cells), "curve").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    sizes = dealt.groupBy("curve", "part", "first").agg(F.count("*").alias("n"))
    # as many rows as the curve has cells, and PARTS more, at most
    starts = written(sizes.select("curve", "part", (F.col("first") + F.coalesce(F.sum("n").over(before("curve").orderBy("part")), F.lit(0))).alias("start")), "parts")
    number = F.row_number().over(Window.partitionBy("curve", "part").orderBy("row"))
    ranked = dealt.select("doc", "curve", "part", number.alias("number")).join(F.broadcast(starts), ["curve", "part"]).withColumn("rank", F.col("start") + F.col("number") - 1)
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    slot = F.expr(f"rank - (rank * {shards} div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    own = {"curve": F.col("curve"), "rank": F.col("rank"), "shard": shard.cast("int"), "slot": slot}
    return ranked.select(*(F.col(f"doc.`{c}`") for c in docs.columns if c not in own), *(c.alias(k) for k, c in own.items()))


def write(docs: DataFrame, path: str, *, shards: int = SHARDS, files: int = 1, **options) -> None:
    """docs as Parquet in a folder for each shard, with about so many files in each, all in the order of the curve."""
    out = placed(docs, shards=shards, **options)
    out.repartitionByRange(shards * files, "rank").sortWithinPartitions("rank").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *DIMENSIONS)
    return placed(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
