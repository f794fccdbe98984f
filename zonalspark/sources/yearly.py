"""Yearly results that are computed once: a manifest of each year's inputs, and a partition for each year.

A year is computed if it has no entry, or if the names or sizes of its input files are
other ones than its entry says. Its partition is replaced whole, and the entry is
written after it, so a run that breaks off leaves no year that looks done.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

_MANIFEST = "_manifest"


def _path(spark: SparkSession, path: str):
    out = spark._jvm.org.apache.hadoop.fs.Path(path)
    return out, out.getFileSystem(spark._jsc.hadoopConfiguration())


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name below path, bytes) of a file, or of all files of a folder but hidden ones, sorted."""
    start, system = _path(spark, path)
    root, out, todo = system.getFileStatus(start), [], []
    todo.append((root, root.getPath().getName() if root.isFile() else ""))
    while todo:
        status, name = todo.pop()
        if status.isFile():
            out.append((name, status.getLen()))
            continue
        for child in system.listStatus(status.getPath()):
            own = child.getPath().getName()
            if own[0] not in "._":
                todo.append((child, f"{name}/{own}".lstrip("/")))
    return sorted(out)


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of the names and sizes of the input files of a year."""
    lines = [json.dumps([p.rsplit("/", 1)[-1], *f]) for p in sorted(paths) for f in files_below(spark, p)]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def done_years(spark: SparkSession, target: str) -> dict[int, str]:
    """The fingerprint of each year that is there."""
    folder, system = _path(spark, f"{target}/{_MANIFEST}")
    if not system.exists(folder):
        return {}
    entries = {}
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".json") and name[0] not in "._":
            stream = system.open(status.getPath())
            entry = json.loads(bytes(stream.readAllBytes()))
            stream.close()
            entries[entry["year"]] = entry["inputs"]
    return entries


def _enter(spark: SparkSession, target: str, year: int, inputs: str) -> None:
    place, system = _path(spark, f"{target}/{_MANIFEST}/{year}.json")
    aside, _ = _path(spark, f"{target}/{_MANIFEST}/_{year}.json")
    stream = system.create(aside, True)
    stream.write(bytearray(json.dumps({"year": year, "inputs": inputs}).encode()))
    stream.close()
    system.delete(place, False)
    if not system.rename(aside, place):
        raise OSError(f"the entry of {year} could not be written")


def write_years(spark: SparkSession, inputs: dict[int, list[str]], compute: Callable[[int, list[str]], DataFrame], target: str, *, force: bool = False) -> list[int]:
    """Computes the years that are missing or changed into target/year=...; returns them. force: all years.

    compute gets a year and its paths; a result without rows is a year, too. Years that
    have no inputs any more stay as they are.
    """
    there, computed = {} if force else done_years(spark, target), []
    for year, paths in sorted(inputs.items()):
        own = fingerprint(spark, paths)
        if there.get(year) == own:
            continue
        compute(year, paths).drop("year").write.mode("overwrite").parquet(f"{target}/year={year}")
        _enter(spark, target, year, own)
        computed.append(year)
    return computed
