"""Shapefiles by ranges of records: zipped plainly or packed, or as three files; with and without geometry, box and index."""

import struct
import zipfile

import pytest

from zonalspark.sources import files, shapefiles


def parts(n, index=True):
    """(.shp, .shx, .dbf) of n boxes of growing size, every seventh without a shape, with two attributes."""
    shp, shx, at = b"", b"", 50
    for k in range(n):
        if k % 7 == 3:
            record = struct.pack("<i", 0)
        else:
            w = 1 + k % 3
            ring = [(k, 0.0), (k + w, 0.0), (k + w, 1.0), (k, 1.0), (k, 0.0)]
            record = struct.pack("<i4d2i1i", 5, k, 0, k + w, 1, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in ring)
        shp += struct.pack(">2i", k + 1, len(record) // 2) + record
        shx += struct.pack(">2i", at, len(record) // 2)
        at += 4 + len(record) // 2
    head = lambda size: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i", 1000, 5) + b"\0" * 64
    field = lambda name, size: name.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([size]) + b"\0" * 15
    fields = field(b"KOD", 6) + field(b"NAZEV", 10)
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, n, 32 + len(fields) + 1, 17) + fields + b"\r"
    dbf += b"".join(b" " + str(k).encode().ljust(6) + ("" if k % 5 == 0 else f"é{k}").encode().ljust(10) for k in range(n))
    out = {".shp": head(100 + len(shp)) + shp, ".dbf": dbf}
    return out | ({".shx": head(100 + len(shx)) + shx} if index else {})


def zipped(path, members, kind):
    with zipfile.ZipFile(path, "w", kind) as z:
        for ext, body in members.items():
            z.writestr(f"folder/zones{ext}", body)
        z.writestr("__MACOSX/folder/._zones.shp", b"x")


def wanted(n):
    return {k: (str(k), None if k % 5 == 0 else f"é{k}", 0 if k % 7 == 3 else 1) for k in range(n)}


@pytest.mark.parametrize("kind", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, None])
@pytest.mark.parametrize("index", [True, False])
def test_every_record_once(spark, tmp_path, kind, index):
    n = 95
    if kind is None:
        for ext, body in parts(n, index).items():
            (tmp_path / f"zones{ext}").write_bytes(body)
    else:
        zipped(tmp_path / "a.zip", parts(n, index), kind)
    df = files.read_shapefiles(spark, str(tmp_path), ["KOD", "NAZEV"], "*.shp" if kind is None else "*.zip", records=20)
    assert df.rdd.getNumPartitions() == (5 if index else 1)
    rows = df.collect()
    assert {r["recno"]: (r["KOD"], r["NAZEV"], len(r["rings"])) for r in rows} == wanted(n) and len(rows) == n
    one = next(r for r in rows if r["recno"] == 50)
    assert [(p["x"], p["y"]) for p in one["rings"][0]] == [(50, 0), (53, 0), (53, 1), (50, 1), (50, 0)]
    names = files.read_shapefiles(spark, str(tmp_path), ["NAZEV", "none"], "*.shp" if kind is None else "*.zip", geometry=False, records=20)
    assert {r["recno"]: (r["NAZEV"], r["none"]) for r in names.collect()} == {k: (v[1], None) for k, v in wanted(n).items()}


def test_attributes_read_no_geometry_and_a_range_its_own_bytes(tmp_path):
    n = 400
    zipped(tmp_path / "a.zip", parts(n), zipfile.ZIP_STORED)
    seen = []
    plain = shapefiles.Members.__init__
    shapefiles.Members.__init__ = lambda self, path: (plain(self, path), seen.append(self))[0]
    try:
        options = {"path": str(tmp_path), "names": "KOD", "records": "100"}
        reader = shapefiles.ShapeSource(options | {"geometry": "false"}).reader(None)
        assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == n
        assert {ext for m in seen for ext in m.read_bytes} == {".dbf"}
        seen.clear()
        reader = shapefiles.ShapeSource(options).reader(None)
        parts_ = reader.partitions()
        assert len(parts_) == 4 and all(not m.read_bytes for m in seen)
        seen.clear()
        assert len(list(reader.read(parts_[2]))) == 100
        whole = len(parts(n)[".shp"])
        assert 0.2 * whole < seen[0].read_bytes[".shp"] < 0.3 * whole
    finally:
        shapefiles.Members.__init__ = plain


def test_a_box_leaves_records_out(spark, tmp_path):
    zipped(tmp_path / "a.zip", parts(60), zipfile.ZIP_DEFLATED)
    got = {r["recno"] for r in files.read_shapefiles(spark, str(tmp_path), ["KOD"], box=(20.5, -1.0, 25.2, 0.5), records=10).collect()}
    assert got == {k for k in range(60) if k % 7 != 3 and k <= 25.2 and k + 1 + k % 3 >= 20.5}
    assert files.read_shapefiles(spark, str(tmp_path), ["KOD"], "*.nothing").count() == 0
