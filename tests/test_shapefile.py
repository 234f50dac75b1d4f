"""Shapefiles with index and table, written here byte by byte."""

import datetime
import random
import struct

import pytest
from pyspark.sql import functions as F

from corvane.sources import layers, shapefile


def points(ps):
    return struct.pack(f"<{2 * len(ps)}d", *(v for p in ps for v in p))


def write_shapes(path, bodies, with_index=True, hole=0):
    """``hole`` zero bytes stand before each seventh record, as in files that were edited."""
    head = lambda size: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, 1, *[0.0] * 8)
    out, index = b"", b""
    for i, body in enumerate(bodies):
        out += b"\0" * (hole if i % 7 == 6 else 0)
        index += struct.pack(">2i", (100 + len(out)) // 2, len(body) // 2)
        out += struct.pack(">2i", i + 1, len(body) // 2) + body
    path.write_bytes(head(100 + len(out)) + out)
    if with_index:
        path.with_suffix(".shx").write_bytes(head(100 + len(index)) + index)


def write_table(path, fields, rows, language=0, deleted=()):
    size = 1 + sum(f[2] for f in fields)
    head = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), size)
    head = head[:29] + bytes([language]) + head[30:]
    head += b"".join(name.ljust(11, b"\0") + kind + b"\0" * 4 + bytes([length % 256, length // 256 if kind == b"C" else decimals]) + b"\0" * 14 for name, kind, length, decimals in fields) + b"\r"
    body = b"".join((b"*" if i in deleted else b" ") + b"".join(v.ljust(f[2]) if f[1] == b"C" else v.rjust(f[2]) for v, f in zip(r, fields)) for i, r in enumerate(rows))
    path.write_bytes(head + body + b"\x1a")


FIELDS = [(b"NAME", b"C", 12, 0), (b"N", b"N", 9, 0), (b"RATE", b"N", 12, 4), (b"BIG", b"N", 20, 0), (b"F", b"F", 13, 6), (b"DAY", b"D", 8, 0), (b"OK", b"L", 1, 0), (b"ORD", b"N", 4, 0), (b"NAME", b"C", 4, 0), (b"LONG", b"C", 300, 0)]


def made(n, encoding):
    pick, rows, want = random.Random(2), [], []
    for i in range(n):
        name = pick.choice(["Ñandú", "Straße", "", "plain"])
        rows.append((name.encode(encoding), b"" if i % 5 == 0 else str(i - 3).encode(), f"{i / 8:.4f}".encode() if i % 4 else b"************", str(10**17 + i).encode(), f"{i / 3:.6f}".encode(), b"20240229" if i % 3 else b"00000000", b"TFy? "[i % 5 : i % 5 + 1], str(i % 9).encode(), b"x", ("é" * 120).encode(encoding)[:300]))
        want.append((name or None, None if i % 5 == 0 else i - 3, i / 8 if i % 4 else None, float(10**17 + i), round(i / 3, 6), datetime.date(2024, 2, 29) if i % 3 else None, (True, False, True, None, None)[i % 5], i % 9, "x", "é" * 120))
    return rows, want


@pytest.mark.parametrize("language, page, encoding", [(0x03, None, "cp1252"), (0x02, None, "cp850"), (0, None, "latin-1"), (0x03, "UTF-8", "utf-8"), (0, "ANSI 1252", "cp1252"), (0x57, "no such page", "cp1252")])
def test_attributes(spark, tmp_path, monkeypatch, language, page, encoding):
    monkeypatch.setattr(shapefile, "CHUNK_BYTES", 2000)
    n, gone = 60, {0, 7, 59}
    rows, want = made(n, encoding)
    write_shapes(tmp_path / "a.shp", [struct.pack("<i", 1) + points([(-58.0 - i / 100, -34.0)]) for i in range(n)])
    write_table(tmp_path / "a.dbf", FIELDS, rows, language, gone)
    if page:
        (tmp_path / "a.cpg").write_text(page)
    df, names = shapefile.read(spark, str(tmp_path / "a.shp"))
    assert names == ["NAME", "N", "RATE", "BIG", "F", "DAY", "OK", "ORD_", "NAME_", "LONG"]
    assert [t for c, t in df.dtypes if c in names] == ["string", "bigint", "double", "double", "double", "date", "boolean", "bigint", "string", "string"]
    assert {r.ord: tuple(r[c] for c in names) for r in df.collect()} == {i: w for i, w in enumerate(want) if i not in gone}
    layer = layers.read_shapefile(spark, str(tmp_path / "a.shp"))
    assert layer.count() == n - len(gone) and set(names) <= set(layer.columns)


@pytest.mark.parametrize("with_index, hole", [(True, 0), (True, 24), (False, 0)])
def test_shapes_by_index(spark, tmp_path, monkeypatch, with_index, hole):
    """Shapes of all sizes, one of them larger than a chunk, some empty; several tasks parse them."""
    monkeypatch.setattr(shapefile, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(shapefile.index, "__defaults__", (1500,))
    pick, bodies, want = random.Random(3), [], []
    for i in range(200):
        line = [(-58.0 - i / 1000, -34.0 - j / 1000) for j in range(300 if i == 50 else pick.randrange(2, 12))]
        if i % 13 == 5:
            bodies.append(struct.pack("<i", 0))
        else:
            bodies.append(struct.pack("<i4d2i", 3, 0, 0, 0, 0, 1, len(line)) + struct.pack("<i", 0) + points(line))
            want.append((i, 0, "LineString", [[list(p) for p in line]]))
    write_shapes(tmp_path / "a.shp", bodies, with_index, hole)
    df = shapefile.read_shapes(spark, str(tmp_path / "a.shp"))
    assert sorted((r.ord, r.part, r.geom_type, r.rings) for r in df.collect()) == want
    tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4 if with_index else tasks == 1


def test_more_shapes_than_records_and_empty_files(spark, tmp_path):
    write_shapes(tmp_path / "a.shp", [struct.pack("<i", 1) + points([(1.0, 2.0)])] * 3)
    write_table(tmp_path / "a.dbf", FIELDS[:2], [(b"one", b"1"), (b"two", b"2")])
    df, _ = shapefile.read(spark, str(tmp_path / "a.shp"))
    assert sorted((r.ord, r.NAME, r.N) for r in df.collect()) == [(0, "one", 1), (1, "two", 2), (2, None, None)]
    write_shapes(tmp_path / "b.shp", [])
    write_table(tmp_path / "b.dbf", FIELDS[:2], [])
    df, names = shapefile.read(spark, str(tmp_path / "b.shp"))
    assert df.count() == 0 and names == ["NAME", "N"]


def test_broken_files(spark, tmp_path):
    (tmp_path / "a.shp").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="not a shapefile"):
        shapefile.read_shapes(spark, str(tmp_path / "a.shp"))
    with pytest.raises(ValueError, match="shorter"):
        shapefile.table(struct.pack("<4BIHH20x", 3, 124, 1, 1, 1, 65, 4) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([12, 0]) + b"\0" * 14 + b"\r")
    with pytest.raises(ValueError, match="overlap"):
        shapefile.index(struct.pack(">i", 9994) + b"\0" * 96 + struct.pack(">4i", 50, 100, 60, 10))
