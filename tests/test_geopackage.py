"""GeoPackage files read back by plain sqlite3, and geometries against struct."""

import datetime
import json
import random
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from corvane.sources import geopackage

ODD = [0.0, -0.0, 1.0, -1.0, 0.1, -58.4333, 2.0**-1022, 2.0**1023, 1.7976931348623157e308, 5e-324, 1 / 3, 3.0, 2.0**52 + 1, 1e-300, float("inf"), float("-inf")]


def test_doubles(spark):
    pick = random.Random(1)
    values = ODD + [pick.uniform(-180, 180) for _ in range(300)] + [2.0**e * s for e in range(-60, 60, 7) for s in (1, -1, 1.0000000000000002, 0.9999999999999999)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", geopackage.double_hex(F.col("v")).alias("h")).collect()
    normal = lambda v: v if abs(v) >= 2.0**-1022 else 0.0
    assert [r.h for r in got] == [struct.pack("<d", normal(v)).hex().upper() for v in values]
    nan = spark.sql("select double('NaN') v").select(geopackage.double_hex(F.col("v")).alias("h")).first().h
    assert struct.unpack("<d", bytes.fromhex(nan))[0] != struct.unpack("<d", bytes.fromhex(nan))[0]


def test_geometries(spark):
    p = "array<struct<x:double,y:double>>"
    df = spark.createDataFrame([([(1.5, -2.0), (3.0, 4.25)], [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], [(0.1, 0.1), (0.2, 0.1), (0.1, 0.2), (0.1, 0.1)]])], f"line {p}, rings array<{p}>")
    r = df.select(geopackage.path(F.col("line"), 32721).alias("l"), geopackage.area(F.col("rings")).alias("a"), geopackage.point(F.lit(1.0), F.lit(2.0)).alias("p")).first()
    head = lambda srs: b"GP\x00\x01" + struct.pack("<i", srs)
    points = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<2d", *q) for q in ps)
    source = df.first()
    assert bytes(r.l) == head(32721) + b"\x01\x02\x00\x00\x00" + points(source.line)
    assert bytes(r.a) == head(4326) + b"\x01\x03\x00\x00\x00" + struct.pack("<I", 2) + b"".join(map(points, source.rings))
    assert bytes(r.p) == head(4326) + b"\x01\x01\x00\x00\x00" + struct.pack("<2d", 1.0, 2.0)


def test_file(spark, tmp_path):
    rows = [(i, f"c{i}", -58.0 - i / 7, None if i == 5 else -34.0 + i / 9, i % 2 == 0, None if i % 3 else i, [{"nomoficial": "Ñandú", "bearing_deg": 1.5}, {"nomoficial": None, "bearing_deg": None}], datetime.date(2024, 1, 1 + i % 20)) for i in range(700)]
    df = spark.createDataFrame(rows, 'n int, id string, lon double, lat double, flag boolean, `odd "name` long, branches array<struct<nomoficial:string,bearing_deg:double>>, day date').repartition(6)
    target = str(tmp_path / "out" / "a.gpkg")
    for _ in range(2):
        geopackage.write(df, target, "my layer", order="n", leave=("n",))
    db = sqlite3.connect(target)
    assert db.execute("PRAGMA application_id").fetchone()[0] == 0x47504B47 and db.execute("PRAGMA integrity_check").fetchone()[0] == "ok"
    known = [r for r in rows if r[3] is not None]
    bounds = db.execute("select table_name, data_type, min_x, min_y, max_x, max_y, srs_id from gpkg_contents").fetchall()
    assert bounds == [("my layer", "features", min(r[2] for r in known), min(r[3] for r in known), max(r[2] for r in known), max(r[3] for r in known), 4326)]
    assert db.execute("select table_name, column_name, geometry_type_name, srs_id from gpkg_geometry_columns").fetchall() == [("my layer", "geom", "POINT", 4326)]
    assert {r[0] for r in db.execute("select srs_id from gpkg_spatial_ref_sys")} == {4326, -1, 0}
    got = db.execute('select fid, geom, id, flag, "odd ""name", branches, day from "my layer" order by fid').fetchall()
    assert len(got) == 700
    for (fid, geom, name, flag, odd, branches, day), r in zip(got, rows):
        assert (fid, name, bool(flag), odd, day) == (r[0] + 1, r[1], r[4], r[5], str(r[7])) and json.loads(branches) == r[6]
        assert (geom is None) == (r[3] is None) and (geom is None or struct.unpack("<2d", geom[13:]) == (r[2], r[3]))
    back = geopackage.read(spark, target, "my layer", 'id string, flag boolean, `odd "name` long, geom binary')
    assert [(x[0], x[1], x[2]) for x in back.collect()] == [(r[1], r[4], r[5]) for r in rows]


def test_empty_layer_and_clashing_names(spark, tmp_path):
    geopackage.write(spark.createDataFrame([], "id string, lon double, lat double"), str(tmp_path / "e.gpkg"), "e")
    db = sqlite3.connect(str(tmp_path / "e.gpkg"))
    assert db.execute("select count(*) from e").fetchone()[0] == 0 and db.execute("select min_x from gpkg_contents").fetchone()[0] is None
    with pytest.raises(ValueError):
        geopackage.write(spark.createDataFrame([], "FID string, lon double, lat double"), str(tmp_path / "f.gpkg"), "f")


def test_other_system(spark, tmp_path):
    geopackage.write(spark.createDataFrame([(3e5, 6e6)], "x double, y double"), str(tmp_path / "m.gpkg"), "m", "x", "y", srs=32721)
    db = sqlite3.connect(str(tmp_path / "m.gpkg"))
    assert db.execute("select organization, organization_coordsys_id from gpkg_spatial_ref_sys where srs_id = 32721").fetchall() == [("EPSG", 32721)]
    assert struct.unpack("<i", db.execute("select geom from m").fetchone()[0][4:8])[0] == 32721
