"""Layers as GeoPackage files, which GIS programs open.

Geometries are encoded by column expressions: a GeoPackage header and well-known binary. The tasks encode and sort the rows; one
of them fills the file, which is one SQLite database, in its own folder and hands its bytes on in chunks. They stream
through the driver into the file system that the path names, so no row and no whole file is held anywhere.

Defined results: a null coordinate makes a null geometry; minus zero counts as zero, and numbers too small to be normal as zero too; nested
columns become JSON, with nulls kept; an empty table makes a layer without rows and bounds; a file that is there is replaced.
"""

from __future__ import annotations

import os
import sqlite3
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: Fixed values of the format: what marks a file, its version, and SQL types.
APPLICATION, VERSION = 0x47504B47, 10300
TYPES = {"string": "TEXT", "int": "MEDIUMINT", "bigint": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "binary": "BLOB", "date": "DATE", "timestamp": "DATETIME"}
KINDS = {"Point": 1, "LineString": 2, "Polygon": 3}
_WGS84 = 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4326"]]'
TABLES = """
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER NOT NULL PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT NOT NULL PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);
"""


def _little(hexed: Column, size: int) -> Column:
    """Hexadecimal digits of a number, so many bytes, lowest byte first."""
    whole = F.lpad(hexed, 2 * size, "0")
    return F.concat(*(F.substring(whole, 2 * (size - i) - 1, 2) for i in range(size)))


def double_hex(x: Column) -> Column:
    """The eight bytes of a number, lowest first, in hexadecimal digits; all steps are exact."""
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    # The logarithm may be off by one next to a power of two.
    exponent = F.when(size < power(guess), guess - 1).when(size >= power(guess + 1), guess + 1).otherwise(guess)
    part = ((size / power(exponent) - 1.0) * F.lit(2.0**52)).cast("long")
    bits = F.shiftleft((exponent + 1023).cast("long"), 52).bitwiseOR(part)
    normal = (size >= 2.0**-1022) & (size < float("inf"))
    special = F.when(F.isnan(x), F.lit(0x7FF8 << 48)).when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(F.lit(0))
    magnitude = F.when(normal & ~F.isnan(x), bits).otherwise(special)
    return _little(F.hex(F.when((x < 0) & (size >= 2.0**-1022) & ~F.isnan(x), magnitude.bitwiseOR(F.lit(-(2**63)))).otherwise(magnitude)), 8)


def _header(srs: int) -> str:
    # Magic, version 0, flags: little-endian, no envelope.
    return "47500001" + srs.to_bytes(4, "little", signed=True).hex().upper()


def point(x: Column, y: Column, srs: int = 4326) -> Column:
    return F.unhex(F.concat(F.lit(_header(srs) + "01" + "01000000"), double_hex(x), double_hex(y)))


def path(points: Column, srs: int = 4326) -> Column:
    """A line of an array of (x, y)."""
    return F.unhex(F.concat(F.lit(_header(srs) + "01" + "02000000"), _sequence(points)))


def area(rings: Column, srs: int = 4326) -> Column:
    """A polygon of an array of rings, arrays of (x, y)."""
    return F.unhex(F.concat(F.lit(_header(srs) + "01" + "03000000"), _little(F.hex(F.size(rings).cast("long")), 4), F.array_join(F.transform(rings, _sequence), "")))


def _sequence(points: Column) -> Column:
    each = F.transform(points, lambda p: F.concat(double_hex(p["x"]), double_hex(p["y"])))
    return F.concat(_little(F.hex(F.size(points).cast("long")), 4), F.array_join(each, ""))


def _columns(df: DataFrame, names: list[str]) -> list[tuple[str, Column, str]]:
    """Name, value and SQL type of each column."""
    out = []
    for name in names:
        kind = df.schema[name].dataType.simpleString()
        value = F.col(f"`{name}`")
        if kind in ("date", "timestamp"):
            value = value.cast("string")
        elif kind not in TYPES:
            value = value.cast("double") if kind.startswith("decimal") else F.to_json(value, {"ignoreNullFields": "false"})
        out.append((name, value, TYPES.get(kind, "DOUBLE" if kind.startswith("decimal") else "TEXT")))
    return out


def write(df: DataFrame, target: str, layer: str, x: str = "lon", y: str = "lat", order: str | None = None, leave: tuple[str, ...] = (), srs: int = 4326) -> None:
    """A file with one layer of points: all columns but ``x``, ``y`` and those of ``leave``, with rows numbered by ``order``."""
    names = [c for c in df.columns if c not in (x, y, *leave)]
    if clash := {"fid", "geom"} & {c.lower() for c in names}:
        raise ValueError(f"a layer has columns of its own named {sorted(clash)}")
    columns = _columns(df, names)
    types = [kind for _, _, kind in columns]
    px, py = F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")
    known = px.isNotNull() & py.isNotNull()
    bounds = tuple(df.filter(known).agg(F.min(px), F.min(py), F.max(px), F.max(py)).first())
    rows = df.select(*([F.col(f"`{order}`").alias("_order")] if order else []), F.when(known, point(px, py, srs)).alias("geom"), *(v.alias(f"c{i}") for i, (_, v, _) in enumerate(columns)))
    if order:
        rows = rows.orderBy("_order").drop("_order")

    def fill(batches):
        with tempfile.TemporaryDirectory() as folder:
            file = os.path.join(folder, "layer.gpkg")
            db = sqlite3.connect(file)
            db.execute(f"PRAGMA application_id = {APPLICATION}")
            db.execute(f"PRAGMA user_version = {VERSION}")
            db.executescript(TABLES)
            db.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, NULL)", [("WGS 84", 4326, "EPSG", 4326, _WGS84), ("Undefined Cartesian", -1, "NONE", -1, "undefined"), ("Undefined geographic", 0, "NONE", 0, "undefined")])
            if srs not in (4326, -1, 0):
                db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs}", srs, srs))
            quoted = ['"' + n.replace('"', '""') + '"' for n in (layer, *names)]
            own = "".join(f", {q} {kind}" for q, kind in zip(quoted[1:], types))
            db.execute(f"CREATE TABLE {quoted[0]} (fid INTEGER PRIMARY KEY AUTOINCREMENT NOT NULL, geom POINT{own})")
            for batch in batches:
                values = [c.to_pylist() for c in batch.columns]
                db.executemany(f"INSERT INTO {quoted[0]} ({', '.join(['geom', *quoted[1:]])}) VALUES ({', '.join('?' * len(values))})", zip(*values))
            db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (layer, layer, *bounds, srs))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POINT', ?, 0, 0)", (layer, srs))
            db.commit()
            db.close()
            with open(file, "rb") as f:
                while data := f.read(CHUNK_BYTES):
                    yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    _save(rows.coalesce(1).mapInArrow(fill, "data binary"), target)


def _save(chunks: DataFrame, target: str) -> None:
    """The chunks of one partition, one after the other, as a file."""
    spark = chunks.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        for row in chunks.toLocalIterator():
            out.write(row["data"])
    finally:
        out.close()


def read(spark: SparkSession, source: str, layer: str, schema: str) -> DataFrame:
    """Columns of a layer, by the names and types of ``schema``; geometries as binary. A file is read by one task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(spark.createDataFrame([], schema).schema)
    quoted = ", ".join('"' + n.replace('"', '""') + '"' for n in kinds.names)
    table = '"' + layer.replace('"', '""') + '"'

    def rows(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                db = sqlite3.connect(":memory:")
                db.deserialize(data)
                cursor = db.execute(f"SELECT {quoted} FROM {table} ORDER BY fid")
                while found := cursor.fetchmany(5000):
                    yield pa.RecordBatch.from_arrays([pa.array([None if v is None else bool(v) for v in c] if pa.types.is_boolean(f.type) else c, f.type) for c, f in zip(zip(*found), kinds)], schema=kinds)
                db.close()

    return spark.read.format("binaryFile").load(source).select("content").mapInArrow(rows, schema)
