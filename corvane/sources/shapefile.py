"""ESRI shapefiles as rows: shapes, and the attributes of the dBase table beside them.

The format's own offsets bound a file at some gigabytes, so one task may read a file's bytes; it does no more than cut
them in chunks of whole records, the shapes by the ``.shx`` index, the attributes by their fixed length. The chunks are
dealt out and parsed by all tasks. Shapes and attributes meet by their record numbers.

Defined results: without an index the shapes are read by one task; without a table they have no attributes; records that the
table marks as deleted are passed over with their shapes; shapes beyond the table's last record have null attributes; empty shapes are passed over;
an attribute named like a column of a layer gets ``_`` behind its name, and one named like another a number.
"""

from __future__ import annotations

import codecs
import datetime
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "ord long, part int, geom_type string, rings array<array<array<double>>>"
#: Names that attributes cannot have.
TAKEN = ("ord", "deleted", "part", "geom_type", "rings", "lonlat", "points", "shape", "outline", "area", "epsg", "m", "key")
CHUNK_BYTES = 1 << 20
#: Fixed values of the format: shape types, with those that also have heights or measures.
POINT, LINE, AREA, POINTS = (1, 11, 21), (3, 13, 23), (5, 15, 25), (8, 18, 28)
#: Fixed values of the format: code pages by the table's language byte; others are Latin-1.
CODE_PAGES = {0x01: "cp437", 0x02: "cp850", 0x03: "cp1252", 0x13: "cp932", 0x4D: "cp936", 0x4E: "cp949", 0x4F: "cp950", 0x57: "cp1252", 0x58: "cp1252", 0x64: "cp852", 0x65: "cp866", 0x66: "cp865", 0x6A: "cp737", 0x7D: "cp1255", 0x7E: "cp1256", 0xC8: "cp1250", 0xC9: "cp1251", 0xCA: "cp1254", 0xCB: "cp1253", 0xCC: "cp1257"}


def _points(data: bytes, at: int, n: int) -> list[list[float]]:
    return np.frombuffer(data, "<f8", 2 * n, at).reshape(n, 2).tolist()


def records(data: bytes, at: int = 0, record: int = 0) -> Iterator[tuple[int, int, str, list]]:
    """(record, part, type, rings) of the records from a place on; empty shapes are passed over. Rings of a polygon stay together, as holes are told by the even-odd rule."""
    while at + 8 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        kind, body = struct.unpack_from("<i", data, at + 8)[0], at + 12
        if kind in POINT:
            yield record, 0, "Point", [_points(data, body, 1)]
        elif kind in POINTS:
            for part, p in enumerate(_points(data, body + 36, struct.unpack_from("<i", data, body + 32)[0])):
                yield record, part, "MultiPoint", [[p]]
        elif kind in LINE + AREA:
            n_parts, n = struct.unpack_from("<2i", data, body + 32)
            starts = [*struct.unpack_from(f"<{n_parts}i", data, body + 40), n]
            points = _points(data, body + 40 + 4 * n_parts, n)
            rings = [points[a:b] for a, b in zip(starts, starts[1:])]
            yield record, 0, ("Polygon" if kind in AREA else "LineString" if n_parts == 1 else "MultiLineString"), rings
        elif kind:
            raise ValueError(f"unknown shape type {kind}")
        at, record = at + 8 + size, record + 1


def _checked(head: bytes) -> None:
    if len(head) < 100 or struct.unpack_from(">i", head)[0] != 9994:
        raise ValueError("not a shapefile")


def _beside(path: str, ending: str) -> str:
    return path[: -len(".shp")] + ending if path.lower().endswith(".shp") else path + ending


def _bytes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _head(spark: SparkSession, path: str, size: int) -> bytes | None:
    """A file's first bytes, none if there is no such file."""
    try:
        return bytes(_bytes(spark, path).select(F.substring("content", 1, size)).first()[0])
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _cut(spark: SparkSession, path: str, starts: list[int], sizes: list[int], firsts: list[int]) -> DataFrame:
    """(first, chunk): parts of a file, dealt out; the file stays where it is read."""
    i = F.explode(F.sequence(F.lit(0), F.lit(len(starts) - 1))).alias("i")
    at = lambda values: F.element_at(F.lit(values).cast("array<long>"), F.col("i") + 1)
    chunks = _bytes(spark, path).select("content", i).select(at(firsts).alias("first"), F.substring("content", (at(starts) + 1).cast("int"), at(sizes).cast("int")).alias("chunk"))
    return chunks.repartition(min(len(starts), 4 * spark.sparkContext.defaultParallelism), "first")


def index(data: bytes, most: int = CHUNK_BYTES) -> tuple[list[int], list[int], list[int]]:
    """Starts, sizes and first records of chunks of about ``most`` bytes, by the bytes of an .shx file. Records must follow each other."""
    _checked(data)
    at, size = np.frombuffer(data, ">i4", (len(data) - 100) // 8 * 2, 100).astype(np.int64).reshape(-1, 2).T * 2
    if not len(at):
        return [], [], []
    end = at + size + 8
    if (at[1:] < end[:-1]).any():
        raise ValueError("records of the index overlap")
    # A chunk ends before a gap, and where it has its size.
    gap = np.concatenate([[True], at[1:] != end[:-1]])
    part = (at - at[0]) // most
    first = np.flatnonzero(gap | np.concatenate([[True], part[1:] != part[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    return at[first].tolist(), (end[last] - at[first]).tolist(), first.tolist()


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """``ROWS`` of a file's shapes."""
    _checked(_head(spark, path, 100) or b"")
    whole = _head(spark, _beside(path, ".shx"), (1 << 31) - 1)
    if whole is None:
        chunks = _bytes(spark, path).select(F.lit(0).cast("long").alias("first"), F.expr("substring(content, 101)").alias("chunk"))
    else:
        starts, sizes, firsts = index(whole)
        if not starts:
            return spark.createDataFrame([], ROWS)
        chunks = _cut(spark, path, starts, sizes, firsts)

    def parse(batches):
        import pandas as pd

        for batch in batches:
            for first, data in zip(batch.column("first").to_pylist(), batch.column("chunk").to_pylist()):
                found = list(records(data, 0, first))
                for a in range(0, len(found), 10_000):
                    some = pd.DataFrame(found[a : a + 10_000], columns=["ord", "part", "geom_type", "rings"])
                    yield pa.RecordBatch.from_pandas(some, schema=_SHAPES, preserve_index=False)

    return chunks.mapInArrow(parse, ROWS)


_SHAPES = pa.schema([("ord", pa.int64()), ("part", pa.int32()), ("geom_type", pa.string()), ("rings", pa.list_(pa.list_(pa.list_(pa.float64()))))])


class Field(NamedTuple):
    name: str
    kind: str
    start: int
    length: int
    decimals: int

    @property
    def type(self) -> str:
        if self.kind in "NF":
            return "double" if self.kind == "F" or self.decimals or self.length > 18 else "long"
        return {"D": "date", "L": "boolean", "I": "int", "O": "double", "B": "double"}.get(self.kind, "string")


class Table(NamedTuple):
    records: int
    begin: int
    size: int
    encoding: str
    fields: list[Field]


def table(head: bytes, encoding: str | None = None) -> Table:
    """What the header of a dBase file says."""
    n, begin, size = struct.unpack_from("<IHH", head, 4)
    encoding = encoding or CODE_PAGES.get(head[29], "latin-1")
    fields, start, used = [], 1, {c.lower() for c in TAKEN}
    for at in range(32, begin - 32, 32):
        if head[at] == 0x0D:
            break
        name, kind, length, decimals = head[at : at + 11].split(b"\0")[0].decode(encoding, "replace").strip(), chr(head[at + 11]), head[at + 16], head[at + 17]
        if kind == "C":  # long texts keep the upper byte of their length in the place of decimals
            length, decimals = length + 256 * decimals, 0
        name = name or "field"
        own = name if name.lower() not in used else f"{name}_" if f"{name.lower()}_" not in used else next(f"{name}_{i}" for i in range(1, 10_000) if f"{name.lower()}_{i}" not in used)
        used.add(own.lower())
        fields.append(Field(own, kind, start, length, decimals))
        start += length
    if not size or start > size:
        raise ValueError("the table's records are shorter than its fields")
    return Table(n, begin, size, encoding, fields)


def _value(raw: bytes, field: Field, encoding: str):
    if field.kind in "IOB" and len(raw) == {"I": 4, "O": 8, "B": 8}[field.kind]:
        return struct.unpack("<i" if field.kind == "I" else "<d", raw)[0]
    text = raw.split(b"\0")[0].decode(encoding, "replace").strip()
    if field.type == "string":
        return text or None
    if field.type == "boolean":
        return True if text in tuple("TtYy") else False if text in tuple("FfNn") else None
    try:
        if field.type == "date":
            return datetime.date(int(text[:4]), int(text[4:6]), int(text[6:8]))
        # a number that does not fit is written as stars
        return float(text) if field.type == "double" else int(float(text)) if "." in text or "e" in text.lower() else int(text)
    except ValueError:
        return None


def read_attributes(spark: SparkSession, path: str) -> DataFrame | None:
    """(ord, deleted, attributes) of the table beside a file, None if there is none."""
    beside = _beside(path, ".dbf")
    head = _head(spark, beside, 1 << 16)
    if head is None:
        return None
    named = _head(spark, _beside(path, ".cpg"), 64)
    t = table(head, _encoding(named.decode("ascii", "replace")) if named else None)
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "date": pa.date32(), "int": pa.int32()}
    schema = pa.schema([("ord", pa.int64()), ("deleted", pa.bool_()), *((f.name, kinds[f.type]) for f in t.fields)])
    spark_schema = ", ".join(["ord long", "deleted boolean", *(f"`{f.name.replace('`', '``')}` {f.type}" for f in t.fields)])
    if not t.records:
        return spark.createDataFrame([], spark_schema)
    each = max(1, CHUNK_BYTES // t.size)
    firsts = list(range(0, t.records, each))
    chunks = _cut(spark, beside, [t.begin + f * t.size for f in firsts], [min(each, t.records - f) * t.size for f in firsts], firsts)

    def parse(batches):
        for batch in batches:
            for first, data in zip(batch.column("first").to_pylist(), batch.column("chunk").to_pylist()):
                rows = [data[a : a + t.size] for a in range(0, len(data) - t.size + 1, t.size)]
                columns = [[_value(r[f.start : f.start + f.length], f, t.encoding) for r in rows] for f in t.fields]
                yield pa.RecordBatch.from_arrays([pa.array(range(first, first + len(rows)), pa.int64()), pa.array([r[:1] == b"*" for r in rows], pa.bool_()), *(pa.array(c, kinds[f.type]) for c, f in zip(columns, t.fields))], schema=schema)

    return chunks.mapInArrow(parse, spark_schema)


def _encoding(named: str) -> str | None:
    """A Python codec of what a .cpg file says; None if there is none of that name."""
    name = named.strip().lower().removeprefix("ansi").strip()
    for guess in (name, f"cp{name}", {"88591": "latin-1", "65001": "utf-8"}.get(name, "")):
        try:
            return codecs.lookup(guess).name
        except LookupError:
            continue
    return None


def read(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """``ROWS`` and attributes, and the attributes' names."""
    shapes, attributes = read_shapes(spark, path), read_attributes(spark, path)
    if attributes is None:
        return shapes, []
    joined = shapes.join(attributes, "ord", "left").filter(~F.coalesce("deleted", F.lit(False))).drop("deleted")
    return joined, [c for c in attributes.columns if c not in ("ord", "deleted")]


def epsg(spark: SparkSession, path: str) -> int | None:
    """The system that the .prj file beside it names: the outermost EPSG number, degrees if it is a geographic one or if there is no such file."""
    try:
        text = spark.read.text(_beside(path, ".prj"), wholetext=True).first()[0]
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 4326
    if text.lstrip().upper().startswith("GEOG"):
        return 4326
    codes = [int(x.split('"')[1]) for x in text.upper().split('AUTHORITY["EPSG",')[1:]]
    return codes[-1] if codes else None
