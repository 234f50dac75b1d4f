"""Features of GeoJSON collections of any size, read by many tasks.

Spark's text reader cuts a file at its byte ranges, with ``}`` ending a line, so a range's text is whole up to a
brace. What a range means depends on where it begins: in a string or not, and how deep in objects and arrays. Each range
is therefore read first for both beginnings, which leaves one small row a range; the driver folds these rows,
some hundred bytes a range, in the order of the file. Then each range knows where it begins and its tasks
emit the features that begin in it. A feature that is cut by a border comes in pieces, put together by its number.

Features are the objects in the array ``features`` of the outermost object; what stands outside of them, such as ``crs``, is
put together on the driver and must stay under ``OUTSIDE_BYTES``.

Defined results: an object without such an array has no features; entries of the array that are no objects, and text
that ends before its brackets do, are errors; braces, brackets and quotes in strings are text, escaped ones too; the
bytes may be of UTF-8 or of any encoding that has ASCII in its place, as Latin-1.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.storage import shared_folder

#: Bytes outside of features, at most.
OUTSIDE_BYTES = 16 << 20
FEATURES = "file string, ord long, block long, whole boolean, system string, text binary"
_QUOTE, _BACK = 34, 92
_KIND = np.zeros(256, np.int8)
_KIND[[ord(c) for c in "{}[]"]] = (1, 2, 3, 4)
OPEN, CLOSE, ARRAY, END = 1, 2, 3, 4


class Place(NamedTuple):
    """Where a text begins: 1 in a string, else 0; open objects and arrays; entries begun and ended, and arrays of entries begun, so far."""

    text: int = 0
    objects: int = 0
    arrays: int = 0
    begun: int = 0
    ended: int = 0
    lists: int = 0


def marks(data: np.ndarray, text: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and kinds of the braces and brackets outside of strings, and whether the text ends in a string."""
    quotes, backs = np.flatnonzero(data == _QUOTE), np.flatnonzero(data == _BACK)
    if len(backs) and len(quotes):
        # A quote after an odd run of backslashes is one of the text.
        run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(backs) != 1]), np.arange(len(backs)), 0))
        last = np.searchsorted(backs, quotes) - 1
        after = (last >= 0) & (backs[last] == quotes - 1)
        quotes = quotes[~(after & ((last - run[last]) % 2 == 0))]
    kinds = _KIND[data]
    at = np.flatnonzero(kinds)
    at = at[(np.searchsorted(quotes, at) + text) % 2 == 0]
    return at, kinds[at], (len(quotes) + text) % 2


def depths(kinds: np.ndarray, objects: int, arrays: int) -> tuple[np.ndarray, np.ndarray]:
    """Open objects and arrays before each mark, and at the end."""
    step = lambda up, down: np.concatenate([[0], np.cumsum((kinds == up).astype(np.int64) - (kinds == down))])
    return objects + step(OPEN, CLOSE), arrays + step(ARRAY, END)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """Texts of some batches' lines, each with its file and the start of its range, closing braces put back."""
    for batch in batches:
        file, block = np.array(batch.column("file").to_pylist(), object), np.asarray(batch.column("block"))
        cut = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(block)]
        for a, b in zip(cut, cut[1:]):
            if b > a:
                yield (file[a], int(block[a])), b"}".join(batch.column("value").slice(a, b - a).to_pylist()) + b"}"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): text up to each closing brace, and the start of its range in its file."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _survey(batches):
    """A row for each range: for both beginnings, how it ends, how its depth changes, and at what depths objects and arrays begin and objects end."""
    found: dict[tuple[str, int], list[dict]] = {}
    for key, data in _blocks(batches):
        both = found.setdefault(key, [{"text": t, "objects": 0, "arrays": 0, "marks": Counter()} for t in (0, 1)])
        data = np.frombuffer(data, np.uint8)
        for s in both:
            _, kinds, s["text"] = marks(data, s["text"])
            o, a = depths(kinds, s["objects"], s["arrays"])
            s["objects"], s["arrays"] = int(o[-1]), int(a[-1])
            for kind in (OPEN, CLOSE, ARRAY):
                at = np.flatnonzero(kinds == kind)
                pairs, many = np.unique(np.stack([o[at], a[at]]), axis=1, return_counts=True)
                s["marks"].update({(kind, *map(int, p)): int(n) for p, n in zip(pairs.T, many)})
    rows = [(f, b, json.dumps([s | {"marks": [[*k, n] for k, n in s["marks"].items()]} for s in both])) for (f, b), both in found.items()]
    columns = list(zip(*rows)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["file", "block", "found"])


def _fold(rows: list) -> dict[tuple[str, int], Place]:
    """Where each range of each file begins."""
    out, at, file = {}, Place(), None
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            _whole(file, at)
            at, file = Place(), r["file"]
        out[r["file"], r["block"]] = at
        s = json.loads(r["found"])[at.text]
        # An entry is an object in an array of the outermost object.
        entries = {(k, o + at.objects, a + at.arrays): n for k, o, a, n in s["marks"]}
        at = Place(s["text"], at.objects + s["objects"], at.arrays + s["arrays"], at.begun + entries.get((OPEN, 1, 1), 0), at.ended + entries.get((CLOSE, 2, 1), 0), at.lists + entries.get((ARRAY, 1, 0), 0))
    _whole(file, at)
    return out


def _whole(file: str | None, at: Place) -> None:
    # The reader's last line may end without the brace that is put back.
    if at.text or at.arrays or at.objects not in (0, -1):
        raise ValueError(f"{file} ends before its brackets do")


def _entries(batches, places: dict[tuple[str, int], Place], outside: bool):
    """(file, ord, block, whole, list, text) of the entries that begin in each range or go on in it, or only what stands outside of them."""
    key, at, held, seq, entered = None, Place(), [], 0, False

    def unfinished():
        return [(*key, at.begun - 1, False, at.lists - 1, b"".join(held))] if held else []

    for new, data in _blocks(batches):
        out = []
        if new != key:
            if key:
                out += unfinished()
            key, at, held, seq, entered = new, places[new], [], 0, False
        raw = np.frombuffer(data, np.uint8)
        where, kinds, text = marks(raw, at.text)
        o, a = depths(kinds, at.objects, at.arrays)
        begin = where[(kinds == OPEN) & (o[:-1] == 1) & (a[:-1] == 1)]
        end = where[(kinds == CLOSE) & (o[:-1] == 2) & (a[:-1] == 1)] + 1
        lists = where[(kinds == ARRAY) & (o[:-1] == 1) & (a[:-1] == 0)]
        inside = at.begun > at.ended
        starts, ends = ([0] if inside else []) + begin.tolist(), end.tolist()
        of = at.lists - 1 + np.searchsorted(lists, starts)
        if outside:
            here = 0
            for s, e in zip([*starts, len(data)], [*ends, len(data)] if len(ends) == len(starts) else [*ends, len(data), len(data)]):
                piece, k = data[here:s], int(a[np.searchsorted(where, here)])
                if piece and not (k == 1 and not piece.strip(b" \t\r\n,")):
                    out.append((*key, seq, True, 0, piece))
                    seq += 1
                here = e
        else:
            for i, (s, e) in enumerate(zip(starts, ends)):
                number = at.begun - inside + i
                whole = not (inside and i == 0 and not entered)
                out.append((*key, number, whole, int(of[i]), b"".join([*held, data[s:e]])))
                held = []
            if len(starts) > len(ends):
                held.append(data[starts[-1] :])
                entered = entered or bool(len(begin)) and starts[-1] == begin[-1]
            else:
                entered = False
        at = Place(text, int(o[-1]), int(a[-1]), at.begun + len(begin), at.ended + len(end), at.lists + len(lists))
        yield _table(out)
    if key:
        yield _table(unfinished())


def _table(rows: list[tuple]) -> pa.RecordBatch:
    file, block, number, whole, lists, text = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(file, pa.string()), pa.array(block, pa.int64()), pa.array(number, pa.int64()), pa.array(whole, pa.bool_()), pa.array(lists, pa.int64()), pa.array(text, pa.binary())], ["file", "block", "ord", "whole", "list", "text"])


ENTRIES = "file string, block long, ord long, whole boolean, list long, text binary"


class Read(NamedTuple):
    #: (file, ord, system, text), ``system`` being the name of its file's ``crs``
    features: DataFrame
    #: how many ranges they are read in
    ranges: int
    #: the files' systems, None where a file names none
    systems: set[str | None]


def read(spark: SparkSession, path: str) -> Read:
    """The features of the files at ``path``."""
    raw = lines(spark, path)
    places = _fold(raw.mapInArrow(_survey, "file string, block long, found string").collect())
    around = raw.mapInArrow(lambda b: _entries(b, places, True), ENTRIES)
    # One range's text is no larger than the range; that of many is measured before it comes to the driver.
    size = around.agg(F.sum(F.length("text"))).first()[0] or 0 if len(places) > len({f for f, _ in places}) else 0
    found = around.select("file", "block", "ord", "text").collect() if size <= OUTSIDE_BYTES else []
    if (size := max(size, sum(len(r["text"]) for r in found))) > OUTSIDE_BYTES:
        raise ValueError(f"{path} has {size} bytes outside of features")
    texts: dict[str, list[bytes]] = {}
    for r in sorted(found, key=lambda r: (r["file"], r["block"], r["ord"])):
        texts.setdefault(r["file"], []).append(bytes(r["text"]))
    systems, chosen = {}, {}
    for file, pieces in texts.items():
        text = b"".join(pieces).decode("latin-1").removeprefix("\u00ef\u00bb\u00bf").strip()
        outer, _ = json.JSONDecoder().raw_decode(text)
        lists = [k for k, v in outer.items() if isinstance(v, list)] if isinstance(outer, dict) else []
        chosen[file] = lists.index("features") if "features" in lists else -1
        crs = outer.get("crs") if isinstance(outer, dict) else None
        inner = crs.get("properties") if isinstance(crs, dict) else None
        name = inner.get("name") if isinstance(inner, dict) else None
        systems[file] = None if name is None else str(name)

    def pick(batches):
        for batch in _entries(batches, places, False):
            file = batch.column("file").to_pylist()
            mine = np.array([chosen.get(f, -1) for f in file], np.int64) == np.asarray(batch.column("list")) if file else np.zeros(0, bool)
            got = batch.filter(pa.array(mine))
            yield pa.RecordBatch.from_arrays([got.column("file"), got.column("ord"), got.column("block"), got.column("whole"), pa.array([systems.get(f) for f in got.column("file").to_pylist()], pa.string()), got.column("text")], ["file", "ord", "block", "whole", "system", "text"])

    found = raw.mapInArrow(pick, FEATURES)
    joined = F.aggregate(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), F.lit(bytearray()), lambda all_, p: F.concat(all_, p))
    cut = found.filter("not whole").groupBy("file", "ord", "system").agg(joined.alias("text"))
    return Read(found.filter("whole").select("file", "ord", "system", "text").unionByName(cut.select("file", "ord", "system", "text")), len(places), set(systems.values()))


def write(features: DataFrame, path: str, system: str | None = None) -> None:
    """One file with the collection of the features (place, value), by place, one a line; ``system`` names what other system than degrees they are in.

    The tasks sort them, one of them writes the file, which takes its name when it is whole; no row passes the driver.
    """
    last = features.agg(F.max("place")).first()[0]
    line = F.when(F.col("place") == F.lit(last), F.col("value")).otherwise(F.concat("value", F.lit(",")))
    named = f'"crs": {{"type": "name", "properties": {{"name": {json.dumps(system)}}}}}, ' if system else ""
    frame = features.sparkSession.createDataFrame([(0, f'{{"type": "FeatureCollection", {named}"features": ['), (2, "]}")], "part int, value string")
    rows = features.select(F.lit(1).alias("part"), "place", line.alias("value")).unionByName(frame.withColumn("place", F.lit(None).cast(features.schema["place"].dataType)))
    rows.orderBy("part", "place").select("value").coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    _only_part(features.sparkSession, f"{path}.parts", path)


def _only_part(spark: SparkSession, folder: str, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(folder), hadoop.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(x.getPath() for x in fs.listStatus(source) if x.getPath().getName().startswith("part-"))
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"{part.toString()} can't be renamed to {path}")
    fs.delete(source, True)


def folder_for(spark: SparkSession, name: str) -> str:
    """A new folder in the one that the cluster shares."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
