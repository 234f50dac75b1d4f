"""Readers of layer files over many ranges, against plain parsers of the whole file."""

import json
import random

import numpy as np
import pytest

from corvane.sources import geojson, layers


@pytest.fixture
def small_ranges(spark):
    """Ranges of 200 bytes, and few rows in a batch, so that borders fall everywhere."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for k, v in zip(kept, ("200", "0", "3")):
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def odd_collection(n=60, seed=1):
    """Features with all that may mislead: brackets, quotes and backslashes in strings, nested objects and long shapes."""
    pick = random.Random(seed)
    names = ['plain', '{"', '}', '[[', 'a\\', '\\"}', '"', '\\\\"{', "ñandú }", ""]
    made = []
    for i in range(n):
        line = [[-58 + j / 1000, -34 - i / 1000] for j in range(pick.choice([2, 3, 90]))]
        made.append({"type": "Feature", "properties": {"name": pick.choice(names), "more": {"deep": [{"x": pick.choice(names)}]}, "n": i}, "geometry": {"type": "LineString", "coordinates": line}})
    return {"type": "FeatureCollection", "bbox": [1, 2, 3, 4], "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4326", "odd": [{"features": "}"}]}}, "others": [{"type": "no feature"}, {}], "features": made, "after": {"x": [1]}}


@pytest.mark.parametrize("indent, ascii_only, end", [(None, True, ""), (None, False, "\n"), (1, False, "\n\n"), (None, True, " ")])
def test_ranges_give_each_feature_once(spark, tmp_path, small_ranges, indent, ascii_only, end):
    want = odd_collection()
    (tmp_path / "a.geojson").write_bytes((json.dumps(want, indent=indent, ensure_ascii=ascii_only) + end).encode())
    found, ranges, _ = geojson.read(spark, str(tmp_path / "a.geojson"))
    rows = sorted(found.collect(), key=lambda r: r.ord)
    assert ranges > 20 and [json.loads(bytes(r.text)) for r in rows] == want["features"]
    assert {r.system for r in rows} == {"urn:ogc:def:crs:EPSG::4326"}


def test_several_files_of_one_path(spark, tmp_path, small_ranges):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"features": [{"properties": {"file": i, "n": j, "s": "}{" * j}} for j in range(20 * i)]}))
    found = geojson.read(spark, str(tmp_path)).features
    got = [json.loads(bytes(r.text))["properties"] for r in found.collect()]
    assert sorted((g["file"], g["n"]) for g in got) == sorted((i, j) for i in range(3) for j in range(20 * i))


@pytest.mark.parametrize("text, n", [("", 0), ("{}", 0), ('{"features": []}', 0), ('{"type": "Feature", "properties": {}}\n', 0), ('{"x": [{}], "features": [{"a": 1}, {"a": "\\\\"}]}', 2), ('﻿{"features": [{}]}', 1)])
def test_small_files(spark, tmp_path, text, n):
    (tmp_path / "a.json").write_text(text)
    assert geojson.read(spark, str(tmp_path / "a.json"))[0].count() == n


@pytest.mark.parametrize("text", ["no json", '{"features": [{"a": 1}', '{"features": [{"a": {"b": 1}, {"a": 2}]}', '{"features": [{"a": "x}]}', '{"features": [{}, null]}', '{"features": [{}] "crs": 1}'])
def test_broken_files(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(ValueError):
        geojson.read(spark, str(tmp_path / "a.json"))


def test_broken_feature_marks_its_layer(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}, {"geometry": nonsense}]}')
    with pytest.raises(Exception, match="(?i)malformed"):
        layers.read_geojson(spark, str(tmp_path / "a.json")).collect()


def test_too_much_outside(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geojson, "OUTSIDE_BYTES", 100)
    (tmp_path / "a.json").write_text(json.dumps({"note": "x" * 200, "features": [{}]}))
    with pytest.raises(ValueError, match="outside of features"):
        geojson.read(spark, str(tmp_path / "a.json"))


@pytest.mark.parametrize("seed", range(5))
def test_marks_against_a_plain_scanner(seed):
    pick = random.Random(seed)
    text = "".join(pick.choice('{}[]""\\\\ab,') for _ in range(400))
    for begin in (0, 1):
        inside, want, skip = bool(begin), [], False
        for i, c in enumerate(text):
            if skip:
                skip = False
            elif c == "\\" and text[i + 1 : i + 2] in ('"', "\\"):
                skip = True
            elif c == '"':
                inside = not inside
            elif not inside and c in "{}[]":
                want.append(i)
        at, _, ends = geojson.marks(np.frombuffer(text.encode(), np.uint8), begin)
        assert (at.tolist(), ends) == (want, int(inside))


def test_many_tasks_read_one_file(spark, tmp_path):
    """A file on one line, in ranges of a 16th: all of them have features, each feature once."""
    n = 40_000
    with (tmp_path / "big.geojson").open("w") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        f.write(", ".join(f'{{"type": "Feature", "properties": {{"n": {i}}}, "geometry": {{"type": "Point", "coordinates": [-58.{i:05d}, -34.5]}}}}' for i in range(n)))
        f.write("]}")
    key, size = "spark.sql.files.maxPartitionBytes", (tmp_path / "big.geojson").stat().st_size
    before = spark.conf.get(key)
    spark.conf.set(key, str(size // 16))
    try:
        df = layers.read_geojson(spark, str(tmp_path / "big.geojson"), properties={"n": "int"})
        found, ranges, _ = geojson.read(spark, str(tmp_path / "big.geojson"))
        sizes = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        rows = df.select("ord", "n", df.lonlat[0].lon.alias("lon")).collect()
    finally:
        spark.conf.set(key, before)
    assert ranges >= 16 and sum(s > n // 40 for s in sizes) >= 16
    assert sorted((r.ord, r.n, round(r.lon, 9)) for r in rows) == [(i, i, round(-float(f"58.{i:05d}"), 9)) for i in range(n)]


def test_collection_is_written_by_tasks_and_read_again(spark, tmp_path):
    df = spark.range(1000).selectExpr("999 - id as place", "concat('{\"n\": ', 999 - id, '}') as value").repartition(7)
    path = str(tmp_path / "out" / "all.geojson")
    for _ in range(2):
        geojson.write(df, path)
        assert json.loads(open(path, encoding="utf-8").read()) == {"type": "FeatureCollection", "features": [{"n": i} for i in range(1000)]}
    geojson.write(df.limit(0), path)
    assert json.loads(open(path, encoding="utf-8").read())["features"] == []


# CSV ---------------------------------------------------------------------------

def csv_rows(n, breaks):
    pick = random.Random(7)
    for i in range(n):
        note = pick.choice(["plain", 'say ""no""', "a;b", "Ñandú", ""]) + ("\nnext line" if breaks and i % 50 == 3 else "")
        yield f'{i},"{note}",{"SD" if i % 17 == 0 else -58 - i / 1e5},{-34.5}'


@pytest.mark.parametrize("encoding, breaks", [("utf-8", False), ("latin-1", False), ("latin-1", True), ("utf-8", True)])
def test_csv_over_many_ranges(spark, tmp_path, encoding, breaks):
    """The same rows as a plain reader of the whole file; the only bytes that are no UTF-8 stand in the last range."""
    import pandas as pd

    n = 5000
    text = "id,note,long,lat\n" + "\n".join(r if encoding == "utf-8" else r.replace("Ñandú", "plain") for r in csv_rows(n, breaks)) + f'\n{n},"último",-58.5,-34.5\n'
    (tmp_path / "a.csv").write_bytes(text.encode(encoding))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        df = layers.read_csv_points(spark, str(tmp_path / "a.csv"))
        tasks, got = df.rdd.getNumPartitions(), {(int(r.id), r.note or "") for r in df.select("id", "note").collect()}
    finally:
        spark.conf.set(key, before)
    want = pd.read_csv(tmp_path / "a.csv", encoding=encoding, dtype=str, keep_default_na=False)
    want = want[pd.to_numeric(want["long"], errors="coerce").notna()]
    assert got == set(zip(want["id"].astype(int), want["note"])) and (n, "último") in got
    assert tasks == 1 if breaks else tasks > 8
