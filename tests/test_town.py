"""The whole run on a small made town: layers, corners, axes, index, validation and all sinks."""

import copy
import json
import math
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from corvane.functions import geometry as g
from corvane.plans import config as cfg
from corvane.plans import risk
from corvane.sources import layers
from tests import town


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("town") / "raw"
    town.write(spark, out)
    return out


@pytest.fixture(scope="module")
def done(spark, folder, tmp_path_factory):
    config = cfg.parse(copy.deepcopy(town.CONFIG))
    r = risk.run(spark, config, str(folder))
    out = tmp_path_factory.mktemp("out")
    risk.export(r, config, str(out))
    rows = {(round(x["x"] - town.EAST), round(x["y"] - town.NORTH)): x for x in r.table.collect()}
    return config, r, out, rows


def test_corners(done):
    _, _, _, rows = done
    # three outer corners have two streets only; the fourth has the diagonal
    assert set(rows) == {(206 if x == 200 else x, y) for x in town.COLUMNS for y in town.COLUMNS} - {(0, 0), (400, 0), (0, 400)}
    plain, avenue, diagonal = rows[100, 100], rows[206, 100], rows[300, 300]
    assert (plain.n_branches, plain.n_merged_nodes, plain.is_diagonal, plain.has_avenida) == (4, 1, False, False)
    assert (avenue.n_branches, avenue.n_merged_nodes, avenue.is_diagonal, avenue.has_avenida) == (4, 2, False, True)
    assert (diagonal.n_branches, diagonal.is_diagonal) == (5, True) and diagonal.acute_angle_raw == pytest.approx(45, abs=0.2)
    assert plain.comuna == 1 and plain.barrio == "Núñez" and rows[300, 100].comuna == 2
    assert {b.nomoficial for b in avenue.branches} == {"AV C", "H1"} and sorted(round(b.bearing_deg) % 360 for b in avenue.branches) == [0, 90, 180, 270]
    assert plain.corner_id.startswith("c") and len({r.corner_id for r in rows.values()}) == len(rows) and plain.has_formal_crossing is None


def test_axes(done):
    _, r, _, rows = done
    width = lambda *at: (rows[at].crossing_length_raw, rows[at].roadway_width_raw)
    assert width(100, 100) == pytest.approx((10, 10), abs=0.05) and width(100, 200) == pytest.approx((20, 15), abs=0.05)
    assert width(206, 100) == pytest.approx((22, 16), abs=0.05)
    assert rows[0, 200].crossing_length_raw == pytest.approx(20, abs=0.05)  # the outer side has no sidewalk
    at = {k: v.crash_history_raw for k, v in rows.items() if v.crash_history_raw}
    assert at == {(100, 100): 9.0, (300, 300): 1.0, (206, 200): 3.0}
    c = rows[100, 100]
    assert (c.crash_count, c.crash_grave_count, c.crash_mortal_count, c.crash_early_count, c.crash_late_count) == (3, 1, 1, 1, 1)
    flow = {k: sum(w for p, w in (((100, 210), 1.0), ((110, 200), 1.0), ((206, 310), 3.0)) if math.dist(k, p) <= 100) for k in rows}
    assert {k: v.ped_flow_proxy_raw for k, v in rows.items()} == flow and sorted(set(flow.values())) == [0, 1, 2, 3]
    assert {k for k, v in rows.items() if v.has_ped_signal_raw} == {(206, 200)} and {k for k, v in rows.items() if v.traffic_calming_raw} == {(300, 300)}
    assert {k for k, v in rows.items() if v.near_school_raw} == {k for k in rows if math.dist(k, (320, 100)) <= 150}
    assert {k for k, v in rows.items() if v.heavy_traffic_raw} == {k for k in rows if k[1] == 300}
    assert {k for k, v in rows.items() if v.on_sendero_escolar} == {(0, 100), (100, 100)} and not any(v.near_ciclovia for v in rows.values())
    assert all(v.no_refuge_raw is None and v.speed_limit_raw is None and v.crossing_marked_raw is None for v in rows.values())
    assert set(r.weighted.excluded) == {"no_refuge", "speed_limit", "crossing_marked"} and r.weighted.excluded["crossing_marked"].startswith("requiere")


def _ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def test_index(done):
    config, r, _, rows = done
    weights, table = config.flat_weights(), list(rows.values())
    assert sum(r.weighted.included.values()) == pytest.approx(sum(weights.values()))
    assert r.weighted.methods["has_ped_signal"] == "binary" and r.weighted.methods["crash_history"] == "zero_inflated"
    norm = {}
    for axis, method in r.weighted.methods.items():
        raw = [x[f"{axis}_raw"] for x in table]
        known = [v for v in raw if v is not None and (method != "zero_inflated" or v > 0)]
        rank = dict(zip(known, (k / len(known) for k in _ranks(known))))
        norm[axis] = [v if method == "binary" or v is None else rank[v] if v in rank else 0.0 for v in raw]
        for got, want in zip((x[f"{axis}_norm"] for x in table), norm[axis]):
            assert (got is None) == (want is None) and (got is None or got == pytest.approx(want))
    risk_of = [sum((-1 if a in ("has_ped_signal", "traffic_calming") else 1) * r.weighted.included[a] * (norm[a][i] or 0.0) for a in norm) for i in range(len(table))]
    assert [x.riesgo_bruto for x in table] == pytest.approx(risk_of)
    want = [k / len(table) for k in _ranks([x.riesgo_bruto for x in table])]
    assert [x.indice for x in table] == pytest.approx(want)
    for comuna in (1, 2):
        mine = [x for x in table if x.comuna == comuna]
        assert [x.indice_comuna for x in mine] == pytest.approx([k / len(mine) for k in _ranks([x.riesgo_bruto for x in mine])])


def test_validation(done):
    _, r, _, rows = done
    table = list(rows.values())
    a, b = _ranks([x.indice for x in table]), _ranks([x.crash_history_raw for x in table])
    n, ma, mb = len(a), sum(a) / len(a), sum(b) / len(b)
    rho = sum((x - ma) * (y - mb) for x, y in zip(a, b)) / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))
    found = r.report["spearman_indice_compuesto_vs_siniestros"]
    assert r.report["status"] == "ok" and r.report["n_corners"] == n and found["rho"] == pytest.approx(rho)
    # two tails of Student's t by Simpson's rule
    t, df = abs(rho) * math.sqrt((n - 2) / (1 - rho * rho)), n - 2
    density = lambda x: math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi) * (1 + x * x / df) ** (-(df + 1) / 2)
    step = t / 2000
    area = sum((1 if k in (0, 2000) else 4 if k % 2 else 2) * density(k * step) for k in range(2001)) * step / 3
    assert found["p_value"] == pytest.approx(1 - 2 * area, abs=1e-9)
    assert -1 <= r.report["spearman_indice_geometrico_vs_siniestros"]["rho"] <= 1
    left = r.report["residuos"]
    assert len(left["geometria_alta_pocos_siniestros"]) == len(left["geometria_baja_muchos_siniestros"]) == 10
    assert set(left["geometria_alta_pocos_siniestros"]) <= {x.corner_id for x in table}


def test_sinks(spark, done):
    config, r, out, rows = done
    best = sorted(rows.values(), key=lambda x: (-x.indice, x.corner_ord))
    files = sorted(p.stem for p in (out / "fichas").glob("*.json"))
    assert files == sorted(x.corner_id for x in best[:7])
    doc = json.loads((out / "fichas" / f"{best[0].corner_id}.json").read_text(encoding="utf-8"))
    assert doc["indice_compuesto"] == pytest.approx(best[0].indice) and doc["desglose_por_eje"]["no_refuge"]["disponible"] is False and doc["texto_explicativo"].startswith("Esquina de ")
    assert [i["prioridad"] for i in doc["intervenciones"]] == sorted((i["prioridad"] for i in doc["intervenciones"]), reverse=True)
    report = json.loads((out / "reporte.json").read_text(encoding="utf-8"))
    assert [e["corner_id"] for e in report["esquinas"]] == [x.corner_id for x in best[:5]] and report["n_corners_total"] == len(rows)
    assert report["validacion"]["status"] == "ok" and report["ejes_excluidos"] == ["crossing_marked", "no_refuge", "speed_limit"]
    whole = json.loads((out / "esquinas.geojson").read_text(encoding="utf-8"))
    parts = [json.loads(x.value) for x in spark.read.text(str(out / "esquinas_por_linea")).collect()]
    assert len(whole["features"]) == len(parts) == len(rows)
    place = next(f for f in parts if f["properties"]["corner_id"] == best[0].corner_id)
    assert place["geometry"]["coordinates"] == [best[0].lon, best[0].lat] and place["properties"]["indice"] == round(best[0].indice, 4)
    assert spark.read.parquet(str(out / "esquinas.parquet")).count() == spark.read.parquet(str(out / "corners.parquet")).count() == len(rows)
    for name, table in (("corners", r.corners), ("esquinas", r.table)):
        db = sqlite3.connect(str(out / f"{name}.gpkg"))
        got = {c: (struct.unpack("<2d", g[13:]), json.loads(b)) for c, g, b in db.execute(f"select corner_id, geom, branches_json from {name}")}
        assert got == {x.corner_id: ((x.lon, x.lat), [b.asDict() for b in x.branches]) for x in table.collect()}
        assert not {"x", "y", "lon", "branches", "corner_ord"} & {c[1] for c in db.execute(f"pragma table_info({name})")}
    meta = json.loads((out / "run_metadata.json").read_text(encoding="utf-8"))
    assert set(meta["fuentes_no_disponibles"]) == {"semaforos", "censo", "sendas_peatonales"} and "no encontrado" in meta["fuentes_no_disponibles"]["semaforos"] and meta["n_corners"] == len(rows)
    assert json.loads((out / "validation_report.json").read_text(encoding="utf-8"))["status"] == "ok"


def test_layers(spark, folder):
    found = layers.load_all(spark, str(folder))
    crash = found.tables["siniestros"]
    assert crash.count() == 6  # rows without numbers for a place go
    school = found.tables["escuelas"].select(F.col("lonlat")[0].alias("p")).first().p
    assert -59 < school.lon < -57 and -35 < school.lat < -34
    assert {r.barrio for r in found.tables["callejero"].select("barrio").distinct().collect()} == {"Núñez", "Palermo"}
    assert found.tables["ferrocarril"].isEmpty() and "ferrocarril" not in found.usable()


@pytest.mark.parametrize("scope, streets, others", [
    ({"mode": "comuna", "comuna": 2}, lambda x: x >= 250, {"veredas": 8, "escuelas": 1, "paradas": 0, "transito_pesado": 1, "ciclovias": 1, "siniestros": 2}),
    ({"mode": "barrio", "barrio": "nunez"}, lambda x: x < 250, {"escuelas": 0, "paradas": 2, "ciclovias": 1, "transito_pesado": 1, "siniestros": 4}),
])
def test_scopes(spark, folder, scope, streets, others):
    scope = {"comuna": None, "barrio": None, "bbox": None, "buffer_m": 40.0} | scope
    found = layers.load(spark, str(folder), scope)
    want = sum(streets((line[0][0] + line[-1][0]) / 2) for _, line in town.street_lines())
    assert found.tables["callejero"].count() == want
    assert {k: found.tables[k].count() for k in others} == others


def test_box_scope(spark, folder):
    """A box between the streets, in a block: it holds no end of anything, but a sidewalk that holds it and the later line of a path."""
    at = layers.load_all(spark, str(folder)).tables["ciclovias"].select(F.explode("outline").alias("s")).select("s.*").filter("abs(y1 - y2) < 0.0002").first()
    x, y = (at.x1 + at.x2) / 2, (at.y1 + at.y2) / 2
    box = [x - 1e-6, y - 1e-6, x + 1e-6, y + 1e-6]
    found = layers.load(spark, str(folder), {"mode": "bbox", "comuna": None, "barrio": None, "bbox": box, "buffer_m": 40.0})
    assert {k: v.count() for k, v in found.tables.items() if k in ("callejero", "veredas", "ciclovias", "siniestros")} == {"callejero": 0, "veredas": 1, "ciclovias": 1, "siniestros": 0}


def test_a_line_that_crosses_a_street_is_near_it(spark):
    line = lambda *p: [tuple(map(float, p))]
    kind = "key long, shape array<struct<x1:double,y1:double,x2:double,y2:double>>, area boolean"
    street = spark.createDataFrame([(0, line(0, 0, 200, 0), False)], kind)
    lanes = spark.createDataFrame([(1, line(100, -100, 100, 100), False), (2, line(100, 50, 100, 100), False), (3, line(230, 10, 400, 10), False), (4, line(-70, -70, 90, 90), False)], kind)
    assert sorted(r.key for r in layers.crop_near(lanes, street, 40.0).collect()) == [1, 3, 4]


def test_broken_and_missing_streets(spark, folder, tmp_path):
    (tmp_path / "estaciones_de_subte.json").write_text("{ not json", encoding="utf-8")
    found = layers.load_all(spark, str(tmp_path))
    assert "callejero" in found.unavailable and found.unavailable["subte"].startswith("error al cargar")
    with pytest.raises(FileNotFoundError):
        layers.load(spark, str(tmp_path), {"mode": "all"})


def test_shapefile(spark, tmp_path):
    """Points, lines of two parts, a polygon with a hole and an empty shape."""
    record = lambda n, body: struct.pack(">2i", n, len(body) // 2) + body
    points = lambda ps: struct.pack(f"<{2 * len(ps)}d", *(v for p in ps for v in p))
    parts = lambda kind, rings: struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(rings), sum(map(len, rings))) + struct.pack(f"<{len(rings)}i", *(sum(map(len, rings[:i])) for i in range(len(rings)))) + b"".join(map(points, rings))
    at = lambda x, y: (-58.45 + x / 1000, -34.6 + y / 1000)
    square = lambda a, b: [at(a, a), at(b, a), at(b, b), at(a, b), at(a, a)]
    bodies = [struct.pack("<i", 1) + points([at(0, 0)]), parts(3, [[at(0, 0), at(1, 0)], [at(2, 0), at(2, 1), at(2, 2)]]), parts(5, [square(0, 9), square(3, 6)]), struct.pack("<i", 0), struct.pack("<i4di", 8, 0, 0, 0, 0, 2) + points([at(1, 1), at(2, 2)])]
    whole = b"".join(record(i + 1, b) for i, b in enumerate(bodies))
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(whole)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    (tmp_path / "censo.shp").write_bytes(header + whole)
    df = layers.load_all(spark, str(tmp_path)).tables["censo"]
    rows = [(r.ord, r.part, r.geom_type, len(r["shape"]), r.area) for r in df.orderBy("ord", "part").collect()]
    assert rows == [(0, 0, "Point", 1, False), (1, 0, "MultiLineString", 3, False), (2, 0, "Polygon", 8, True), (4, 0, "MultiPoint", 1, False), (4, 1, "MultiPoint", 1, False)]
    inside = df.filter("ord = 2").select(*(g.inside(F.lit(x), F.lit(y), F.col("outline")) for x, y in (at(1, 1), at(4, 4), at(10, 1)))).first()
    assert tuple(inside) == (True, False, False)
    (tmp_path / "censo.prj").write_text('PROJCS["WGS 84 / UTM zone 21S",GEOGCS["WGS 84",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","32721"]]')
    assert layers.load_all(spark, str(tmp_path)).tables["censo"].select("epsg").first().epsg == 32721
    (tmp_path / "censo.shp").write_bytes(b"nothing")
    assert "censo" in layers.load_all(spark, str(tmp_path)).unavailable
