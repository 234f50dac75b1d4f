"""Unit cases of single operators on values made by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import crs
from corvane.functions import geometry as g
from corvane.functions.text import number, repair
from corvane.operators import network, proximity, report, rules, scoring, transects
from corvane.plans import config as cfg
from tests import town


# Branches and angles -----------------------------------------------------------

@pytest.mark.parametrize("branches, n", [([("X", 90.0), ("X", 95.0), ("Y", 0.0)], 2), ([("X", 358.0), ("X", 2.0)], 1), ([("Y", 0.0), ("Y", 180.0)], 2)])
def test_dedupe(spark, branches, n):
    df = spark.createDataFrame([(1, i, *b) for i, b in enumerate(branches)], "k int, ord int, nomoficial string, bearing_deg double")
    assert network.dedupe_branches(df, "k", 30.0, F.col("ord"), F.struct("nomoficial", "bearing_deg")).count() == n


def test_angles(spark):
    cases = {(0.0, 90.0, 180.0, 270.0): (False, 0), (0.0, 45.0, 180.0, 225.0): (True, 45), (0.0, 90.0, 180.0): (False, 0), (0.0, 60.0, 180.0): (True, 30), (0.0,): (False, None)}
    df = spark.createDataFrame([(list(b),) for b in cases], "b array<double>")
    diagonal, acute = network.angle_metrics(F.col("b"), (70.0, 110.0))
    assert {tuple(r.b): (r.d, r.a) for r in df.select("b", diagonal.alias("d"), acute.alias("a")).collect()} == cases


def test_bearing_along_a_bent_path(spark):
    """The bearing is that of the point 15 m along the path, not of its first step; a short path gives its end."""
    kind = "k int, p array<struct<x:double,y:double>>"
    df = spark.createDataFrame([(0, [(0.0, 0.0), (0.0, 5.0), (30.0, 5.0)]), (1, [(0.0, 0.0), (3.0, 0.0)]), (2, [(0.0, 0.0), (0.0, 0.0), (0.0, -40.0)])], kind)
    to = g.along(F.col("p"), 15.0)
    got = {r.k: (round(r.x, 9), round(r.y, 9), r.b) for r in df.select("k", to["x"].alias("x"), to["y"].alias("y"), g.bearing(to["x"], to["y"]).alias("b")).collect()}
    assert got == {0: (10.0, 5.0, pytest.approx(math.degrees(math.atan2(10, 5)))), 1: (3.0, 0.0, pytest.approx(90)), 2: (0.0, -15.0, pytest.approx(180))}


def test_clusters_are_chains(spark):
    """Three nodes 20 m apart each are one cluster at 25 m, although the ends are 40 m apart."""
    df = spark.createDataFrame([(5, 0.0, 0.0), (7, 20.0, 0.0), (9, 40.0, 0.0), (11, 66.0, 0.0)], "node long, x double, y double")
    assert {r.node: r.root for r in network.cluster(df, 25.0).collect()} == {5: 5, 7: 5, 9: 5, 11: 11}


# Transects -------------------------------------------------------------------

BOXES = {"narrow": [(5, 0, 15, 30), (-15, 0, -5, 30)], "one": [(5, 0, 15, 30)], "wide": [(12, 0, 22, 30), (-22, 0, -12, 30)]}


@pytest.mark.parametrize("boxes, bearing, width", [("narrow", 0.0, 10.0), ("one", 0.0, None), ("narrow", 90.0, None), ("wide", 0.0, 24.0)])
def test_width(spark, boxes, bearing, width):
    ring = lambda a, b, c, d: [(a, b, c, b), (c, b, c, d), (c, d, a, d), (a, d, a, b)]
    walks = spark.createDataFrame([([tuple(map(float, s)) for s in ring(*b)],) for b in BOXES[boxes]], "shape array<struct<x1:double,y1:double,x2:double,y2:double>>")
    branch = spark.createDataFrame([(1, 0, 0.0, 0.0, bearing)], "key int, branch int, x double, y double, bearing_deg double")
    assert transects.roadway_widths(branch, walks).first().width == (None if width is None else pytest.approx(width))


# Scoring ---------------------------------------------------------------------

@pytest.mark.parametrize("method, values, want", [
    ("percentile", [10, 20, 30, 40], [0.25, 0.5, 0.75, 1.0]), ("percentile", [1, 2, 2, 3], [0.25, 0.625, 0.625, 1.0]), ("minmax", [10, 20, 30], [0, 0.5, 1]), ("percentile", [5, 5, 5], [0.5] * 3), ("minmax", [5, 5], [0.5] * 2),
    ("percentile", [1, None, 3], [0.5, None, 1.0]), ("percentile", [None, None], [None, None]), ("binary", [0, 0, 0, 1], [0, 0, 0, 1]), ("zero_inflated", [0, 0, 2, 5, None], [0, 0, 0.5, 1.0, None]), ("zero_inflated", [0, 0, 0], [0, 0, 0]),
])
def test_normalise(spark, method, values, want):
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "i int, v double")
    assert [r.n for r in scoring.normalise(df, "v", "n", method).orderBy("i").collect()] == want


def test_normalise_with_clashing_names(spark):
    """Columns may have any names, those of the operator's own steps too."""
    names = ["i", "g", "v", "n", "r", "row", "row_id", "score", "low", "all", "a.b"]
    df = spark.createDataFrame([(k, k % 2, float(k), 1, 1, 1, 1, 1, 1, 1, float(-k)) for k in range(6)], ", ".join(f"`{c}` {'double' if c in ('v', 'a.b') else 'int'}" for c in names))
    out = scoring.normalise_all(df, [("v", "n", "percentile", "g"), ("a.b", "low", "minmax", None), ("i", "extra", "rank", None)])
    assert sorted(out.columns) == sorted([*names, "extra"])
    assert [(r.n, r.low, round(r.extra, 9)) for r in out.orderBy("i").collect()] == [((k // 2 + 1) / 3, (5 - k) / 5, round((k + 1) / 6, 9)) for k in range(6)]
    with pytest.raises(ValueError):
        scoring.normalise(df, "v", "n", "other")


def test_index_by_group(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), ("c", 2, 100.0), ("d", 2, 200.0), ("e", None, 5.0)], "k string, comuna int, n_branches double")
    got = {r.k: r for r in scoring.compute_index(df, {"n_branches": 1.0}, group="comuna").scores.collect()}
    assert got["b"].indice_comuna == got["d"].indice_comuna == 1.0 and got["c"].indice > got["b"].indice and got["e"].indice_comuna is None
    alone = scoring.compute_index(df.drop("comuna"), {"n_branches": 1.0, "never": 2.0})
    assert all(r.indice == r.indice_comuna for r in alone.scores.collect())
    assert alone.included == {"n_branches": 3.0} and set(alone.excluded) == {"never"}


# Rules -----------------------------------------------------------------------

SAFE = {"crossing_length_norm": 0.2, "crossing_length_raw": 8.0, "roadway_width_norm": 0.2, "roadway_width_raw": 8.0, "acute_angle_norm": 0.1, "acute_angle_raw": 2.0, "is_diagonal": False, "near_school_raw": 0.0, "crash_history_raw": 0.0, "ped_flow_proxy_norm": 0.1, "has_ped_signal_raw": 1.0, "traffic_calming_raw": 1.0, "heavy_traffic_raw": 0.0}


@pytest.mark.parametrize("change, kinds", [
    ({}, []), ({"crossing_length_norm": 0.9, "crossing_length_raw": 32.0}, ["Acortar el cruce"]), ({"has_ped_signal_raw": 0.0, "near_school_raw": 1.0}, ["Instalar semáforo peatonal"]), ({"has_ped_signal_raw": 0.0}, []), ({"is_diagonal": True}, ["Enderezar el cruce"]),
    ({"near_school_raw": 1.0, "traffic_calming_raw": 0.0}, ["Calmar el tránsito"]), ({"crossing_length_norm": 0.9, "crossing_length_raw": 30.0, "has_ped_signal_raw": 0.0, "near_school_raw": 1.0, "crash_history_raw": 10.0}, ["Acortar el cruce", "Instalar semáforo peatonal"]),
])
def test_interventions(spark, change, kinds):
    row = SAFE | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if k == 'is_diagonal' else 'double'}" for k in row))
    found = df.select(rules.interventions(0.75).alias("i")).first().i
    assert [i.tipo for i in found] == kinds and [i.prioridad for i in found] == sorted((i.prioridad for i in found), reverse=True)
    if row["crossing_length_raw"] == 32.0:
        assert "32 m" in found[0].motivo


# Report page ------------------------------------------------------------------

def test_report_ranks_before_it_filters(spark):
    iv = [("Calmar el tránsito",)]
    df = spark.createDataFrame([(i, i / 10, i % 3 or None, iv if i % 2 else [], float(i % 2), None) for i in range(8)], "corner_ord int, indice double, comuna int, intervenciones array<struct<tipo:string>>, has_ped_signal_raw double, traffic_calming_raw double").withColumn("crossing_marked_raw", F.lit(1.0))
    best = report.top(df, 6)
    assert [(r.rank, r.corner_ord) for r in report.keep(best, 1, "Calmar el tránsito").orderBy("rank").collect()] == [(1, 7)]
    assert [r.rank for r in report.keep(best, 2).orderBy("rank").collect()] == [3, 6]
    assert sorted(r.comuna for r in report.districts(best).collect()) == [1, 2]
    chips = best.select("corner_ord", report.mitigation({"crossing_marked": ""}).alias("m")).collect()
    assert {r.corner_ord: [(m.nombre, m.presente) for m in r.m] for r in chips} == {i: [("Semáforo peatonal", i % 2 == 1)] for i in range(2, 8)}


@pytest.mark.parametrize("axis, raw, text", [("crossing_length", 12.4, "12 m"), ("roadway_width", 9.6, "10 m"), ("acute_angle", 45.0, "45°"), ("crash_history", 7.0, "7 pts"), ("near_school", 1.0, "sí"), ("heavy_traffic", 0.0, "no"), ("no_refuge", None, "—"), ("n_branches", 5.0, "5"), ("ped_flow_proxy", 3.0, "3")])
def test_shown(spark, axis, raw, text):
    assert spark.createDataFrame([(raw,)], "v double").select(report.shown(axis, F.col("v")).alias("t")).first().t == text


# Coordinates -----------------------------------------------------------------

def plain_transverse_mercator(lon, lat, lon0, k0, east0, north0, a, inverse_f, lat0=0.0):
    """The textbook series in powers of the difference of longitudes, with the meridian arc by numeric integration."""
    f = 1 / inverse_f
    e2 = f * (2 - f)
    phi, dl = math.radians(lat), math.radians(lon - lon0)

    def arc(to):
        n = 2000
        step = to / n
        h = lambda p: a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
        return sum((1 if i in (0, n) else 4 if i % 2 else 2) * h(i * step) for i in range(n + 1)) * step / 3

    nu, t, c = a / math.sqrt(1 - e2 * math.sin(phi) ** 2), math.tan(phi) ** 2, e2 / (1 - e2) * math.cos(phi) ** 2
    ep = e2 / (1 - e2)
    x = dl * math.cos(phi)
    east = k0 * nu * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * x**5 / 120)
    north = k0 * (arc(phi) - arc(math.radians(lat0)) + nu * math.tan(phi) * (x**2 / 2 + (5 - t + 9 * c + 4 * c * c) * x**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * x**6 / 720))
    return east0 + east, north0 + north


def test_projections(spark):
    places = [(-58.3816, -34.6037), (-58.4633, -34.6293), (-58.53, -34.70), (-57.0, -34.0)]
    df = spark.createDataFrame(places, "lon double, lat double")
    for code, known in ((32721, (-57.0, 0.9996, 500000.0, 10000000.0, 6378137.0, 298.257223563)), (9498, (-58.4633083333333, 1.0, 20000.0, 70000.0, 6378137.0, 298.257222101, -34.6292666666667))):
        x, y = crs.project(F.col("lon"), F.col("lat"), crs.PROJECTED[code])
        for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
            assert (r.x, r.y) == pytest.approx(plain_transverse_mercator(r.lon, r.lat, *known), abs=0.002)
        back = crs.unproject(x, y, crs.PROJECTED[code])
        assert [(round(r[0], 9), round(r[1], 9)) for r in df.select(*back).collect()] == places
        nested = df.select(x.alias("x"), y.alias("y"), crs.projected(F.col("lon"), F.col("lat"), crs.PROJECTED[code]).alias("m"), crs.unprojected(x, y, crs.PROJECTED[code]).alias("g"), *(c.alias(n) for c, n in zip(back, ("lon", "lat"))))
        assert all((r.x, r.y) == pytest.approx(tuple(r.m), abs=1e-6) and (r.lon, r.lat) == pytest.approx(tuple(r.g), abs=1e-12) for r in nested.collect())
    x, y = crs.project(F.lit(-57.0), F.lit(0.0))
    assert tuple(df.select(x, y).first()) == pytest.approx((500000.0, 10000000.0))


# Text and numbers --------------------------------------------------------------

def test_repair_and_number(spark):
    df = spark.createDataFrame([("NuÃ±ez", "1,5"), ("Núñez", "SD"), ("日本", " 2.5 "), (None, None), ("Ã", "#REF!"), ("", "NaN")], "s string, n string")
    assert [tuple(r) for r in df.select(repair(F.col("s")), number(F.col("n"))).collect()] == [("Nuñez", None), ("Núñez", None), ("日本", 2.5), (None, None), ("Ã", None), ("", None)]


# Configuration ------------------------------------------------------------------

def test_config():
    import copy

    good = cfg.parse(copy.deepcopy(town.CONFIG))
    assert list(good.flat_weights())[:2] == ["crossing_length", "n_branches"] and good.crossing["offset_m"] == 12.0 and good.severity_weights["MORTAL"] == 5.0 and good.warnings == []
    for change in ({"scope": {"mode": "moon"}}, {"corner_definition": "x"}, {"normalization": "zscore"}, {"angle_normal_range": [70]}, {"radii": {}}, {"axis_normalization": {"n_branches": "x"}}):
        with pytest.raises(ValueError):
            cfg.parse(copy.deepcopy(town.CONFIG) | change)
    with pytest.raises(ValueError):
        cfg.parse({k: v for k, v in town.CONFIG.items() if k != "weights"})
    assert cfg.parse(copy.deepcopy(town.CONFIG) | {"axis_normalization": {"nothing": "minmax"}}).warnings == ["unknown axis: nothing"]


# Components ---------------------------------------------------------------------

def test_components(spark):
    """A long chain in mixed order, a star, a ring and a node tied to itself."""
    import random

    draw, at = random.Random(4), list(range(300))
    draw.shuffle(at)
    edges = list(zip(at, at[1:])) + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)] + [(3000, 3000)]
    from corvane.operators.components import components

    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(300)} | {1000 + i: 1000 for i in range(50)} | {2000 + i: 2000 for i in range(7)}


# Features of several parts -----------------------------------------------------

def test_parts_of_a_feature_count_once(spark):
    """A multipolygon's two parts, and three points of one feature, near a site: one feature each."""
    from corvane.operators import proximity

    site = spark.createDataFrame([(1, 0.0, 0.0)], "key int, x double, y double")
    box = lambda x: [(x, -5.0, x + 4, -5.0), (x + 4, -5.0, x + 4, 5.0), (x + 4, 5.0, x, 5.0), (x, 5.0, x, -5.0)]
    spot = lambda x: [(x, 0.0, x, 0.0)]
    rows = [(0, box(-2.0), True), (0, box(6.0), True), (1, spot(3.0), False), (1, spot(4.0), False), (1, spot(5.0), False), (2, spot(90.0), False)]
    parts = spark.createDataFrame(rows, "ord long, shape array<struct<x1:double,y1:double,x2:double,y2:double>>, area boolean")
    assert proximity.nearby_count(site, parts, 20.0).first().n == 2
    assert proximity.nearby_count(site, parts.drop("ord"), 20.0).first().n == 5
    assert proximity.nearby_sum(site, parts, 20.0, F.lit(3.0)).first().total == 6.0


def test_formal_crossings_only_needs_a_source(spark):
    streets = spark.createDataFrame([], "seg_id long, geom_type string, lonlat array<struct<lon:double,lat:double>>, points array<struct<x:double,y:double>>, nomoficial string, tipo_c string, sentido string, bicisenda string, red_jerarq string, comuna double, com_par double, com_impar double, barrio string, barrio_par string, barrio_imp string")
    with pytest.raises(ValueError, match="formal_crossings_only"):
        network.build_corners(streets, definition="formal_crossings_only")


def test_partitions_contract_their_edges(spark, monkeypatch):
    """A city's close nodes: the same roots as a plain union-find, and at most a fifth of the pairs is left for the rounds."""
    import random

    from corvane.operators import components as comp
    from corvane.operators.proximity import close_pairs

    draw = random.Random(6)
    places = [(i, draw.uniform(0, 6000), draw.uniform(0, 6000)) for i in range(12_000)]
    pairs = close_pairs(spark.createDataFrame(places, "key long, x double, y double").repartition(8), 60.0, together=True)
    edges = [(r.u, r.v) for r in pairs.collect()]
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e}
    assert {r.node: r.root for r in comp.components(pairs).collect()} == want
    _, links = comp.contracted(pairs)
    assert len(edges) > 10_000 and links.count() * 5 <= len(edges)
    monkeypatch.setattr(comp, "HELD", 100)  # several sets of stars from one task
    assert {r.node: r.root for r in comp.components(pairs).collect()} == want


def made_crowd(spark):
    """600 sites and 600 targets, nine tenths of both in one place of 20 m within one cell of 30 m, some of them equal, and targets that are long lines."""
    draw = random.Random(4)
    spot = lambda i: (5012.0 + draw.random() * 20, 5012.0 + draw.random() * 20) if i % 10 else (draw.random() * 10000, draw.random() * 10000)
    places, ends = [(i, *((5015.0, 5015.0) if i % 5 == 1 else spot(i))) for i in range(600)], [spot(i) for i in range(600)]
    lines = [(*p, *((p[0] + draw.random() * 300, p[1] - draw.random() * 200) if i % 7 == 0 else p)) for i, p in enumerate(ends)]
    sites = spark.createDataFrame(places, "key long, x double, y double").repartition(8)
    targets = spark.createDataFrame([([q], i) for i, q in enumerate(lines)], "shape array<struct<x1:double,y1:double,x2:double,y2:double>>, n int").repartition(8)
    return places, lines, sites, targets


def near(p, q, radius):
    (x, y), (x1, y1, x2, y2) = p, q
    dx, dy = x2 - x1, y2 - y1
    t = min(1.0, max(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
    return (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2 <= radius * radius


@pytest.mark.parametrize("radius", [2.0, 30.0])
def test_crowded_cells_are_divided(spark, monkeypatch, radius):
    """The pairs are those of every site with every target, each once, whether cells are divided, dealt over shares or left whole."""
    places, lines, sites, targets = made_crowd(spark)
    want = sorted((k, i) for k, x, y in places for i, q in enumerate(lines) if near((x, y), q, radius))
    for least, depth in ((proximity.LEAST_PAIRS, 3), (2000, 3), (2000, 0)):
        monkeypatch.setattr(proximity, "LEAST_PAIRS", least)
        monkeypatch.setattr(proximity, "DEPTH", depth)
        got = proximity.within(sites, targets, radius, once=False).select("key", "n").toPandas()
        assert sorted(zip(got.key.tolist(), got.n.tolist())) == want
        assert proximity.within(sites, targets, radius).count() == len(want)


def test_crowded_cells_leave_no_task_behind(spark, monkeypatch):
    """Nine tenths of all rows in one cell: whole cells give it nearly all of what is compared, divided ones at most twice the limit, and tasks about the same."""
    _, _, sites, targets = made_crowd(spark)
    segments = targets.select(F.monotonically_increasing_id().alias("_id"), F.inline("shape"))
    s = sites.withColumns({"_cx": F.floor(F.col("x") / 30), "_cy": F.floor(F.col("y") / 30)})

    def work():
        a, b, cell = proximity.divided(s, proximity.along_cells(segments, 30.0, 30.0), 30.0, 30.0)
        cells = a.groupBy(*cell).count().join(b.groupBy(*cell).agg(F.count("*").alias("m")), cell).select(*cell, (F.col("count") * F.col("m")).alias("work")).collect()
        tasks = a.repartition(8, *cell).groupBy(*cell, F.spark_partition_id().alias("task")).count().join(b.groupBy(*cell).agg(F.count("*").alias("m")), cell).groupBy("task").agg(F.sum(F.col("count") * F.col("m")).alias("work"))
        busy = [r.work for r in tasks.collect()]
        return max(r.work for r in cells), sum(r.work for r in cells), sorted([0] * (8 - len(busy)) + busy)

    most, total, tasks = work()
    assert most > total / 3 and tasks[-1] > 3 * tasks[len(tasks) // 2]
    monkeypatch.setattr(proximity, "LEAST_PAIRS", 4000)
    most, divided, tasks = work()
    assert most <= 8000 and divided <= total and tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_empty_tables_have_no_pairs(spark):
    _, _, sites, targets = made_crowd(spark)
    assert proximity.within(sites.limit(0), targets, 30.0).count() == proximity.within(sites, targets.limit(0), 30.0).count() == 0
