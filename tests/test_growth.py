"""What is shuffled grows with the rows, not with their pairs, where many rows share a place."""

import contextlib
import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import geometry as g
from corvane.operators import proximity, transects
from corvane.plans import catalog
from corvane.sources import layers
from tests._sql import SMALL


def written(spark, run) -> int:
    """Bytes of shuffles written by ``run``."""
    context = spark.sparkContext._jsc.sc()

    def total() -> int:
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().executorList(False)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    before = total()
    run()
    return total() - before


@contextlib.contextmanager
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_roads_need_one_join(spark):
    """The places of both ends come with the pair."""
    plan = catalog.roads(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_pairs_carry_both_points(spark):
    pick = random.Random(3)
    places = [(k, pick.choice((pick.uniform(-50, 50), pick.randint(-3, 3) * 10.0)), pick.uniform(-50, 50), f"n{k}") for k in pick.sample(range(1000), 150)]
    got = proximity.close_pairs(spark.createDataFrame(places, "key long, x double, y double, name string"), 10.0, carry=("name", "y")).collect()
    want = {(a[0], b[0], a[3], a[2], b[3], b[2]) for a in places for b in places if a[0] < b[0] and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 100}
    assert len(got) == len(want) and {(x.u, x.v, x.uname, x.uy, x.vname, x.vy) for x in got} == want


def test_widths_among_many_sidewalks(spark):
    """Four times as many corners and sidewalks in the same place: the pairs are sixteen times as many."""

    def run(n: int) -> int:
        pick = random.Random(n)
        corners = spark.createDataFrame([(k, 0, pick.uniform(0, 90), pick.uniform(0, 90), pick.uniform(0, 360)) for k in range(n)], "key long, branch int, x double, y double, bearing_deg double")
        at = spark.createDataFrame([(pick.uniform(0, 90), pick.uniform(0, 90), pick.uniform(0.5, 2)) for _ in range(n)], "x double, y double, h double")
        corner = lambda i, j: F.struct((F.col("x") + i * F.col("h")).alias("x"), (F.col("y") + j * F.col("h")).alias("y"))
        walks = at.select(g.path(F.array(*(corner(i, j) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))))).alias("shape"))
        return written(spark, lambda: transects.roadway_widths(corners, walks).agg(F.sum("width")).collect())

    with no_broadcasts(spark):
        assert run(1600) < 8 * run(400)


@pytest.mark.parametrize("radius", [0.5, 12.0])
def test_crop_near_among_many_streets(spark, radius):
    """Rows of one and of several segments, points and an area, among crowded and single streets, against plain distances; and streets are not shuffled for each of their cells."""
    pick = random.Random(11)
    line = lambda x, y, r: (x, y, x + pick.uniform(-r, r), y + pick.uniform(-r, r))
    streets = [line(pick.uniform(0, 20), pick.uniform(0, 20), 8) for _ in range(3000)] + [line(pick.uniform(-200, 200), pick.uniform(-200, 200), 40) for _ in range(12)]
    rows = [(k, [line(pick.uniform(-200, 200), pick.uniform(-200, 200), 30)]) for k in range(150)]
    rows += [(200 + k, [(x := pick.uniform(-40, 60), y := pick.uniform(-40, 60), x, y)]) for k in range(150)]
    rows += [(400 + k, [line(pick.uniform(-200, 200), pick.uniform(-200, 200), 20) for _ in range(3)]) for k in range(60)]

    def far(p, s):
        (px, py), (a, b, c, d) = p, s
        dx, dy = c - a, d - b
        t = max(0.0, min(1.0, ((px - a) * dx + (py - b) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return (px - a - t * dx) ** 2 + (py - b - t * dy) ** 2

    def meets(p, q):
        turn = lambda x, y, s: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
        cross = p[:2] != p[2:] and turn(*p[:2], q) * turn(*p[2:], q) < 0 and turn(*q[:2], p) * turn(*q[2:], p) < 0
        return cross or min(far(p[:2], q), far(p[2:], q), far(q[:2], p), far(q[2:], p)) <= radius**2

    kind = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
    layer = spark.createDataFrame([(k, s) for k, s in [*rows, rows[0]]], f"key long, shape {kind}").withColumn("area", F.lit(False))
    about = spark.createDataFrame([([s],) for s in streets], f"shape {kind}")
    with no_broadcasts(spark):
        got = []
        bytes_ = written(spark, lambda: got.extend(x.key for x in layers.crop_near(layer, about, radius).select("key").collect()))
    want = [k for k, shape in [*rows, rows[0]] if any(meets(p, q) for p in shape for q in streets)]
    assert sorted(got) == sorted(want)
    assert radius < 1 or bytes_ < 1_000_000


def test_crop_near_keeps_an_area_around_a_street(spark):
    kind = "key long, area boolean, shape array<struct<x1:double,y1:double,x2:double,y2:double>>"
    ring = [(0.0, 0.0, 100.0, 0.0), (100.0, 0.0, 100.0, 100.0), (100.0, 100.0, 0.0, 100.0), (0.0, 100.0, 0.0, 0.0)]
    layer = spark.createDataFrame([(1, True, ring), (2, False, ring), (3, None, ring), (4, False, None)], kind)
    about = spark.createDataFrame([([(50.0, 50.0, 52.0, 50.0)],)], kind.split(", ")[2])
    assert [x.key for x in layers.crop_near(layer, about, 5.0).collect()] == [1]


def test_counts_near_roads_shuffle_no_pairs(spark):
    """Targets of one segment meet a site once; those of several still count once."""
    pick = random.Random(5)
    kind = "shape array<struct<x1:double,y1:double,x2:double,y2:double>>"
    line = lambda: (pick.uniform(0, 60), pick.uniform(0, 60), pick.uniform(0, 60), pick.uniform(0, 60))
    sites = spark.createDataFrame([(k, pick.uniform(0, 60), pick.uniform(0, 60)) for k in range(50)], "key long, x double, y double")
    ones, bent = [([line()],) for _ in range(200)], [([line(), line()],) for _ in range(20)]
    plan = proximity.within(sites, spark.createDataFrame(ones, kind), 9.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
    got = {x.key: x.n for x in proximity.nearby_count(sites, spark.createDataFrame(ones + bent, kind), 9.0).collect()}
    each = [proximity.nearby_count(sites, spark.createDataFrame(part, kind), 9.0).collect() for part in (ones, bent)]
    assert got == {k: sum(next(x.n for x in part if x.key == k) for part in each) for k in range(50)}
    assert max(x.n for x in each[1]) <= 20


def test_first_bearings_are_reduced_without_a_sort(spark):
    rows = spark.createDataFrame([(k % 7, f"S{k % 3}", k * 37.3 % 360, (k * 61) % 1009) for k in range(1000)], "node long, nomoficial string, bearing_deg double, far long")
    from corvane.operators import network

    found = network.first_bearings(rows, "node", 30.0, F.col("far"))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    plain = network.dedupe_branches(rows, "node", 30.0, F.col("far"), F.struct("nomoficial", "bearing_deg")).select("node", "branch.nomoficial", "branch.bearing_deg", "first")
    assert sorted(found.select("node", "nomoficial", "bearing_deg", "first").collect()) == sorted(plain.collect())
    assert "SortAggregate" not in catalog.branch_dedupe(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_outline_compares_along_the_border_only(spark):
    """Four times as many streets in one place have about the same border; what is cut and compared for it grows no faster than they do."""
    from corvane.operators import outline

    def run(n: int) -> int:
        pick = random.Random(n)
        line = lambda x, y: (x, y, x + pick.uniform(-8, 8), y + pick.uniform(-8, 8))
        lines = outline._lines(spark.createDataFrame([line(pick.uniform(0, 60), pick.uniform(0, 60)) for _ in range(n)], "x1 double, y1 double, x2 double, y2 double"))
        leaves, obstacles = outline._open_cells(lines, 20.0)
        return outline._near(outline._primitives(obstacles), obstacles, leaves).count()

    few, many = run(300), run(1200)
    assert 0 < many < 6 * few and many < 1200 * 20


def test_corners_reduce_streets_where_they_lie(spark):
    """Eight times each street adds nothing to what a corner has, and next to nothing to what is shuffled."""
    from corvane.operators import network

    base = catalog._streets(spark, SMALL)

    def run(n: int) -> tuple[int, list]:
        streets = base.crossJoin(spark.range(n).withColumnRenamed("id", "_again")).withColumn("seg_id", F.col("seg_id") + F.col("_again") * 10**12)
        got = []
        wrote = written(spark, lambda: got.extend(network.build_corners(streets).select("corner_ord", "n_branches", "acute_angle_raw", "comuna", "barrio").filter("n_branches > 3").collect()))
        return wrote, sorted(map(str, got))

    with no_broadcasts(spark):
        (one, few), (eight, many) = run(1), run(8)
    assert few and few == many
    assert eight < 3 * one


def test_more_rows_in_a_place_make_no_smaller_cells(spark, monkeypatch):
    """Five times as many sites and targets in the same places: a target still goes to about as many cells, so what is shuffled grows with the rows."""
    monkeypatch.setattr(proximity, "LEAST_PAIRS", 2000)

    def cells(n: int) -> float:
        pick = random.Random(7)
        place = lambda: [pick.gauss(0, 125), pick.gauss(0, 125)]
        sites = spark.createDataFrame([(k, *place()) for k in range(n)], "key long, x double, y double")
        targets = spark.createDataFrame([(k, *place()) for k in range(n)], "_id long, x1 double, y1 double").withColumns({"x2": F.col("x1"), "y2": F.col("y1")})
        placed = sites.withColumns({"_cx": F.floor(F.col("x") / 100), "_cy": F.floor(F.col("y") / 100)})
        return proximity.divided(placed, proximity.along_cells(targets, 100.0, 100.0), 100.0, 100.0)[1].count() / n

    few, many = cells(400), cells(2000)
    assert many < 1.5 * few


def test_points_in_reach_go_to_columns_and_rows(spark, monkeypatch):
    """Sites and points meet once, however finely cells are cut; what is shuffled for it is less than a copy of each point for all cells in reach."""
    pick = random.Random(9)
    place = lambda: (pick.choice((pick.gauss(0, 125), pick.randint(-3, 3) * 50.0)), pick.gauss(0, 125))
    places, ends = [place() for _ in range(800)], [place() for _ in range(800)]
    sites = spark.createDataFrame([(k, *p) for k, p in enumerate([*places, *places[:5]])], "key long, x double, y double")
    targets = spark.createDataFrame([(*p, k) for k, p in enumerate([*ends, *ends[:5]])], "x double, y double, n long").select(g.point(F.col("x"), F.col("y")).alias("shape"), "n")
    want = sorted((k, n) for k, p in enumerate([*places, *places[:5]]) for n, q in enumerate([*ends, *ends[:5]]) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 100.0**2)
    for least in (proximity.LEAST_PAIRS, 2000):
        monkeypatch.setattr(proximity, "LEAST_PAIRS", least)
        for most in (1, 4):
            monkeypatch.setattr(proximity, "MOST_PARTS", most)
            got = proximity.within(sites, targets, 100.0, once=False).toPandas()
            assert sorted(zip(got.key.tolist(), got.n.tolist())) == want
    with no_broadcasts(spark):
        assert written(spark, lambda: proximity.nearby_sum(sites, targets, 100.0, F.lit(1.0), once=False).agg(F.sum("total")).collect()) < 400_000


def test_corner_index_ranks_its_risk_once(spark, monkeypatch):
    from corvane.operators import scoring

    asked, plain = [], scoring.normalise_all
    monkeypatch.setattr(scoring, "normalise_all", lambda df, specs, *more: asked.extend(out for _, out, *_ in specs) or plain(df, specs, *more))
    catalog.corner_index(spark, SMALL)
    assert asked.count("indice") == asked.count("indice_comuna") == 1


def in_order(n: int, long: float) -> list:
    """Streets in one cell, from west to east."""
    pick = random.Random(n)
    line = lambda x, y: (x, y, x + pick.uniform(-long, long), y + pick.uniform(-long, long))
    return sorted(line(pick.uniform(0.5, 24.5), pick.uniform(0.5, 24.5)) for _ in range(n))


def test_crop_near_whatever_order_streets_come_in(spark):
    """Points by many streets that come in order: those they are held against first lie all over the cell, so hardly any point is left over, and hardly any street is dealt."""
    pick = random.Random(2)
    kind = "shape array<struct<x1:double,y1:double,x2:double,y2:double>>"
    layer = spark.createDataFrame([(k, [(x := pick.uniform(8, 17), y := pick.uniform(8, 17), x, y)]) for k in range(600)], f"key long, {kind}")
    streets, got = spark.createDataFrame([([s],) for s in in_order(20000, 2.0)], kind), []
    with no_broadcasts(spark):
        wrote = written(spark, lambda: got.extend(layers.crop_near(layer, streets, 12.0).select("key").collect()))
    assert len(got) == 600 and wrote < 100_000


def test_what_holds_lines_against_streets_is_compiled(spark):
    """The virtual machine compiles methods of up to 8000 bytes and goes on interpreting longer ones."""
    kind = "shape array<struct<x1:double,y1:double,x2:double,y2:double>>"
    layer = spark.createDataFrame([(k, [(float(k), 0.0, k + 9.0, 9.0)]) for k in range(50)], f"key long, {kind}")
    streets = spark.createDataFrame([([(float(k), 9.0, k + 9.0, 0.0)],) for k in range(50)], kind)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = layers.crop_near(layer, streets, 1.0)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(sizes) < 8000


def test_roads_of_a_district_are_made_alone(spark):
    """Pairs of which u is one of some points: all of them, and others are not compared; points in one place, on cells' borders and of equal keys among them."""
    pick = random.Random(6)
    places = [(k, pick.choice((pick.uniform(-50, 50), pick.randint(-5, 5) * 10.0)), pick.choice((pick.uniform(-50, 50), 10.0)), k % 5) for k in pick.sample(range(1000), 200)]
    places += [(2000, 0.0, 10.0, 3), (2001, 0.0, 10.0, 3), (2002, 0.0, 10.0, 1), (2002, 1.0, 10.0, 3)]
    df = spark.createDataFrame(places, "key long, x double, y double, comuna int")
    got = [(x.u, x.v, x.ucomuna, x.vcomuna, x.ux, x.vy) for x in proximity.close_pairs(df, 10.0, carry=("comuna", "x", "y"), first=F.col("comuna") == 3).collect()]
    want = [(a[0], b[0], a[3], b[3], a[1], b[2]) for a in places for b in places if a[0] < b[0] and a[3] == 3 and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 100]
    assert sorted(got) == sorted(want) and want
    whole = catalog.roads(spark, SMALL).filter("cu = 3")
    assert sorted(map(str, catalog.roads(spark, SMALL, 3).collect())) == sorted(map(str, whole.collect()))


def test_outline_keeps_no_segments_deep_inside(spark, monkeypatch):
    """Segments that begin far from the border are dropped where they lie, but for long ones; the outline is that of all."""
    from corvane.operators import outline

    pick, kept, plain = random.Random(8), [], outline._lines
    line = lambda: (x := pick.uniform(0, 400), y := pick.uniform(0, 400), x + pick.uniform(-8, 8), y + pick.uniform(-8, 8))
    lines = [*(line() for _ in range(4000)), (200.0, 200.0, 480.0, 200.0)]
    monkeypatch.setattr(outline, "_lines", lambda segments: kept.append(segments.count()) or plain(segments))
    border = outline.edges(outline.pieces(spark.createDataFrame(lines, "x1 double, y1 double, x2 double, y2 double"), 20.0), 20.0)
    spots = [(i, pick.uniform(-40, 520), pick.uniform(-40, 440)) for i in range(1500)]

    def far(x, y):
        best = 1e9
        for a, b, c, d in lines:
            t = max(0.0, min(1.0, ((x - a) * (c - a) + (y - b) * (d - b)) / ((c - a) ** 2 + (d - b) ** 2)))
            best = min(best, ((x - a - t * (c - a)) ** 2 + (y - b - t * (d - b)) ** 2) ** 0.5)
        return best

    got = {x.key for x in outline.inside(spark.createDataFrame(spots, "key long, x double, y double"), border, 20.0).collect()}
    assert all((i in got) == (at < 20.0) for i, x, y in spots if abs((at := far(x, y)) - 20.0) > 0.01)
    assert len(kept) == 1 and kept[0] < 3000


def test_corners_leave_no_shuffles_of_finished_steps(spark):
    """What the steps before the last one shuffled is off the disk by the time that they are stored."""
    from corvane.operators import network

    def held() -> int:
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))

    with no_broadcasts(spark):
        before, left = held(), []
        wrote = written(spark, lambda: (network.build_corners(catalog._streets(spark, SMALL)), left.append(held() - before)))
    assert wrote > 100_000 and left[0] < wrote / 4
