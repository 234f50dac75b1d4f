"""Radius joins as equi-joins on grid cells.

A target is exploded into its segments, and a segment into the cells along it, not into those of its whole box, so
rows grow with its length. Distances are of plain columns, one segment a row. Cells in which very many sites meet very
many targets are divided into quarters, and these again, until no cell has more than a small part of all the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import geometry as g
from corvane.storage import materialise

#: Cells are divided only if one of them has more sites times targets than ``LEAST_PAIRS``: then those that have more than one part in
#: ``CELLS_A_CORE`` for each core, or in ``LEAST_CELLS``, of all cells'. More rows in the same places do not make cells smaller, so a target goes to as many.
LEAST_PAIRS, CELLS_A_CORE, LEAST_CELLS = 1 << 20, 8, 64
#: How often a cell is halved each way. At an eighth of the radius nearly all that is compared is in reach, so smaller cells only
#: send targets to more of them; what is crowded even then, such as equal places, is dealt over shares.
DEPTH = 3
#: Into how many parts each way a cell of points is cut before it is taken as crowded.
MOST_PARTS = 4
#: Parts of a cell each way, each with a street that all rows in the cell are held against first.
PARTS = 7


def along_cells(segments: DataFrame, radius: float, size: float) -> DataFrame:
    """Rows with x1, y1, x2, y2, once for each cell (_cx, _cy) of so many metres that comes within ``radius`` of the segment's part above or beside it."""
    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    rows = segments.withColumn("_cx", F.explode(F.sequence(F.floor((west - radius) / size), F.floor((east + radius) / size))))
    # The part of the segment from which a point of the column of cells can be in reach.
    low = F.greatest(west, F.least(F.col("_cx") * size - radius, east))
    high = F.least(east, F.greatest((F.col("_cx") + 1) * size + radius, west))
    slope = F.when(F.col("x2") != F.col("x1"), (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")))
    at = lambda x, other: F.when(slope.isNull(), F.col(other)).otherwise(F.col("y1") + (x - F.col("x1")) * slope)
    a, b, slack = at(low, "y1"), at(high, "y2"), radius + 1e-6 * size
    return rows.withColumn("_cy", F.explode(F.sequence(F.floor((F.least(a, b) - slack) / size), F.floor((F.greatest(a, b) + slack) / size))))


def within(sites: DataFrame, targets: DataFrame, radius: float, once: bool = True) -> DataFrame:
    """Pairs of a site (key, x, y) and a target (shape, maybe ``area``, and more) at most ``radius`` apart, each once.

    A site lies in one cell, so a pair comes once for each of the target's segments in reach; of these one stays, or all where not
    ``once``, which spares a shuffle if it does not matter. Targets of one segment, unless they are parts of others, need none. Rows with ``area`` also have the sites inside them.
    Rows with the same ``ord``, if there is such a column, are parts of one target.
    """
    more = [c for c in targets.columns if c not in ("shape", "area")]
    if "area" in targets.columns:
        inside = within_areas(sites, targets.filter("area"), radius).select("key", *more)
        found = within(sites, targets.filter(~F.coalesce("area", F.lit(False))).drop("area"), radius, once).unionAll(inside)
        return found.dropDuplicates(["key", "ord"]) if once and "ord" in more else found
    if once and "ord" not in more:
        one = F.size("shape") <= 1
        several = targets.filter(~one)
        if several.isEmpty():
            return within(sites, targets, radius, False)
        return within(sites, targets.filter(one), radius, False).unionAll(_once(sites, several, radius, True))
    return _once(sites, targets, radius, once)


def _once(sites: DataFrame, targets: DataFrame, radius: float, once: bool) -> DataFrame:
    """``within`` for targets that are no areas."""
    if not once and (pairs := _points_within(sites, targets, radius)) is not None:
        return pairs
    size, more = _size(radius), [c for c in targets.columns if c != "shape"]
    numbered = targets.withColumn("_id", F.col("ord") if "ord" in more else F.monotonically_increasing_id())
    segments = numbered.select("_id", *more, F.inline("shape"))
    s = _placed(sites, size)
    dx, dy, ex, ey = (F.col(a) - F.col(b) for a, b in (("x2", "x1"), ("y2", "y1"), ("x", "x1"), ("y", "y1")))
    long = dx * dx + dy * dy
    t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (ex * dx + ey * dy) / long))).otherwise(0.0)
    gx, gy = ex - t * dx, ey - t * dy
    s, t_rows, cell = divided(s, along_cells(segments, float(radius), size), float(radius), size)
    met = dealt(s, *cell).join(dealt(t_rows, *cell), cell).filter(gx * gx + gy * gy <= radius * radius)
    if not once:
        return met.select("key", *more)
    found = F.struct(*more) if more else F.lit(True)
    return met.groupBy("key", "_id").agg(F.first(found).alias("_t")).select("key", *(F.col(f"_t.{c}").alias(c) for c in more))


def _points_within(sites: DataFrame, targets: DataFrame, radius: float) -> DataFrame | None:
    """``within`` for targets that are all single points; None if others are among them, or a cell would be too much for one task.

    A site goes to all columns of cells in reach of it and stays in its row, a point goes to all rows and stays in its column, so they
    meet once, in the point's column and the site's row. Copies grow with the cells in a radius, not with their square.
    """
    more, q = [c for c in targets.columns if c != "shape"], F.col("shape")[0]
    single = (F.size("shape") == 1) & (q["x1"] == q["x2"]) & (q["y1"] == q["y2"])
    if not targets.filter((F.size("shape") > 0) & ~F.coalesce(single, F.lit(False))).isEmpty():
        return None
    points, cell = targets.filter(F.size("shape") > 0).select(*more, q["x1"].alias("_px"), q["y1"].alias("_py")), ["_cx", "_cy"]
    for parts in range(1, MOST_PARTS + 1):
        side = _size(radius) / parts
        at = lambda c: F.floor(F.col(c) / side)  # noqa: B023, E731
        over = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius) / side - 1e-6), F.floor((F.col(c) + radius) / side + 1e-6)))  # noqa: B023, E731
        s = sites.select("key", "x", "y", at("y").alias("_cy"), over("x").alias("_cx"))
        t = points.select(*more, "_px", "_py", at("_px").alias("_cx"), over("_py").alias("_cy"))
        count = lambda rows, name: rows.groupBy(*cell).agg(F.count("*").cast("double").alias(name))
        most, total = count(s, "_n").join(count(t, "_m"), cell).select((F.col("_n") * F.col("_m")).alias("_work")).agg(F.max("_work"), F.sum("_work")).first()
        if (most or 0) <= max(LEAST_PAIRS, (total or 0) / (2 * sites.sparkSession.sparkContext.defaultParallelism)):
            dx, dy = F.col("x") - F.col("_px"), F.col("y") - F.col("_py")
            return dealt(s, *cell).join(dealt(t, *cell), cell).filter(dx * dx + dy * dy <= radius * radius).select("key", *more)
    return None


def divided(sites: DataFrame, segments: DataFrame, radius: float, size: float) -> tuple[DataFrame, DataFrame, list[str]]:
    """Sites (key, x, y) and segments (_id, x1, y1, x2, y2), both with cells, on a quadtree fitted to them, and the columns to join by.

    One small job counts what each cell would compare; tables without a crowded cell stay as they are. A crowded cell's sites go to
    the quarter that they lie in, its segments to all quarters in reach, so a pair still meets once. Quarters compare no more than
    their cell did, so a level has fewer crowded cells than the parts that ``CELLS_A_CORE`` asks for, and only these come to the driver and are broadcast.
    """
    cell = ["_level", "_cx", "_cy"]
    s, t = sites.withColumn("_level", F.lit(0)), segments.withColumn("_level", F.lit(0))
    limit = None
    for level in range(DEPTH + 1):
        count = lambda rows, name: rows.filter(F.col("_level") == level).groupBy(*cell).agg(F.count("*").cast("double").alias(name))  # noqa: B023, E731
        work = count(s, "_n").join(count(t, "_m"), cell).withColumn("_work", F.col("_n") * F.col("_m"))
        if limit is None:
            most, total = work.agg(F.max("_work"), F.sum("_work")).first()
            if (most or 0) <= LEAST_PAIRS:
                return sites, segments, ["_cx", "_cy"]
            limit = total / max(LEAST_CELLS, CELLS_A_CORE * sites.sparkSession.sparkContext.defaultParallelism)
        crowded = work.filter(F.col("_work") > limit).select(*cell, F.ceil(F.col("_work") / limit).cast("int").alias("_shares"), (F.col("_n") >= F.col("_m")).alias("_deal_sites")).collect()
        if not crowded:
            break
        table = F.broadcast(sites.sparkSession.createDataFrame(crowded, "_level int, _cx long, _cy long, _shares int, _deal_sites boolean"))
        s, t = s.join(table, cell, "left"), t.join(table, cell, "left")
        if level == DEPTH:
            every, none = F.sequence(F.lit(0), F.col("_shares") - 1), F.array(F.lit(0))
            one = lambda *by: F.array(F.pmod(F.xxhash64(*by), F.col("_shares")).cast("int"))
            deal = lambda dealt, *by: F.explode(F.when(F.col("_shares").isNull(), none).when(dealt, one(*by)).otherwise(every))
            s = s.withColumn("_share", deal(F.col("_deal_sites"), "key", "x", "y"))
            t = t.withColumn("_share", deal(~F.col("_deal_sites"), "_id", "x1", "y1", "x2", "y2"))
            return s.drop("_shares", "_deal_sites"), t.drop("_shares", "_deal_sites"), [*cell, "_share"]
        side, hot = size / 2 ** (level + 1), F.col("_shares").isNotNull()
        down = lambda c, at: F.when(hot, at).otherwise(F.col(c))  # noqa: B023, E731
        s = s.withColumns({"_level": down("_level", F.lit(level + 1)), "_cx": down("_cx", F.floor(F.col("x") / side)), "_cy": down("_cy", F.floor(F.col("y") / side))}).drop("_shares", "_deal_sites")
        place = lambda lev, x, y: F.struct(lev.alias("_level"), x.alias("_cx"), y.alias("_cy"))
        quarters = F.array(*(place(F.lit(level + 1), F.col("_cx") * 2 + i, F.col("_cy") * 2 + j) for i in (0, 1) for j in (0, 1)))
        whole, far = F.struct("x1", "y1", "x2", "y2"), radius + side * 0.7071068 + 1e-6 * size
        in_reach = lambda q: g.segment_distance2((q["_cx"] + 0.5) * side, (q["_cy"] + 0.5) * side, whole) <= far * far  # noqa: B023, E731
        at = F.when(hot, F.filter(quarters, in_reach)).otherwise(F.array(place(*(F.col(c) for c in cell))))
        t = t.withColumn("_at", F.explode(at)).drop(*cell, "_shares", "_deal_sites").select("*", "_at.*").drop("_at")
    return s, t, cell


def _size(radius: float) -> float:
    return float(radius) if radius > 0 else 1.0


def _placed(sites: DataFrame, size: float) -> DataFrame:
    return sites.select("key", "x", "y", F.floor(F.col("x") / size).alias("_cx"), F.floor(F.col("y") / size).alias("_cy"))


def near_boxes(sites: DataFrame, targets: DataFrame, radius: float) -> DataFrame:
    """Pairs of a site and an area (shape, and more) whose box meets the square of ``radius`` around the site, with all of the area's columns and the site's place."""
    size = _size(radius)
    s = _placed(sites, size)
    cells = lambda low, high: F.explode(F.sequence(F.floor((low - radius) / size), F.floor((high + radius) / size)))
    low = lambda a, b: F.least(F.array_min(F.transform("shape", lambda q: q[a])), F.array_min(F.transform("shape", lambda q: q[b])))
    high = lambda a, b: F.greatest(F.array_max(F.transform("shape", lambda q: q[a])), F.array_max(F.transform("shape", lambda q: q[b])))
    boxed = targets.withColumns({"_x0": low("x1", "x2"), "_x1": high("x1", "x2"), "_y0": low("y1", "y2"), "_y1": high("y1", "y2")})
    t = boxed.withColumn("_cx", cells(F.col("_x0"), F.col("_x1"))).withColumn("_cy", cells(F.col("_y0"), F.col("_y1")))
    x, y = F.col("x"), F.col("y")
    met = s.join(t, ["_cx", "_cy"]).filter((x >= F.col("_x0") - radius) & (x <= F.col("_x1") + radius) & (y >= F.col("_y0") - radius) & (y <= F.col("_y1") + radius))
    return met.select("key", "x", "y", *targets.columns)


def within_areas(sites: DataFrame, targets: DataFrame, radius: float) -> DataFrame:
    """Pairs of a site and an area (shape, and more) that holds it or is at most ``radius`` away, with all of the area's columns."""
    near = near_boxes(sites, targets, radius)
    return near.filter(g.distance2(F.col("x"), F.col("y"), F.col("shape"), F.lit(True)) <= radius * radius).select("key", *targets.columns)


def measure(sites: DataFrame, targets: DataFrame, radius: float, once: bool = True, **found: Column) -> DataFrame:
    """Every site with aggregates over the targets in reach, from one join; null where there are none."""
    by = within(sites, targets, radius, once).groupBy("key").agg(*(c.alias(name) for name, c in found.items()))
    return sites.select("key").join(by, "key", "left")


def _shapes(targets: DataFrame) -> DataFrame:
    return targets.select("shape", *(c for c in ("area", "ord") if c in targets.columns))


def nearby_bool(sites: DataFrame, targets: DataFrame, radius: float, name: str = "near") -> DataFrame:
    """Whether any target is in reach."""
    return measure(sites, _shapes(targets), radius, False, **{name: F.count("*") > 0}).select("key", F.coalesce(name, F.lit(False)).alias(name))


def nearby_count(sites: DataFrame, targets: DataFrame, radius: float, name: str = "n", once: bool = True) -> DataFrame:
    return measure(sites, _shapes(targets), radius, once, **{name: F.count("*")}).select("key", F.coalesce(name, F.lit(0)).alias(name))


def nearby_sum(sites: DataFrame, targets: DataFrame, radius: float, weight: Column, name: str = "total", once: bool = True) -> DataFrame:
    """Sums of weights in reach; null weights count as 0. A weight is worked out once a target, not once a pair."""
    weighed = targets.select(*_shapes(targets).columns, F.coalesce(weight, F.lit(0.0)).alias("_weight"))
    return measure(sites, weighed, radius, once, **{name: F.sum("_weight")}).select("key", F.coalesce(name, F.lit(0.0)).alias(name))


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of a cell in one task, in as many tasks as keep all cores busy: few bytes may be much to compare, so their number is fixed."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), *by)


def close_pairs(points: DataFrame, threshold: float, together: bool = False, carry: tuple[str, ...] = (), first: Column | None = None) -> DataFrame:
    """Pairs (u, v), u < v, of points (key, x, y) at most ``threshold`` apart, and the columns ``carry`` of both, named with u and v in front.

    A point meets those of its own cell and of four of the eight around it, so two points meet once. What is carried goes with the
    points, which are few, and is not joined to the pairs. ``together`` deals pairs of one neighbourhood, tiles of 64 cells each way, to one task.
    Where ``first`` is said of points, only pairs whose u it holds for are made: such points meet those of all cells around them, others are not compared.
    """
    if first is not None:
        return _pairs_of(points, threshold, carry, first)
    size, names = float(threshold) if threshold > 0 else 1.0, ["key", *dict.fromkeys(("x", "y", *carry))]
    placed = points.select(*names, F.floor(F.col("x") / size).alias("_cx"), F.floor(F.col("y") / size).alias("_cy"))
    a = placed.select(*(F.col(c).alias(f"_a_{c}") for c in names), "_cx", "_cy")
    ways = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))))
    b = placed.select(*(F.col(c).alias(f"_b_{c}") for c in names), "_cx", "_cy", F.explode(ways).alias("_w"))
    b = b.withColumns({"_cx": F.col("_cx") + F.col("_w.i"), "_cy": F.col("_cy") + F.col("_w.j"), "_own": (F.col("_w.i") == 0) & (F.col("_w.j") == 0)}).drop("_w")
    dx, dy = F.col("_a_x") - F.col("_b_x"), F.col("_a_y") - F.col("_b_y")
    first = F.col("_a_key") < F.col("_b_key")
    once = first | (~F.col("_own") & (F.col("_a_key") != F.col("_b_key")))
    pairs = dealt(a, "_cx", "_cy").join(dealt(b, "_cx", "_cy"), ["_cx", "_cy"]).filter(once & (dx * dx + dy * dy <= threshold * threshold))
    low, high = (lambda c: F.when(first, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}"))), (lambda c: F.when(first, F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")))
    found = [low("key").alias("u"), high("key").alias("v"), *(low(c).alias(f"u{c}") for c in carry), *(high(c).alias(f"v{c}") for c in carry)]
    if not together:
        return pairs.select(*found)
    return pairs.select(*found, F.shiftright("_cx", 6).alias("_tx"), F.shiftright("_cy", 6).alias("_ty")).repartition("_tx", "_ty").drop("_tx", "_ty")


def _pairs_of(points: DataFrame, threshold: float, carry: tuple[str, ...], first: Column) -> DataFrame:
    """``close_pairs`` whose u are some of the points."""
    size, names = float(threshold) if threshold > 0 else 1.0, ["key", *dict.fromkeys(("x", "y", *carry))]
    cell, at = ["_cx", "_cy"], lambda c: F.floor(F.col(c) / size)
    around = lambda c: F.explode(F.sequence(at(c) - 1, at(c) + 1))
    u = points.filter(first).select(*(F.col(c).alias(f"u{c}") for c in names)).withColumn("_cx", around("ux")).withColumn("_cy", around("uy"))
    v = points.select(*(F.col(c).alias(f"v{c}") for c in names), at("x").alias("_cx"), at("y").alias("_cy"))
    dx, dy = F.col("ux") - F.col("vx"), F.col("uy") - F.col("vy")
    met = dealt(u, *cell).join(dealt(v, *cell), cell).filter((F.col("ukey") < F.col("vkey")) & (dx * dx + dy * dy <= threshold * threshold))
    return met.select(F.col("ukey").alias("u"), F.col("vkey").alias("v"), *(f"u{c}" for c in carry), *(f"v{c}" for c in carry))


def crossing(segments: DataFrame, others: DataFrame, size: float) -> DataFrame:
    """``key`` of the segments (key, x1, y1, x2, y2) that meet any of the others; both are exploded into the cells along them."""
    b = along_cells(others.select("x1", "y1", "x2", "y2").distinct(), 0.0, size).toDF("bx1", "by1", "bx2", "by2", "_cx", "_cy")
    side = lambda px, py, ax, ay, bx, by: (F.col(bx) - F.col(ax)) * (F.col(py) - F.col(ay)) - (F.col(by) - F.col(ay)) * (F.col(px) - F.col(ax))
    p, q = ("x1", "y1", "x2", "y2"), ("bx1", "by1", "bx2", "by2")
    apart = lambda a, b: side(*a[:2], *b) * side(*a[2:], *b) <= 0
    met = along_cells(segments, 0.0, size).join(b, ["_cx", "_cy"]).filter(apart(p, q) & apart(q, p))
    return met.select("key").distinct()


def near_any(layer: DataFrame, streets: DataFrame, radius: float) -> DataFrame:
    """Rows of a layer (shape, and more) with a segment that meets, or is at most ``radius`` from, any segment of streets (shape).

    Where streets are crowded nearly every row is near one of a few of them. So streets are first reduced, where they lie, to one for each
    place, a part of a cell that their middle is in; and of these, each cell gets one for each of its parts. Rows are held against those of the
    cell that the middle of their first segment is in. Only rows that this does not settle, and only streets of places in reach of such rows, are dealt by cells.
    """
    size, radius = max(float(radius), 25.0), float(radius)
    ends, cell, place, side = ("x1", "y1", "x2", "y2"), ["_cx", "_cy"], ["_hx", "_hy"], size / PARTS
    middle = lambda a, b, of: F.floor((F.col(a) + F.col(b)) / 2 / of)
    lines = streets.select(F.inline("shape")).dropna().select(*ends, middle("x1", "x2", side).alias("_hx"), middle("y1", "y2", side).alias("_hy"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    places = materialise(lines.groupBy(*place).agg(*(F.first(c).alias(c) for c in ends), F.count("*").alias("_n"), F.max(dx * dx + dy * dy).alias("_long")))
    # Cells that any street of a place may come to.
    far = F.sqrt("_long") / 2 + radius + 1e-6 * size
    over = lambda c: F.explode(F.sequence(F.floor((F.col(c) * side - far) / size), F.floor(((F.col(c) + 1) * side + far) / size)))
    reached = lambda rows: rows.withColumn("_cx", over("_hx")).withColumn("_cy", over("_hy"))
    celled = along_cells(places.select(*ends), radius, size)
    pivots = materialise(celled.groupBy(*cell, _part(size).alias("_b")).agg(*(F.first(c).alias(f"b{c}") for c in ends), F.count("*").alias("_n")))
    crowded = pivots.filter("_n > 1").select(*cell).unionAll(reached(places.filter("_n > 1").select(*place, "_long")).select(*cell))
    crowded = materialise(crowded.distinct().withColumnsRenamed({"_cx": "_px", "_cy": "_py"}))
    pivots = pivots.select(F.col("_cx").alias("_px"), F.col("_cy").alias("_py"), *_sides([f"b{c}" for c in ends], "b"))
    first = layer.filter(F.size("shape") > 0).withColumn("_q", F.col("shape")[0])
    first = first.withColumns({f"_{c}": F.col(f"_q.{c}") for c in ends})
    first = first.select("*", *_sides([f"_{c}" for c in ends], "a"), middle("_x1", "_x2", size).alias("_cx"), middle("_y1", "_y2", size).alias("_cy"))
    here, few = (F.col("_cx") == F.col("_px")) & (F.col("_cy") == F.col("_py")), broadcast_few(pivots)
    settled = first.join(few, here & _surely(radius), "left_semi").select(*layer.columns)
    # A row in one cell whose pivots are all of its streets is settled too, but for being at the radius: pivots are asked again then.
    single = (F.size("shape") == 1) & (F.col("_x1") == F.col("_x2")) & (F.col("_y1") == F.col("_y2"))
    unsettled = first.join(few, here & _surely(radius), "left_anti").join(broadcast_few(crowded), here, "left")
    unsettled = materialise(unsettled.withColumn("_alone", single & F.col("_px").isNull()).select(*layer.columns, "_alone", F.monotonically_increasing_id().alias("_row")))
    # Rows keep their length, streets come to all cells in reach of them.
    parts = along_cells(unsettled.select("_row", "_alone", F.inline("shape")), 0.0, size)
    asked = materialise(parts.filter("not _alone").select(*cell).distinct())
    near = lambda rows: rows.select(*_sides(ends, "b"), F.col("_cx").alias("_px"), F.col("_cy").alias("_py"))
    open_ = materialise(reached(places.select(*place, "_long")).join(broadcast_few(asked), cell, "left_semi").select(*place).distinct())
    there = along_cells(lines.join(broadcast_few(open_), place, "left_semi").select(*ends), radius, size).join(broadcast_few(asked), cell, "left_semi")
    rows = lambda alone: parts.filter("_alone" if alone else "not _alone").select("_row", *_sides(ends, "a"), *cell)
    found = dealt(rows(False), *cell).join(near(dealt(there, *cell)), here & _close(radius), "left_semi").select("_row")
    found = found.unionAll(rows(True).join(few, here & _close(radius), "left_semi").select("_row")).distinct()
    return settled.unionAll(unsettled.join(found, "_row", "left_semi").select(*layer.columns))


def _sides(ends: list[str] | tuple[str, ...], name: str) -> list[Column]:
    """A segment's ends, as ``name`` with 1 to 4, and its squared length, with 0. They are never null, so that what compares them is short enough to be compiled; what is missing is near nothing."""
    x1, y1, x2, y2 = at = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in ends]
    return [((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)).alias(f"{name}0"), *(c.alias(f"{name}{i}") for i, c in enumerate(at, 1))]


def _part(size: float) -> Column:
    """The part of a cell (_cx, _cy) of so many metres that a segment's point nearest to the cell's middle is in, or is beside: streets of all parts are spread over the cell, whatever order they come in."""
    x, y, dx, dy = (F.col("_cx") + 0.5) * size, (F.col("_cy") + 0.5) * size, F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    long = dx * dx + dy * dy
    t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / long))).otherwise(0.0)
    place = lambda at, c: F.greatest(F.lit(0), F.least(F.lit(PARTS - 1), F.floor((at / size - F.col(c)) * PARTS)))
    return place(F.col("x1") + t * dx, "_cx") * PARTS + place(F.col("y1") + t * dy, "_cy")


def broadcast_few(rows: DataFrame, most: int = 1 << 17) -> DataFrame:
    """Stored rows, sent to all executors if they are so few."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _turn(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """On which side of a line from (x1, y1) to (x2, y2) a point is, as twice the area between them."""
    return (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)


def _between(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column, long: Column, square: float) -> Column:
    """Whether a point's foot lies within a segment of squared length ``long``, and the squared distance is at most ``square``."""
    at, turn = (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1), _turn(x, y, x1, y1, x2, y2)
    return (at > 0) & (at < long) & (turn * turn <= F.lit(square) * long)


def _close(radius: float) -> Column:
    """Whether segments a1 to a4 and b1 to b4 (``_sides``) meet or are at most ``radius`` apart: they cross, or an end of one is near an end of, or beside, the other."""
    a, b, square = [F.col(f"a{i}") for i in range(1, 5)], [F.col(f"b{i}") for i in range(1, 5)], radius * radius
    # Their boxes, by the middles, with room for rounding; another one for y would make this too long to be compiled.
    boxes = lambda i: F.abs(a[i] + a[i + 2] - b[i] - b[i + 2]) - F.abs(a[i] - a[i + 2]) - F.abs(b[i] - b[i + 2]) <= 2 * radius + 1e-6
    apart = lambda p, q: _turn(*p[:2], *q) * _turn(*p[2:], *q) < 0
    ends = [(p, q) for p in (a[:2], a[2:]) for q in (b[:2], b[2:])]
    tips = [(p[0] - q[0]) * (p[0] - q[0]) + (p[1] - q[1]) * (p[1] - q[1]) <= square for p, q in ends]
    beside = [_between(*p, *q, F.col(long), square) for p, q, long in ((a[:2], b, "b0"), (a[2:], b, "b0"), (b[:2], a, "a0"), (b[2:], a, "a0"))]
    any_ = (apart(a, b) & apart(b, a)) | tips[0]
    for c in (*tips[1:], *beside):
        any_ = any_ | c
    return boxes(0) & any_


def _surely(radius: float) -> Column:
    """A short test that holds only for segments that are ``_close``: they cross, or the middle of a is surely near b."""
    a, b, square = [F.col(f"a{i}") for i in range(1, 5)], [F.col(f"b{i}") for i in range(1, 5)], radius * radius * (1 - 1e-9)
    x, y = (a[0] + a[2]) / 2, (a[1] + a[3]) / 2
    tips = [(x - q[0]) * (x - q[0]) + (y - q[1]) * (y - q[1]) <= square for q in (b[:2], b[2:])]
    apart = lambda p, q: _turn(*p[:2], *q) * _turn(*p[2:], *q) < 0
    return (apart(a, b) & apart(b, a)) | tips[0] | tips[1] | _between(x, y, *b, F.col("b0"), square)


def intersects_box(shape: Column, box: tuple[float, float, float, float], area: Column | None = None) -> Column:
    """Whether a path touches (west, south, east, north): an end within it, or a segment through it; or an area holds the box."""
    w, s, e, n = map(float, box)

    def touches(q: Column) -> Column:
        dx, dy = q["x2"] - q["x1"], q["y2"] - q["y1"]
        # the part of the segment between both sides of an axis, as a range of its parameter
        cut = lambda at, d, low, high: (F.when(d == 0, F.when((at >= low) & (at <= high), 0.0).otherwise(2.0)).otherwise(F.least((low - at) / d, (high - at) / d)), F.when(d == 0, 1.0).otherwise(F.greatest((low - at) / d, (high - at) / d)))
        (x0, x1), (y0, y1) = cut(q["x1"], dx, w, e), cut(q["y1"], dy, s, n)
        return F.greatest(x0, y0, F.lit(0.0)) <= F.least(x1, y1, F.lit(1.0))

    edge = F.exists(shape, touches)
    return edge if area is None else edge | (area & g.inside(F.lit(w), F.lit(s), shape))
