"""The outline of all that lies within a radius of any line of a scope.

The area is the union of a disc around each end of a segment and of a strip along each segment. Its border consists
of pieces of the discs' circles and of the strips' long sides that lie inside no other disc or strip:

1. Cells of a quadtree that one disc or strip holds are left out, by the segments' ends first. The border runs through the other cells.
2. Each circle and side that comes into one of these is cut where it meets the others there.
3. A piece stays if its middle lies in such a cell and is not nearer to any of those segments than the radius. All pieces have the area on their left.
4. Ends that are the same but for rounding become one corner; each piece is tied to the one that begins where it ends.
5. Pieces tied in a ring are found as components, and their order by doubling steps. Both are joins, so no ring is held in a task.

Defined results: equal segments count once, whichever way they run; a segment of no length is a disc; no segments, no pieces; where
rings touch in a corner they may be tied either way, which changes neither the area nor what is inside by the even-odd rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import geometry as g
from corvane.operators.components import components, label
from corvane.operators.proximity import along_cells, broadcast_few, close_pairs, dealt
from corvane.storage import materialise

#: Metres within which ends are the same corner, and by how much a piece's middle may lie inside by rounding.
SAME, SLACK = 1e-4, 1e-6
#: By how much cells are taken as wider than they are. A cell with more than ``CROWD`` rows is divided into quarters, ``DEPTH`` times at most; the largest are half the radius.
EDGE, CROWD, DEPTH = 1e-3, 16, 6


def _turned(segments: DataFrame) -> DataFrame:
    """Segments (x1, y1, x2, y2) with the smaller end first."""
    back = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    turned = segments.select(*(F.when(back, F.col(b)).otherwise(F.col(a)).cast("double").alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))))
    return turned.dropna()


def _lines(segments: DataFrame) -> DataFrame:
    """Distinct segments (sid, x1, y1, x2, y2), the smaller end first."""
    return materialise(_turned(segments).distinct().withColumn("sid", F.monotonically_increasing_id()))


def _deep(shut: DataFrame, around: int) -> DataFrame:
    """Cells (_cx, _cy) of ``shut`` that have only such cells for so many cells each way."""
    for c, other in (("_cx", "_cy"), ("_cy", "_cx")):
        near = shut.withColumn(c, F.explode(F.sequence(F.col(c) - around, F.col(c) + around)))
        shut = near.groupBy(c, other).agg(F.count("*").alias("_n")).filter(F.col("_n") == 2 * around + 1).select("_cx", "_cy")
    return shut


def _facing(rows: DataFrame) -> DataFrame:
    """Segments (a, b, c, d) with their unit vector (ux, uy), that of a point to the east, their length, and the width of a square of side 1 seen along them."""
    c = F.col
    sized = rows.withColumns({"dx": c("c") - c("a"), "dy": c("d") - c("b")}).withColumn("long", F.sqrt(c("dx") * c("dx") + c("dy") * c("dy")))
    unit = {"ux": F.when(c("long") > 0, c("dx") / c("long")).otherwise(1.0), "uy": F.when(c("long") > 0, c("dy") / c("long")).otherwise(0.0)}
    return sized.withColumns(unit).withColumn("wide", F.abs("ux") + F.abs("uy")).drop("dx", "dy")


def _held(rows: DataFrame, size: float, r: float) -> DataFrame:
    """``rows`` of a cell of a side and a segment, those alone where the strip, or the disc of a point, may come into the cell, with ``_whole``: whether the discs and the strip surely hold all of it.

    The cell counts as the box around it that runs along the segment, which for points is the cell.
    """
    c = F.col
    at = rows.withColumns({"_x": (c("_cx") + 0.5) * size - c("a"), "_y": (c("_cy") + 0.5) * size - c("b"), "_e": c("wide") * (size / 2 + EDGE)})
    at = at.withColumns({"_at": c("_x") * c("ux") + c("_y") * c("uy"), "_left": F.abs(c("_y") * c("ux") - c("_x") * c("uy"))})
    zero = F.lit(0.0)
    off = {"_near": F.greatest(zero, -c("_at") - c("_e"), c("_at") - c("_e") - c("long")), "_far": F.greatest(zero, c("_e") - c("_at"), c("_at") + c("_e") - c("long")), "_beside": F.greatest(zero, c("_left") - c("_e"))}
    at = at.withColumns(off).filter((c("_near") * c("_near") + c("_beside") * c("_beside") <= (r + EDGE) ** 2) & ((c("long") == 0) | (c("_near") == 0)))
    across = c("_left") + c("_e")
    return at.withColumn("_whole", c("_far") * c("_far") + across * across < (r - EDGE) ** 2).drop("_x", "_y", "_e", "_at", "_left", *off)


def _open_cells(segments: DataFrame, r: float) -> tuple[DataFrame, DataFrame]:
    """(_level, _cx, _cy, oid): what comes into each cell that no single segment's area holds, on a quadtree; and what these are, (oid, a, b, c, d): segments, and their ends as points.

    The border runs through such cells only. What has its circle or side there, or its area, comes into the cell, so all that can
    cut or cover the border in a cell is listed with it. Ends, which are few, rule out most cells before segments are asked. Segments no
    longer than the radius that begin deep among such cells are dropped where they lie; only the others are told apart and kept.
    """
    cell, names = ["_level", "_cx", "_cy"], dict(zip(("x1", "y1", "x2", "y2"), "abcd"))
    size, xy = r / 2, ("x1", "y1", "x2", "y2")
    # What is said of each segment is kept short, and segments are turned after most are dropped: long expressions are not compiled.
    plain = segments.select(*(F.col(c).cast("double").alias(c) for c in xy))
    ends = plain.dropna().select(F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p")).select("p.x", "p.y").distinct()
    points = materialise(ends.select((F.monotonically_increasing_id() * 2).alias("oid"), F.col("x").alias("a"), F.col("y").alias("b"), F.col("x").alias("c"), F.col("y").alias("d")))
    celled = lambda rows: along_cells(_facing(dealt(rows, "oid")).withColumnsRenamed({q: p for p, q in names.items()}), r + EDGE, size).withColumnsRenamed(names)
    far = r + EDGE + 1e-6 * size
    over = lambda c: F.explode(F.sequence(F.floor((F.col(c) - far) / size), F.floor((F.col(c) + far) / size)))
    flat = {c: F.lit(v) for c, v in (("long", 0.0), ("ux", 1.0), ("uy", 0.0), ("wide", 1.0))}
    few = _held(dealt(points, "oid").withColumn("_cx", over("a")).withColumn("_cy", over("b")).withColumns(flat), size, r)
    shut = materialise(few.filter("_whole").select("_cx", "_cy").distinct())
    # No farther than four cells come the strips of segments that are no longer than four cells less the radius and some room.
    deep, shut = broadcast_few(materialise(_deep(shut, 4))), broadcast_few(shut)
    dx, dy, most = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), max(r - 4 * EDGE, 0.0)
    at = plain.withColumns({"_cx": F.floor(F.col("x1") / size), "_cy": F.floor(F.col("y1") / size), "_short": F.coalesce(dx * dx + dy * dy <= most * most, F.lit(False))})
    deep = deep.select("_cx", "_cy", F.lit(True).alias("_short"))
    lines = _lines(at.join(deep, ["_cx", "_cy", "_short"], "left_anti").select(*xy))
    long = lines.filter("x1 <> x2 or y1 <> y2").select((F.col("sid") * 2 + 1).alias("oid"), *(F.col(p).alias(q) for p, q in names.items()))
    many = celled(long)
    apart = few.join(shut, ["_cx", "_cy"], "left_anti"), _held(many.join(shut, ["_cx", "_cy"], "left_anti"), size, r)
    found = apart[0].unionByName(apart[1]).withColumn("_level", F.lit(0))
    leaves = None
    for level in range(DEPTH + 1):
        by = Window.partitionBy(*cell)
        judged = found.withColumns({"_shut": F.max("_whole").over(by), "_n": F.count("*").over(by)}).filter("not _shut")
        judged = materialise(judged.drop("_shut", "_whole"))
        full = F.lit(level < DEPTH) & (F.col("_n") > CROWD)
        leaf = judged.filter(~full).drop("_n")
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        rest = judged.filter(full).drop("_n")
        if level == DEPTH or rest.isEmpty():
            break
        quarters = F.array(*(F.struct((F.col("_cx") * 2 + i).alias("_cx"), (F.col("_cy") * 2 + j).alias("_cy")) for i in (0, 1) for j in (0, 1)))
        divided = rest.withColumn("_q", F.explode(quarters)).drop("_cx", "_cy").select("*", "_q.*").drop("_q").withColumn("_level", F.lit(level + 1))
        found = _held(divided, size / 2 ** (level + 1), r)
    return materialise(leaves.select(*cell, "oid")), materialise(leaves.select("oid", *"abcd").distinct())


def _primitives(obstacles: DataFrame) -> DataFrame:
    """(pid, oid, round, x1, y1, x2, y2): a circle around each end, and both ways along each segment, whose right side is one of its strip."""
    point = F.col("oid") % 2 == 0
    way = F.explode(F.when(point, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("_w")
    turned = lambda a, b: F.when(F.col("_w") == 0, F.col(a)).otherwise(F.col(b))
    return materialise(obstacles.select("*", way).select((F.col("oid") * 2 + F.col("_w")).alias("pid"), "oid", point.alias("round"), turned("a", "c").alias("x1"), turned("b", "d").alias("y1"), turned("c", "a").alias("x2"), turned("d", "b").alias("y2")))


def _near(primitives: DataFrame, obstacles: DataFrame, leaves: DataFrame) -> DataFrame:
    """Primitives with each point or segment (a, b, c, d) that comes into an open cell with them."""
    cell = ["_level", "_cx", "_cy"]
    pairs = leaves.join(leaves.withColumnRenamed("oid", "sid"), cell).select("oid", "sid").distinct()
    return materialise(pairs.join(primitives, "oid").drop("oid").join(obstacles.withColumnRenamed("oid", "sid"), "sid"))


def _measures(near: DataFrame, r: float) -> DataFrame:
    """``near`` with unit vectors of the primitive (ux, uy) and the segment (vx, vy), and where a side begins (px, py), each worked out once."""
    c = F.col
    lengths = near.withColumns({"lx": c("x2") - c("x1"), "ly": c("y2") - c("y1"), "sx": c("c") - c("a"), "sy": c("d") - c("b")})
    lengths = lengths.withColumns({"long": F.sqrt(c("lx") * c("lx") + c("ly") * c("ly")), "reach": F.sqrt(c("sx") * c("sx") + c("sy") * c("sy"))})
    units = lengths.withColumns({"ux": F.try_divide("lx", "long"), "uy": F.try_divide("ly", "long"), "vx": F.try_divide("sx", "reach"), "vy": F.try_divide("sy", "reach")})
    # A side's first point lies to the right of the first end.
    return units.withColumns({"px": c("x1") + F.lit(r) * c("uy"), "py": c("y1") - F.lit(r) * c("ux")}).drop("lx", "ly", "sx", "sy", "reach")


def _cuts(near: DataFrame, r: float) -> DataFrame:
    """``near``'s primitives with ``t``, a row for each place where they may cross the border of a near segment's discs and strip: angles of a circle, metres along a side."""
    c = F.col

    def root(v: Column) -> Column:
        # Touching counts, in spite of rounding.
        return F.when(v >= -1e-6, F.sqrt(F.greatest(v, F.lit(0.0))))

    measured = materialise(_measures(near, r))
    circles, sides = measured.filter("round"), measured.filter("not round")
    of = ["pid", "round", "x1", "y1", "x2", "y2"]
    ends = F.explode(F.array(F.struct(c("a").alias("qx"), c("b").alias("qy")), F.struct(c("c").alias("qx"), c("d").alias("qy")))).alias("q")
    beside = F.explode(F.array(F.lit(r), F.lit(-r))).alias("k")
    sign = F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("sign")
    # circle and disc
    x = circles.select(*of, ends).select(*of, (c("q.qx") - c("x1")).alias("dx"), (c("q.qy") - c("y1")).alias("dy")).withColumn("d2", c("dx") * c("dx") + c("dy") * c("dy")).filter((c("d2") > 0) & (c("d2") <= 4 * r * r + 1e-6))
    x = x.select(*of, F.atan2("dy", "dx").alias("to"), F.acos(F.least(F.lit(1.0), F.sqrt("d2") / (2 * r))).alias("half"), sign).select(*of, (c("to") + c("sign") * c("half")).alias("t"))
    # circle and the line beside the segment, at k to its left
    y = circles.select(*of, "vx", "vy", beside, (c("vx") * (c("y1") - c("b")) - c("vy") * (c("x1") - c("a"))).alias("h")).withColumn("h", c("h") - c("k"))
    y = y.select(*of, "vx", "vy", "h", root(F.lit(r * r) - c("h") * c("h")).alias("w"), sign).withColumn("w", c("sign") * c("w")).select(*of, F.atan2(c("vy") * c("w") - c("vx") * c("h"), c("vx") * c("w") + c("vy") * c("h")).alias("t"))
    # side and disc
    z = sides.select(*of, "ux", "uy", "long", "px", "py", ends).select(*of, "ux", "uy", "long", (c("q.qx") - c("px")).alias("ex"), (c("q.qy") - c("py")).alias("ey"))
    z = z.select(*of, "long", (c("ux") * c("ex") + c("uy") * c("ey")).alias("at"), (c("ux") * c("ey") - c("uy") * c("ex")).alias("off"))
    z = z.select(*of, "long", "at", root(F.lit(r * r) - c("off") * c("off")).alias("w"), sign).select(*of, "long", (c("at") + c("sign") * c("w")).alias("t"))
    # side and line
    w = sides.select(*of, "vx", "vy", "long", (c("ux") * c("vy") - c("uy") * c("vx")).alias("turn"), "a", "b", "px", "py", beside).filter(F.abs("turn") > 1e-12)
    w = w.select(*of, "long", "turn", "vx", "vy", (c("a") - c("k") * c("vy") - c("px")).alias("ax"), (c("b") + c("k") * c("vx") - c("py")).alias("ay")).select(*of, "long", F.try_divide(c("ax") * c("vy") - c("ay") * c("vx"), c("turn")).alias("t"))
    angle = F.when(c("t") > math.pi, c("t") - 2 * math.pi).when(c("t") <= -math.pi, c("t") + 2 * math.pi).otherwise(c("t"))
    around = x.unionAll(y).select(*of, angle.alias("t"))
    along = z.unionAll(w).filter((c("t") > 0) & (c("t") < c("long"))).select(*of, "t")
    return around.unionAll(along)


def pieces(segments: DataFrame, radius: float) -> DataFrame:
    """(piece, round, cx, cy, t0, t1, x0, y0, xe, ye): arcs around (cx, cy) and straight pieces of the border, the area on their left."""
    r = float(radius)
    if r <= 0:
        raise ValueError("an outline needs a radius")
    leaves, obstacles = _open_cells(segments, r)
    primitives = _primitives(obstacles)
    near = _near(primitives, obstacles, leaves)
    of = ["pid", "round", "x1", "y1", "x2", "y2"]
    every = primitives.select(*of).withColumn("t", F.lit(None).cast("double"))
    cut = every.unionAll(_cuts(near, r)).groupBy(*of).agg(F.sort_array(F.collect_set("t")).alias("ts"))
    long = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    n = F.size("ts")
    around = F.when(n == 0, F.array(F.lit(-math.pi), F.lit(math.pi))).otherwise(F.concat("ts", F.array(F.col("ts")[0] + 2 * math.pi)))
    cut = cut.withColumn("b", F.when(F.col("round"), around).otherwise(F.concat(F.array(F.lit(0.0)), "ts", F.array(long))))
    spans = cut.select(*of, F.explode(F.transform(F.sequence(F.lit(0), F.size("b") - 2), lambda i: F.struct(F.col("b")[i].alias("t0"), F.col("b")[i + 1].alias("t1")))).alias("s")).select(*of, "s.t0", "s.t1")
    # Pieces shorter than a rounding error go; the ends around them are one corner.
    spans = spans.filter((F.col("t1") - F.col("t0")) * F.when(F.col("round"), r).otherwise(1.0) > SAME / 10)
    ux, uy = (F.try_divide(F.col(a) - F.col(b), long) for a, b in (("x2", "x1"), ("y2", "y1")))
    x = lambda t: F.when(F.col("round"), F.col("x1") + F.lit(r) * F.cos(t)).otherwise(F.col("x1") + F.lit(r) * uy + t * ux)
    y = lambda t: F.when(F.col("round"), F.col("y1") + F.lit(r) * F.sin(t)).otherwise(F.col("y1") - F.lit(r) * ux + t * uy)
    t0, t1 = F.col("t0"), F.col("t1")
    spans = spans.select("pid", "round", F.col("x1").alias("cx"), F.col("y1").alias("cy"), "t0", "t1", x(t0).alias("x0"), y(t0).alias("y0"), x(t1).alias("xe"), y(t1).alias("ye"), x((t0 + t1) / 2).alias("mx"), y((t0 + t1) / 2).alias("my"))
    spans = materialise(spans.withColumn("piece", F.monotonically_increasing_id()))
    dx, dy = F.col("c") - F.col("a"), F.col("d") - F.col("b")
    ex, ey, size = F.col("mx") - F.col("a"), F.col("my") - F.col("b"), dx * dx + dy * dy
    at = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (ex * dx + ey * dy) / size))).otherwise(0.0)
    deep = (ex - at * dx) ** 2 + (ey - at * dy) ** 2 < (r - SLACK) ** 2
    covered = spans.select("piece", "pid", "mx", "my").join(near.select("pid", *"abcd"), "pid").filter(deep).select("piece").distinct()
    cells = F.array(*(F.struct(F.lit(i).alias("_level"), *(F.floor(F.col(m) / (r / 2 / 2**i)).alias(n) for m, n in (("mx", "_cx"), ("my", "_cy")))) for i in range(DEPTH + 1)))
    open_ = spans.select("piece", F.explode(cells).alias("_c")).select("piece", "_c.*").join(leaves.select("_level", "_cx", "_cy").distinct(), ["_level", "_cx", "_cy"], "left_semi")
    kept = spans.join(open_.select("piece"), "piece", "left_semi").join(covered, "piece", "left_anti")
    # Strips of segments that lie on each other have common pieces.
    place = [F.round(F.col(v) / (10 * SAME)).cast("long") for v in ("mx", "my")]
    first = kept.groupBy("round", *place).agg(F.min("piece").alias("piece")).select("piece")
    return kept.join(first, "piece", "left_semi").select("piece", "round", "cx", "cy", "t0", "t1", "x0", "y0", "xe", "ye")


def rings(border: DataFrame) -> DataFrame:
    """``pieces`` with ``ring``, a number, and ``pos``, 0, 1, ... around it."""
    border = materialise(border)
    ends = border.select((F.col("piece") * 2).alias("key"), F.col("x0").alias("x"), F.col("y0").alias("y")).unionAll(border.select((F.col("piece") * 2 + 1).alias("key"), F.col("xe").alias("x"), F.col("ye").alias("y")))
    corner = label(ends.withColumnRenamed("key", "node"), close_pairs(ends, SAME)).select(F.shiftright("node", 1).alias("piece"), (F.col("node") % 2).alias("end"), F.col("root").alias("corner"))
    rank = F.row_number().over(Window.partitionBy("corner", "end").orderBy("piece"))
    corner = materialise(corner.withColumn("rank", rank))
    after = corner.filter("end = 1").join(corner.filter("end = 0").select("corner", "rank", F.col("piece").alias("next")), ["corner", "rank"]).select("piece", "next")
    tied = components(after.select(F.col("piece").alias("u"), F.col("next").alias("v"))).select(F.col("node").alias("piece"), F.col("root").alias("ring"))
    single = after.filter("piece = next").select("piece", F.col("piece").alias("ring"))
    tied = tied.unionAll(single.join(tied.select("piece"), "piece", "left_anti"))
    # Steps to the ring's first piece; each round doubles how far a piece looks.
    walk = materialise(after.join(tied, "piece").select("piece", "ring", "next", F.lit(1).cast("long").alias("steps")))
    while not walk.filter("next <> ring").isEmpty():
        ahead = walk.select(F.col("piece").alias("next"), F.col("next").alias("beyond"), F.col("steps").alias("more"))
        open_ = F.col("next") != F.col("ring")
        walk = materialise(walk.join(ahead, "next").select("piece", "ring", F.when(open_, F.col("beyond")).otherwise(F.col("next")).alias("next"), F.when(open_, F.col("steps") + F.col("more")).otherwise(F.col("steps")).alias("steps")))
    whole = walk.groupBy("ring").agg(F.max("steps").alias("many"))
    placed = walk.join(whole, "ring").select("piece", "ring", F.when(F.col("piece") == F.col("ring"), 0).otherwise(F.col("many") - F.col("steps")).alias("pos"))
    return border.join(placed, "piece")


def ring_areas(around: DataFrame, radius: float) -> DataFrame:
    """(ring, area) of ``rings``: positive for outer ones, negative for holes; their sum is the area."""
    r = F.lit(float(radius))
    straight = (F.col("x0") * F.col("ye") - F.col("xe") * F.col("y0")) / 2
    arc = (r * r * (F.col("t1") - F.col("t0")) + r * F.col("cx") * (F.sin("t1") - F.sin("t0")) - r * F.col("cy") * (F.cos("t1") - F.cos("t0"))) / 2
    return around.groupBy("ring").agg(F.sum(F.when(F.col("round"), arc).otherwise(straight)).alias("area"))


def edges(border: DataFrame, radius: float, degrees: float = 1.0) -> DataFrame:
    """(x1, y1, x2, y2): the border as straight edges, arcs in chords of so many degrees at most, ends kept as they are."""
    n = F.greatest(F.lit(1), F.ceil((F.col("t1") - F.col("t0")) / F.lit(math.radians(degrees))).cast("int"))
    r = F.lit(float(radius))

    def point(i: Column) -> Column:
        t = F.col("t0") + (F.col("t1") - F.col("t0")) * i / F.col("n")
        x = F.when(i == 0, F.col("x0")).when(i == F.col("n"), F.col("xe")).otherwise(F.col("cx") + r * F.cos(t))
        y = F.when(i == 0, F.col("y0")).when(i == F.col("n"), F.col("ye")).otherwise(F.col("cy") + r * F.sin(t))
        return F.struct(x.alias("x"), y.alias("y"))

    points = border.withColumn("n", F.when(F.col("round"), n).otherwise(1)).withColumn("ps", F.transform(F.sequence(F.lit(0), F.col("n")), point))
    return points.select(F.inline(g.path(F.col("ps"))))


def inside(points: DataFrame, border: DataFrame, size: float) -> DataFrame:
    """``key`` of the points (key, x, y) inside the edges by the even-odd rule: crossings to the right, counted by bands of so many metres."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = border.filter("y1 <> y2").withColumn("_band", F.explode(F.sequence(F.floor(low / size), F.floor(high / size))))
    p = points.select("key", "x", "y", F.floor(F.col("y") / size).alias("_band"))
    at = F.col("x1") + (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    hit = p.join(banded, "_band").filter(((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < at))
    return hit.groupBy("key").agg(F.count("*").alias("_n")).filter("_n % 2 = 1").select("key")
