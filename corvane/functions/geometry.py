"""Planar geometry on nested columns. A shape is an array of segments (x1, y1, x2, y2); a point is a segment of no length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.array(F.struct(x.alias("x1"), y.alias("y1"), x.alias("x2"), y.alias("y2")))


def path(points: Column) -> Column:
    """Segments between neighbouring points, an array of (x, y)."""
    n = F.size(points)
    pair = lambda i: F.struct(points[i]["x"].alias("x1"), points[i]["y"].alias("y1"), points[i + 1]["x"].alias("x2"), points[i + 1]["y"].alias("y2"))
    return F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), pair)).when(n == 1, point(points[0]["x"], points[0]["y"]))


def bearing(dx: Column, dy: Column) -> Column:
    """Degrees from north, clockwise, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def segment_distance2(px: Column, py: Column, s: Column) -> Column:
    """The squared distance of a point from a segment."""
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    ex, ey = px - s["x1"], py - s["y1"]
    long = dx * dx + dy * dy
    t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (ex * dx + ey * dy) / long))).otherwise(0.0)
    gx, gy = ex - t * dx, ey - t * dy
    return gx * gx + gy * gy


def inside(px: Column, py: Column, shape: Column) -> Column:
    """Even-odd rule over all rings."""
    hit = lambda s: ((s["y1"] > py) != (s["y2"] > py)) & (px < s["x1"] + (py - s["y1"]) / (s["y2"] - s["y1"]) * (s["x2"] - s["x1"]))
    return F.size(F.filter(shape, lambda s: F.when((s["y1"] > py) != (s["y2"] > py), hit(s)).otherwise(False))) % 2 == 1


def distance2(px: Column, py: Column, shape: Column, area: Column | None = None) -> Column:
    """The squared distance of a point from a shape; none inside an area."""
    edge = F.array_min(F.transform(shape, lambda s: segment_distance2(px, py, s)))
    return edge if area is None else F.when(area & inside(px, py, shape), 0.0).otherwise(edge)


def along(points: Column, distance: float) -> Column:
    """The point at ``distance`` along a path of (x, y), its end where it is shorter."""
    start = F.struct(F.lit(float(distance)).alias("left"), points[0]["x"].alias("x"), points[0]["y"].alias("y"))

    def step(state: Column, p: Column) -> Column:
        dx, dy = p["x"] - state["x"], p["y"] - state["y"]
        long = F.sqrt(dx * dx + dy * dy)
        part = F.when(long > 0, F.least(F.lit(1.0), state["left"] / long)).otherwise(0.0)
        return F.when(state["left"] <= 0, state).otherwise(F.struct(F.greatest(F.lit(0.0), state["left"] - long).alias("left"), (state["x"] + part * dx).alias("x"), (state["y"] + part * dy).alias("y")))

    walked = F.aggregate(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), start, step)
    # Most paths are one straight step, for which plain columns do.
    p, q = points[0], F.get(points, 1)
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    long = F.sqrt(dx * dx + dy * dy)
    part = F.when(long > 0, F.least(F.lit(1.0), F.lit(float(distance)) / long)).otherwise(0.0)
    one = F.lit(distance > 0) & (F.size(points) == 2)
    return F.struct(*(F.when(one, p[c] + part * d).otherwise(walked[c]).alias(c) for c, d in (("x", dx), ("y", dy))))
