"""Roadway widths by transects between sidewalks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.proximity import along_cells, dealt
from corvane.storage import materialise


def roadway_widths(branches: DataFrame, sidewalks: DataFrame, offset_m: float = 12.0, max_width_m: float = 40.0, search_m: float = 80.0) -> DataFrame:
    """``width`` for branches (key, branch, x, y, bearing_deg) against polygons (shape).

    On a line across the street, ``offset_m`` out from the corner, each polygon edge gives a signed
    distance. The nearest on either side bound the free gap; an odd number on one side means that
    the point lies on that sidewalk. Polygons count whose box comes within ``search_m`` of the corner.

    A point on a sidewalk has no width, so those go first, at the first polygon found to hold them. For the others only edges within
    ``max_width_m`` matter: the part of the line that long is held against the edges of the cells along it, and a cell's
    gaps are reduced to two numbers where they are found.
    """
    size, reach, slack = max(float(max_width_m), 1.0), float(max_width_m) * (1 + 1e-6) + 1e-3, 1e-6 * max(float(max_width_m), 1.0)
    angle = F.radians("bearing_deg")
    lines = branches.select("key", "branch", "x", "y", F.sin(angle).alias("sin"), F.cos(angle).alias("cos")).select("key", "branch", "x", "y", F.col("cos").alias("nx"), (-F.col("sin")).alias("ny"), (F.col("x") + F.col("sin") * offset_m).alias("px"), (F.col("y") + F.col("cos") * offset_m).alias("py"))
    low = lambda a, b: F.least(F.array_min(F.transform("shape", lambda q: q[a])), F.array_min(F.transform("shape", lambda q: q[b])))
    high = lambda a, b: F.greatest(F.array_max(F.transform("shape", lambda q: q[a])), F.array_max(F.transform("shape", lambda q: q[b])))
    areas = materialise(sidewalks.select("shape").distinct().withColumns({"_x0": low("x1", "x2"), "_x1": high("x1", "x2"), "_y0": low("y1", "y2"), "_y1": high("y1", "y2")}))
    cells = lambda low, high: F.explode(F.sequence(F.floor((F.col(low) - slack) / size), F.floor((F.col(high) + slack) / size)))
    boxed = areas.withColumn("_cx", cells("_x0", "_x1")).withColumn("_cy", cells("_y0", "_y1"))
    placed = dealt(lines.withColumns({"_cx": F.floor(F.col("px") / size), "_cy": F.floor(F.col("py") / size)}), "_cx", "_cy")
    side = lambda x, y: (x - F.col("px")) * F.col("ny") - (y - F.col("py")) * F.col("nx")
    place = lambda x, y: (x - F.col("px")) * F.col("nx") + (y - F.col("py")) * F.col("ny")
    cut = lambda a, b, p, q: p + a / (a - b) * (q - p)
    in_search = (F.col("x") >= F.col("_x0") - search_m) & (F.col("x") <= F.col("_x1") + search_m) & (F.col("y") >= F.col("_y0") - search_m) & (F.col("y") <= F.col("_y1") + search_m)
    in_box = (F.col("px") >= F.col("_x0") - slack) & (F.col("px") <= F.col("_x1") + slack) & (F.col("py") >= F.col("_y0") - slack) & (F.col("py") <= F.col("_y1") + slack)
    a, b = (lambda q: side(q["x1"], q["y1"])), (lambda q: side(q["x2"], q["y2"]))
    at = F.transform(F.filter("shape", lambda q: (a(q) > 0) != (b(q) > 0)), lambda q: cut(a(q), b(q), place(q["x1"], q["y1"]), place(q["x2"], q["y2"])))
    holds = (F.size(F.filter(at, lambda t: t > 0)) % 2 == 1) | F.exists(at, lambda t: t == 0)
    free = placed.join(dealt(boxed.withColumnsRenamed({"_cx": "_bx", "_cy": "_by"}), "_bx", "_by"), (F.col("_cx") == F.col("_bx")) & (F.col("_cy") == F.col("_by")) & in_box & in_search & holds, "left_anti").drop("_cx", "_cy")
    ends = {"x1": F.col("px") - reach * F.col("nx"), "y1": F.col("py") - reach * F.col("ny"), "x2": F.col("px") + reach * F.col("nx"), "y2": F.col("py") + reach * F.col("ny")}
    crossed = along_cells(free.withColumns(ends), 0.0, size).drop(*ends)
    edges = along_cells(areas.select("_x0", "_x1", "_y0", "_y1", F.inline("shape")), 0.0, size)
    both = dealt(crossed, "_cx", "_cy").join(dealt(edges, "_cx", "_cy"), ["_cx", "_cy"]).filter(in_search)
    both = both.select("key", "branch", side(F.col("x1"), F.col("y1")).alias("a"), side(F.col("x2"), F.col("y2")).alias("b"), place(F.col("x1"), F.col("y1")).alias("p"), place(F.col("x2"), F.col("y2")).alias("q"))
    cuts = both.filter((F.col("a") > 0) != (F.col("b") > 0)).select("key", "branch", cut(*map(F.col, "abpq")).alias("t"))
    by = cuts.groupBy("key", "branch").agg(F.max(F.when(F.col("t") < 0, F.col("t"))).alias("left"), F.min(F.when(F.col("t") > 0, F.col("t"))).alias("right"))
    wide = F.col("right") - F.col("left")
    sound = (F.col("right") < max_width_m) & (F.col("left") > -max_width_m) & (wide <= max_width_m)
    return branches.select("key", "branch").join(by.select("key", "branch", F.when(sound, wide).alias("width")), ["key", "branch"], "left")


def crossing_metrics(corners: DataFrame, sidewalks: DataFrame, **options) -> DataFrame:
    """(key, crossing_length, roadway_width): the widest and the mean of a corner's gaps, for corners (key, x, y, branches)."""
    each = corners.select("key", "x", "y", F.posexplode("branches").alias("branch", "b")).select("key", "branch", "x", "y", F.col("b.bearing_deg").alias("bearing_deg"))
    return roadway_widths(each, sidewalks, **options).groupBy("key").agg(F.max("width").alias("crossing_length"), F.avg("width").alias("roadway_width"))
