"""The outline of buffered lines against closed forms and a raster."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import outline

KIND = "x1 double, y1 double, x2 double, y2 double"


def areas(spark, lines, r):
    around = outline.rings(outline.pieces(spark.createDataFrame([tuple(map(float, s)) for s in lines], KIND), r))
    return sorted(x.area for x in outline.ring_areas(around, r).collect()), around


def test_closed_forms(spark):
    r = 10.0
    disc = math.pi * r * r
    assert areas(spark, [(5, 5, 5, 5)], r)[0] == [pytest.approx(disc)]
    assert areas(spark, [(0, 0, 100, 0), (100, 0, 0, 0)], r)[0] == [pytest.approx(disc + 2 * r * 100)]
    # parts of one line, one of them lying on another
    assert areas(spark, [(0, 0, 40, 0), (40, 0, 100, 0), (20, 0, 60, 0)], r)[0] == [pytest.approx(disc + 2 * r * 100)]
    # a cross, and two lines far from each other
    assert areas(spark, [(-50, 0, 50, 0), (0, -50, 0, 50)], r)[0] == [pytest.approx(2 * (disc + 2 * r * 100) - (2 * r) ** 2)]
    assert areas(spark, [(0, 0, 100, 0), (0, 500, 100, 500)], r)[0] == [pytest.approx(disc + 2 * r * 100)] * 2


def test_a_block_has_a_hole(spark):
    """Four streets around a block: the hole is the block less the radius, the outside has round corners."""
    r, square = 10.0, [(0, 0, 100, 0), (100, 0, 100, 100), (100, 100, 0, 100), (0, 100, 0, 0)]
    got, around = areas(spark, square, r)
    assert got == [pytest.approx(-(80.0**2)), pytest.approx(100.0**2 + 4 * 100 * r + math.pi * r * r)]
    for ring in {x.ring for x in around.collect()}:
        rows = sorted((x for x in around.collect() if x.ring == ring), key=lambda x: x.pos)
        assert [x.pos for x in rows] == list(range(len(rows)))
        assert all(math.dist((a.xe, a.ye), (b.x0, b.y0)) < 1e-3 for a, b in zip(rows, [*rows[1:], rows[0]]))


@pytest.mark.parametrize("seed", range(2))
def test_raster(spark, seed):
    """Any lines, grid streets with bends among them: a point is inside if a line is within the radius, and areas agree with the raster."""
    pick, r = random.Random(seed), 12.0
    lines = [(x, y, x + pick.uniform(-60, 60), y + pick.uniform(-60, 60)) for x, y in ((pick.uniform(0, 200), pick.uniform(0, 200)) for _ in range(14))]
    lines += [(50.0 * i, 50.0 * j, 50.0 * i + 50, 50.0 * j) for i in range(3) for j in range(2)] + [(50.0, 0.0, 50.0, 50.0)]
    step = 4.0
    spots = [(i, x * step + 0.37, y * step + 0.41) for i, (x, y) in enumerate((x, y) for x in range(-20, 75) for y in range(-20, 75))]

    def near(x, y):
        best = math.inf
        for a, b, c, d in lines:
            dx, dy = c - a, d - b
            t = max(0.0, min(1.0, ((x - a) * dx + (y - b) * dy) / (dx * dx + dy * dy)))
            best = min(best, math.dist((x, y), (a + t * dx, b + t * dy)))
        return best

    border = outline.pieces(spark.createDataFrame(lines, KIND), r)
    got = {k.key for k in outline.inside(spark.createDataFrame(spots, "key long, x double, y double"), outline.edges(border, r), 20.0).collect()}
    far = {i: near(x, y) for i, x, y in spots}
    assert all((i in got) == (d < r) for i, d in far.items() if abs(d - r) > 0.01)
    total = sum(x.area for x in outline.ring_areas(outline.rings(border), r).collect())
    assert total == pytest.approx(sum(d < r for d in far.values()) * step * step, rel=0.02)


def test_no_lines_and_no_radius(spark):
    assert outline.rings(outline.pieces(spark.createDataFrame([], KIND), 5.0)).count() == 0
    with pytest.raises(ValueError):
        outline.pieces(spark.createDataFrame([], KIND), 0.0)
