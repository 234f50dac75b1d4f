"""Links near points, against plain distances."""

import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import links
from corvane.plans import catalog
from tests.test_growth import no_broadcasts, written

KIND = "key long, x double, y double"


def plainly(places, link, radius):
    found, places = [0] * len(places), sorted(places)
    for i, (k, a, b) in enumerate(places):
        for m, c, d in places[i + 1 :]:
            dx, dy = c - a, d - b
            long = dx * dx + dy * dy
            if k == m or long > link * link:
                continue
            for n, (_, x, y) in enumerate(places):
                t = max(0.0, min(1.0, ((x - a) * dx + (y - b) * dy) / long)) if long else 0.0
                found[n] += (x - a - t * dx) ** 2 + (y - b - t * dy) ** 2 <= radius * radius
    return sorted((k, n) for (k, *_), n in zip(places, found))


@pytest.mark.parametrize("radius", [15.0, 9.0])
def test_links_near_any_points(spark, monkeypatch, radius):
    """Points on a grid, where distances equal the radius and the link; points in one place; equal keys; a tile that is dealt over shares; points without a place."""
    pick = random.Random(4)
    places = [(k, pick.uniform(-50, 50), pick.uniform(-50, 50)) for k in range(50)] + [(100 + k, pick.randint(-9, 9) * 5.0, pick.randint(-9, 9) * 5.0) for k in range(50)]
    places += [(200 + k, 7.5, -2.5) for k in range(10)] + [(pick.choice((3, 101)), pick.uniform(-20, 20), pick.uniform(-20, 20)) for _ in range(4)]
    nowhere = [(900, None, 1.0), (901, float("nan"), 1.0)]
    monkeypatch.setattr(links, "HOMES", 4)
    got = links.links_near(spark.createDataFrame(places + nowhere, KIND), 30.0, radius).collect()
    assert sorted((x.key, x.n) for x in got) == sorted([*plainly(places, 30.0, radius), (900, 0), (901, 0)])


def test_links_near_no_points(spark):
    assert links.links_near(spark.createDataFrame([], KIND), 30.0, 15.0).count() == 0
    with pytest.raises(ValueError):
        links.links_near(spark.createDataFrame([], KIND), 20.0, 15.0)


def test_links_are_not_made_to_be_counted(spark, tmp_path):
    """Four times as many points in the same place: links are sixteen times as many, what is shuffled is not."""

    def run(n: int) -> int:
        pick, folder = random.Random(n), str(tmp_path / str(n))
        rows = [(k, k % 10, [pick.uniform(0, 0.06) for _ in range(8)]) for k in range(n)]
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
        return written(spark, lambda: catalog.point_segment_proximity(spark, folder).agg(F.sum("n")).collect())

    with no_broadcasts(spark):
        assert run(800) < 8 * run(200)
