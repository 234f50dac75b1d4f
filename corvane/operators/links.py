"""Counts over the links between near points, without making the links: their number is quadratic in the points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.storage import materialise

#: Points of a tile that a task counts for; a tile with more is dealt over shares.
HOMES = 512
#: Entries of a matrix that are compared at a time.
HELD = 1 << 15


def links_near(points: DataFrame, link: float, radius: float, name: str = "n") -> DataFrame:
    """(key, ``name``) for points (key, x, y): how many links come within ``radius`` of a point. Links are straight, between any two points of different keys at most ``link`` apart.

    A link is near a point if one of its ends is, or if it passes between. Of the first kind are all links of the ends in reach, less
    those counted at both ends: two ends in reach are linked, for ``link`` is at least two radii. Of the second kind are pairs of ends out
    of reach, whose tangents to the circle are together no longer than the link; only such pairs are compared, in the task that
    has all points around a tile. So points are shuffled, as often as there are tiles around them, and no link is.
    """
    link, radius = float(link), float(radius)
    if not 0 < 2 * radius <= link:
        raise ValueError("links are counted for a radius of at most half their length")
    sound = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    placed = points.select(F.monotonically_increasing_id().alias("_row"), "key", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    placed = materialise(placed)
    at = placed.filter(sound("x") & sound("y") & F.col("key").isNotNull())
    # Ends in reach of a tile have their own links around them.
    tile = lambda c: F.floor(F.col(c) / radius)
    around = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius - link) / radius - 1e-6), F.floor((F.col(c) + radius + link) / radius + 1e-6)))
    homes = at.withColumns({"_tx": tile("x"), "_ty": tile("y")})
    many = homes.groupBy("_tx", "_ty").agg(F.ceil(F.count("*") / F.lit(HOMES)).cast("int").alias("_shares")).withColumnsRenamed({"_tx": "_cx", "_ty": "_cy"})
    copies = homes.withColumn("_cx", around("x")).withColumn("_cy", around("y")).join(F.broadcast(many), ["_cx", "_cy"])
    own = (F.col("_cx") == F.col("_tx")) & (F.col("_cy") == F.col("_ty"))
    copies = copies.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    copies = copies.select("_cx", "_cy", "_share", "_row", "key", "x", "y", (own & (F.pmod("_row", F.col("_shares")) == F.col("_share"))).alias("_home"))
    tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 16 * placed.sparkSession.sparkContext.defaultParallelism)

    def counted(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_numpy() for c in ("_row", "key", "x", "y", "_home"))
        rows, found = _counted(*columns, link, radius)
        return pa.table({"_row": pa.array(rows, pa.int64()), "_n": pa.array(found, pa.int64())})

    found = copies.repartition(tasks, "_cx", "_cy", "_share").groupBy("_cx", "_cy", "_share").applyInArrow(counted, "_row long, _n long")
    return placed.select("_row", "key").join(found, "_row", "left").select("key", F.coalesce("_n", F.lit(0)).cast("long").alias(name))


def _counted(rows: np.ndarray, keys: np.ndarray, x: np.ndarray, y: np.ndarray, home: np.ndarray, link: float, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The home points' rows and how many links are near each, from all points around them."""
    order = np.argsort(x, kind="stable")
    rows, keys, x, y, home = rows[order], keys[order], x[order], y[order], home[order]
    at = np.flatnonzero(home)
    if not len(at):
        return rows[at], at.astype(np.int64)
    alike = len(np.unique(keys)) < len(keys)
    degree = _degrees(keys, x, y, (x[at].min() - radius, x[at].max() + radius, y[at].min() - radius, y[at].max() + radius), link, alike)
    reach = np.sqrt(radius * radius + link * link) * (1 + 1e-9)
    low, high = np.searchsorted(x, x[at] - reach, "left"), np.searchsorted(x, x[at] + reach, "right")
    found = np.zeros(len(at), np.int64)
    for i, (p, a, b) in enumerate(zip(at, low, high)):
        px, py = x[a:b] - x[p], y[a:b] - y[p]
        d2 = px * px + py * py
        ends = np.flatnonzero(d2 < radius * radius * (1 - 1e-9))
        pairs = len(ends) * (len(ends) - 1) // 2
        if alike:
            _, times = np.unique(keys[a:b][ends], return_counts=True)
            pairs -= int((times * (times - 1) // 2).sum())
        found[i] = degree[a:b][ends].sum() - pairs
        edge = a + np.flatnonzero((d2 >= radius * radius * (1 - 1e-9)) & (d2 <= radius * radius * (1 + 1e-9)))
        if len(edge):
            found[i] += _touching(edge, a + ends, keys, x, y, (x[p], y[p]), link, radius)
        out = np.flatnonzero((d2 > radius * radius * (1 + 1e-9)) & (d2 <= reach * reach))
        if len(out) > 1:
            found[i] += _passing(px[out], py[out], d2[out], x[a:b][out], y[a:b][out], keys[a:b][out], (x[p], y[p]), link, radius, alike)
    return rows[at], found


def _degrees(keys: np.ndarray, x: np.ndarray, y: np.ndarray, box: tuple[float, float, float, float], link: float, alike: bool) -> np.ndarray:
    """The links of each point in a box, 0 for others; ``x`` ascends."""
    west, east, south, north = box
    wanted, degree = np.flatnonzero((x >= west) & (x <= east) & (y >= south) & (y <= north)), np.zeros(len(x), np.int64)
    step = max(1, HELD // max(1, len(x)))
    for i in range(0, len(wanted), step):
        w = wanted[i : i + step]
        a, b = np.searchsorted(x, x[w[0]] - link * (1 + 1e-9), "left"), np.searchsorted(x, x[w[-1]] + link * (1 + 1e-9), "right")
        dx, dy = x[w, None] - x[None, a:b], y[w, None] - y[None, a:b]
        near = dx * dx + dy * dy <= link * link
        degree[w] = (near & (keys[w, None] != keys[None, a:b])).sum(axis=1) if alike else near.sum(axis=1) - 1
    return degree


def _near(u: np.ndarray, v: np.ndarray, keys: np.ndarray, x: np.ndarray, y: np.ndarray, site: tuple[float, float], radius: float) -> np.ndarray:
    """Whether links between points u and v are near a site, by the distance as it is worked out for a segment from its smaller key."""
    turned = keys[u] > keys[v]
    u, v = np.where(turned, v, u), np.where(turned, u, v)
    dx, dy, ex, ey = x[v] - x[u], y[v] - y[u], site[0] - x[u], site[1] - y[u]
    long = dx * dx + dy * dy
    t = np.clip(np.divide(ex * dx + ey * dy, long, out=np.zeros(len(u)), where=long > 0), 0.0, 1.0)
    gx, gy = ex - t * dx, ey - t * dy
    return gx * gx + gy * gy <= radius * radius


def _touching(edge: np.ndarray, inner: np.ndarray, keys: np.ndarray, x: np.ndarray, y: np.ndarray, site: tuple[float, float], link: float, radius: float) -> int:
    """Near links of the points at ``radius`` from the site but for rounding, those of inner points left out."""
    found, done = 0, np.zeros(len(x), bool)
    done[inner] = True
    for p in edge:
        done[p] = True
        a, b = np.searchsorted(x, x[p] - link * (1 + 1e-9), "left"), np.searchsorted(x, x[p] + link * (1 + 1e-9), "right")
        dx, dy = x[a:b] - x[p], y[a:b] - y[p]
        other = a + np.flatnonzero((dx * dx + dy * dy <= link * link) & (keys[a:b] != keys[p]) & ~done[a:b])
        found += int(_near(np.full(len(other), p), other, keys, x, y, site, radius).sum())
    return found


def _passing(px: np.ndarray, py: np.ndarray, d2: np.ndarray, x: np.ndarray, y: np.ndarray, keys: np.ndarray, site: tuple[float, float], link: float, radius: float, alike: bool) -> int:
    """Links between points out of reach of the site, the origin of (px, py), that pass within ``radius`` of it: their foot is between the ends."""
    tangent = np.sqrt(d2 - radius * radius)
    order = np.argsort(tangent, kind="stable")
    tangent, px, py, d2, x, y, keys = (v[order] for v in (tangent, px, py, d2, x, y, keys))
    # The tangents of both ends, the shorter one first, are no longer than the link.
    most = link * (1 + 1e-9)
    last = int(np.searchsorted(tangent, most / 2, "right"))
    found, i, r2, l2 = 0, 0, radius * radius, link * link
    while i < last:
        j = int(np.searchsorted(tangent, most - tangent[i], "right"))
        if j <= i + 1:
            break
        k = min(last, i + max(1, HELD // (j - i)))
        dx = x[i:k, None] - x[None, i:j]
        dy = y[i:k, None] - y[None, i:j]
        dx *= dx
        dy *= dy
        dx += dy
        turn = np.multiply(px[i:k, None], py[None, i:j], out=dy)
        turn -= py[i:k, None] * px[None, i:j]
        turn *= turn
        near = dx <= l2
        dx *= r2 * (1 + 1e-9)
        near &= turn <= dx
        dx *= 1 - 2e-9
        touching = turn > dx
        foot = np.multiply(px[i:k, None], px[None, i:j], out=dx)
        foot += py[i:k, None] * py[None, i:j]
        near &= foot < d2[i:k, None]
        if alike:
            near &= keys[i:k, None] != keys[None, i:j]
        touching &= near
        if touching.any():
            a, b = np.nonzero(touching)
            near[a, b] = _near(i + a, i + b, keys, x, y, site, radius)
        # Each pair once: the columns of the block's own rows hold both orders.
        own = k - i
        found += int(np.count_nonzero(near[:, own:])) + int(np.count_nonzero(np.triu(near[:, :own], 1)))
        i = k
    return found
