"""Coordinate systems against worked examples of the EPSG guidance notes and against closed forms."""

import math

import pytest
from pyspark.sql import functions as F

from corvane.functions import crs, projections
from corvane.functions.crs import TransverseMercator
from corvane.functions.projections import AIRY, BESSEL, CLARKE_1866, WGS84, Conic, Ellipsoid, Mercator, System


def dms(d, m=0.0, s=0.0):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


FOOT = 1200 / 3937
#: System without a datum shift, longitude and latitude, easting and northing, tolerance (the guidance gives hundredths of the unit).
EXAMPLES = {
    "conic, two parallels": (Conic(dms(27, 50), -99.0, dms(28, 23), dms(30, 17), 2000000.0 * FOOT, 0.0, CLARKE_1866.inverse_flattening, CLARKE_1866.axis), (-96.0, 28.5), (2963503.91 * FOOT, 254759.80 * FOOT), 0.005),
    "conic, one parallel": (Conic(18.0, -77.0, 18.0, 18.0, 250000.0, 150000.0, CLARKE_1866.inverse_flattening, CLARKE_1866.axis), (dms(-76, 56, 37.26), dms(17, 55, 55.80)), (255966.58, 142493.51), 0.006),
    "web mercator": (projections.SINGLE[3857].plane, (-dms(100, 20), dms(24, 22, 54.433)), (-11169055.58, 2800000.00), 0.01),
    "mercator": (Mercator(110.0, 0.997, 3900000.0, 900000.0, BESSEL.inverse_flattening, BESSEL.axis), (120.0, -3.0), (5009726.58, 569150.82), 0.006),
    "transverse": (TransverseMercator(49.0, -2.0, 0.9996012717, 400000.0, -100000.0, AIRY.inverse_flattening, AIRY.axis), (0.5, 50.5), (577274.99, 69740.50), 0.011),
}


def both_ways(spark, lon, lat, x, y, s):
    to, back = projections.from_degrees(F.col("lon"), F.col("lat"), s), projections.to_degrees(F.col("x"), F.col("y"), s)
    r = spark.createDataFrame([(float(lon), float(lat), float(x), float(y))], "lon double, lat double, x double, y double").select(to.alias("to"), back.alias("back")).first()
    return tuple(r.to), tuple(r.back)


@pytest.mark.parametrize("name", EXAMPLES)
def test_guidance_examples(spark, name):
    plane, (lon, lat), (x, y), near = EXAMPLES[name]
    to, back = both_ways(spark, lon, lat, x, y, System(plane, WGS84))
    assert to == (pytest.approx(x, abs=near), pytest.approx(y, abs=near))
    assert back == (pytest.approx(lon, abs=near / 1e5 * 1.2), pytest.approx(lat, abs=near / 1e5 * 1.2))


def test_seven_parameters(spark):
    """WGS 72 to WGS 84 as the guidance works it out."""
    s = (0.0, 0.0, 4.5, 0.0, 0.0, 0.554, 0.219)
    df = spark.createDataFrame([(3657660.66, 255768.55, 5201382.11)], "x double, y double, z double").select(F.struct("x", "y", "z").alias("v"))
    there = df.select(F.struct(*(c.alias(k) for k, c in projections._turned(F.col("v"), s, False).items())).alias("v"))
    assert tuple(there.first().v) == (pytest.approx(3657660.78, abs=0.006), pytest.approx(255778.43, abs=0.006), pytest.approx(5201387.75, abs=0.006))
    again = there.select(F.struct(*(c.alias(k) for k, c in projections._turned(F.col("v"), s, True).items())).alias("v"))
    assert tuple(again.first().v) == tuple(pytest.approx(c, abs=0.001) for c in (3657660.66, 255768.55, 5201382.11))


def test_geocentric_example(spark):
    """53 48 33.820 N, 2 7 46.380 E at height 0 of the guidance's point, there at 73 m."""
    lat, lon = dms(53, 48, 33.820), dms(2, 7, 46.380)
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    v = df.select(F.struct(*(c.alias(k) for k, c in projections._geocentric(F.col("lon"), F.col("lat"), WGS84).items())).alias("v"))
    up = [math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))]
    assert [c + 73.0 * u for c, u in zip(v.first().v, up)] == [pytest.approx(c, abs=0.006) for c in (3771793.968, 140253.342, 5124304.349)]
    back = v.select(projections._geographic(F.col("v"), WGS84).alias("d")).first().d
    assert (back.lon, back.lat) == (pytest.approx(lon, abs=1e-12), pytest.approx(lat, abs=1e-12))


CODES = [32601, 32631, 32660, 32721, 25832, 26917, 31983, 23030, 26715, 5343, 5347, 22183, 22195, 3857, 3395, 2154, 3034, 3347, 3942, 3950, 31467, 27700, 9498, 4326, 4221, 4230, 4314, 4258]


@pytest.mark.parametrize("code", CODES)
def test_there_and_back(spark, code):
    """Points around a system's middle come back to a tenth of a millimetre, or to 5 mm where a datum's height is let go."""
    s = projections.system(code)
    lon0 = s.plane.lon0 if s.plane else 9.0
    lat0 = (s.plane.lat0 if isinstance(s.plane, Conic) else -35.0 if getattr(s.plane, "north0", 0) == 1e7 or getattr(s.plane, "lat0", 0) == -90 else 47.0)
    rows = [(lon0 + dx, lat0 + dy) for dx in (-2.5, 0.0, 1.7) for dy in (-3.0, 0.0, 4.0)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("m", projections.from_degrees(F.col("lon"), F.col("lat"), s))
    got = df.withColumn("d", projections.to_degrees(F.col("m.x"), F.col("m.y"), s)).collect()
    near = 5e-3 / 1.1e5 if s.shift else 1e-4 / 1.1e5
    assert all(abs(r.d.lon - r.lon) < near * 2 and abs(r.d.lat - r.lat) < near for r in got)
    if s.shift:
        own = df.select(projections.from_degrees(F.col("lon"), F.col("lat"), System(None, s.ellipsoid, s.shift)).alias("p"), "lon", "lat").first()
        assert 20 < math.hypot((own.p.x - own.lon) * 8e4, (own.p.y - own.lat) * 1.1e5) < 400, "a datum lies a hundred metres off or so"


def test_rules_of_numbers():
    zone = lambda code: projections.system(code).plane
    assert zone(32721) == crs.PROJECTED[32721] and (zone(32601).lon0, zone(32660).lon0, zone(25832).lon0, zone(31983).lon0) == (-177.0, 177.0, 9.0, -45.0)
    assert (zone(5347).lon0, zone(5347).east0, zone(22195).east0) == (-60.0, 5500000.0, 5500000.0)
    assert (zone(31467).lon0, zone(31467).east0) == (9.0, 3500000.0) and (zone(3945).lat0, zone(3945).lat1, zone(3945).north0) == (45.0, 44.25, 4200000.0)
    assert [projections.system(c) for c in (None, 0, 32600, 32661, 32761, 5350, 3941, 999999)] == [None] * 8


@pytest.mark.parametrize("name, code", [("urn:ogc:def:crs:OGC:1.3:CRS84", 4326), ("urn:ogc:def:crs:EPSG::9498", 9498), ("EPSG:32721", 32721), ("other", 4326), (None, 4326), ("EPSG::4326", 4326)])
def test_code_of_a_name(spark, name, code):
    assert crs.code_of(name) == code == spark.createDataFrame([(name,)], "n string").select(crs.epsg_of(F.col("n"))).first()[0]


def test_nulls_stay_null(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    for code in (3857, 2154, 32721, 4230):
        r = df.select(projections.to_degrees(F.col("x"), F.col("y"), projections.system(code)).alias("d")).first().d
        assert r.lon is None


def test_ellipsoids_are_apart():
    assert len({Ellipsoid(*e) for e in (WGS84, BESSEL, AIRY, CLARKE_1866)}) == 4
