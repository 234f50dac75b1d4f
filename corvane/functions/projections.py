"""Coordinate systems by their EPSG number: transverse Mercator, Mercator and conformal conic planes, and datums.

``to_degrees`` and ``from_degrees`` are column expressions between a system and longitude and latitude on WGS 84, for
use inside nested functions too. A datum other than WGS 84 is reached by seven parameters (position vectors turn) over
geocentric coordinates; heights count as zero. Systems come in families by rule, so that a number tells zone and hemisphere.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import crs
from corvane.functions.crs import TransverseMercator, bind


class Ellipsoid(NamedTuple):
    axis: float
    inverse_flattening: float


class Mercator(NamedTuple):
    lon0: float
    k0: float
    east0: float
    north0: float
    inverse_flattening: float
    axis: float = 6378137.0


class Conic(NamedTuple):
    """Lambert's conformal conic; with one standard parallel ``lat1`` and ``lat2`` are equal and ``k0`` is its scale."""

    lat0: float
    lon0: float
    lat1: float
    lat2: float
    east0: float
    north0: float
    inverse_flattening: float
    axis: float = 6378137.0
    k0: float = 1.0


class System(NamedTuple):
    #: none for geographic degrees
    plane: TransverseMercator | Mercator | Conic | None
    ellipsoid: Ellipsoid
    #: metres, seconds of arc and parts per million, to WGS 84; none where its datum is the same within a metre
    shift: tuple[float, float, float, float, float, float, float] | None = None


# Fixed values of the public EPSG registry.
WGS84 = Ellipsoid(6378137.0, 298.257223563)
GRS80 = Ellipsoid(6378137.0, 298.257222101)
INTERNATIONAL = Ellipsoid(6378388.0, 297.0)
BESSEL = Ellipsoid(6377397.155, 299.1528128)
AIRY = Ellipsoid(6377563.396, 299.3249646)
CLARKE_1866 = Ellipsoid(6378206.4, 294.9786982138982)
SPHERE = Ellipsoid(6378137.0, math.inf)
SHIFTS = {
    "Campo Inchauspe": (-148.0, 136.0, 90.0, 0.0, 0.0, 0.0, 0.0),
    "ED50": (-87.0, -98.0, -121.0, 0.0, 0.0, 0.0, 0.0),
    "DHDN": (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7),
    "OSGB36": (446.448, -125.157, 542.06, 0.15, 0.247, 0.842, -20.489),
    "NAD27": (-8.0, 160.0, 176.0, 0.0, 0.0, 0.0, 0.0),
}
#: Geographic systems: ellipsoid and name of the datum's shift.
GEOGRAPHIC = {
    4326: (WGS84, None), 4258: (GRS80, None), 4269: (GRS80, None), 4674: (GRS80, None), 5340: (GRS80, None), 4190: (GRS80, None), 4694: (WGS84, None), 4171: (GRS80, None), 9497: (GRS80, None),
    4221: (INTERNATIONAL, "Campo Inchauspe"), 4230: (INTERNATIONAL, "ED50"), 4314: (BESSEL, "DHDN"), 4277: (AIRY, "OSGB36"), 4267: (CLARKE_1866, "NAD27"),
}
#: UTM families: first number and last, the first one's zone, south or north, ellipsoid and shift.
UTM = (
    (32601, 32660, 1, False, WGS84, None), (32701, 32760, 1, True, WGS84, None), (25828, 25838, 28, False, GRS80, None), (26901, 26923, 1, False, GRS80, None), (31965, 31976, 11, False, GRS80, None), (31977, 31985, 17, True, GRS80, None),
    (23028, 23038, 28, False, INTERNATIONAL, "ED50"), (26701, 26722, 1, False, CLARKE_1866, "NAD27"),
)
#: Argentine belts of three degrees, the first at 72 degrees west, from the south pole: first number, ellipsoid and shift.
BELTS = ((5343, GRS80, None), (22171, GRS80, None), (22181, WGS84, None), (22191, INTERNATIONAL, "Campo Inchauspe"))
SINGLE = {
    9498: System(crs.PROJECTED[9498], GRS80),
    3857: System(Mercator(0.0, 1.0, 0.0, 0.0, math.inf), WGS84),
    3395: System(Mercator(0.0, 1.0, 0.0, 0.0, WGS84.inverse_flattening), WGS84),
    2154: System(Conic(46.5, 3.0, 49.0, 44.0, 700000.0, 6600000.0, GRS80.inverse_flattening), GRS80),
    3034: System(Conic(52.0, 10.0, 35.0, 65.0, 4000000.0, 2800000.0, GRS80.inverse_flattening), GRS80),
    3347: System(Conic(63.390675, -91.86666666666666, 49.0, 77.0, 6200000.0, 3000000.0, GRS80.inverse_flattening), GRS80),
    27700: System(TransverseMercator(49.0, -2.0, 0.9996012717, 400000.0, -100000.0, AIRY.inverse_flattening, AIRY.axis), AIRY, SHIFTS["OSGB36"]),
}


def system(code: int | None) -> System | None:
    """The system of an EPSG number, none if it is not one of those known here."""
    if code is None:
        return None
    if code in GEOGRAPHIC:
        ellipsoid, shift = GEOGRAPHIC[code]
        return System(None, ellipsoid, SHIFTS.get(shift))
    if code in SINGLE:
        return SINGLE[code]
    for first, last, zone, south, e, shift in UTM:
        if first <= code <= last:
            return System(TransverseMercator(0.0, 6.0 * (zone + code - first) - 183.0, 0.9996, 500000.0, 10000000.0 * south, e.inverse_flattening, e.axis), e, SHIFTS.get(shift))
    for first, e, shift in BELTS:
        if first <= code < first + 7:
            belt = code - first
            return System(TransverseMercator(-90.0, 3.0 * belt - 72.0, 1.0, 1e6 * belt + 1.5e6, 0.0, e.inverse_flattening, e.axis), e, SHIFTS.get(shift))
    if 3942 <= code <= 3950:  # French conics, one a degree of latitude
        lat = float(code - 3900)
        return System(Conic(lat, 3.0, lat - 0.75, lat + 0.75, 1700000.0, 1e6 * (lat - 41) + 200000.0, GRS80.inverse_flattening), GRS80)
    if 31466 <= code <= 31469:  # German belts of three degrees
        belt = code - 31464
        return System(TransverseMercator(0.0, 3.0 * belt, 1.0, 1e6 * belt + 500000.0, 0.0, BESSEL.inverse_flattening, BESSEL.axis), BESSEL, SHIFTS["DHDN"])
    return None


def _pair(a: Column, b: Column, names: tuple[str, str]) -> Column:
    return F.struct(a.alias(names[0]), b.alias(names[1]))


def _excentricity(inverse_flattening: float) -> float:
    f = 1 / inverse_flattening
    return math.sqrt(f * (2 - f))


def _isometric(lat: float, e: float) -> float:
    s = math.sin(math.radians(lat))
    return math.atanh(s) - e * math.atanh(e * s)


def _cone(p: Conic) -> tuple[float, float, float]:
    """The cone's constant, its scale in metres, and the radius at the origin."""
    e = _excentricity(p.inverse_flattening)
    width = lambda lat: math.cos(math.radians(lat)) / math.sqrt(1 - (e * math.sin(math.radians(lat))) ** 2)
    n = math.sin(math.radians(p.lat1)) if p.lat1 == p.lat2 else (math.log(width(p.lat2)) - math.log(width(p.lat1))) / (_isometric(p.lat1, e) - _isometric(p.lat2, e))
    scale = p.axis * p.k0 * width(p.lat1) / n * math.exp(n * _isometric(p.lat1, e))
    return n, scale, scale * math.exp(-n * _isometric(p.lat0, e))


def _on_plane(lon: Column, lat: Column, p: TransverseMercator | Mercator | Conic) -> Column:
    """Metres (x, y) of degrees on the plane's ellipsoid."""
    if isinstance(p, TransverseMercator):
        return crs.projected(lon, lat, p)
    e = _excentricity(p.inverse_flattening)
    s = F.sin(F.radians(lat))
    values = {"psi": F.atanh(s) - F.lit(e) * F.atanh(F.lit(e) * s), "d": F.radians(lon - F.lit(p.lon0))}
    if isinstance(p, Mercator):
        k = F.lit(p.axis * p.k0)
        return bind(values, lambda v: _pair(F.lit(p.east0) + k * v["d"], F.lit(p.north0) + k * v["psi"], ("x", "y")))
    n, scale, r0 = _cone(p)
    polar = lambda v: {"r": F.lit(scale) * F.exp(F.lit(-n) * v["psi"]), "t": F.lit(n) * v["d"]}
    return bind(values, lambda v: bind(polar(v), lambda q: _pair(F.lit(p.east0) + q["r"] * F.sin(q["t"]), F.lit(p.north0 + r0) - q["r"] * F.cos(q["t"]), ("x", "y"))))


def _off_plane(x: Column, y: Column, p: TransverseMercator | Mercator | Conic) -> Column:
    """Degrees (lon, lat) on the plane's ellipsoid."""
    if isinstance(p, TransverseMercator):
        return crs.unprojected(x, y, p)
    # Conformal latitudes become geographic ones by the same series for all planes.
    delta = crs._series(TransverseMercator(0.0, 0.0, 1.0, 0.0, 0.0, p.inverse_flattening, p.axis))[4]
    latitude = lambda chi: F.degrees(chi + sum((F.lit(d) * F.sin(F.lit(2.0 * j) * chi) for j, d in enumerate(delta, 1)), F.lit(0.0)))
    if isinstance(p, Mercator):
        k = F.lit(p.axis * p.k0)
        values = {"lon": F.lit(p.lon0) + F.degrees((x - F.lit(p.east0)) / k), "chi": F.atan(F.sinh((y - F.lit(p.north0)) / k))}
    else:
        n, scale, r0 = _cone(p)
        dx, dy, sign = x - F.lit(p.east0), F.lit(p.north0 + r0) - y, F.lit(math.copysign(1.0, n))
        psi = F.log(F.sqrt(dx * dx + dy * dy) / F.lit(abs(scale))) / F.lit(-n)
        values = {"lon": F.lit(p.lon0) + F.degrees(F.atan2(sign * dx, sign * dy) / F.lit(n)), "chi": F.atan(F.sinh(psi))}
    return bind(values, lambda v: _pair(v["lon"], latitude(v["chi"]), ("lon", "lat")))


def _geocentric(lon: Column, lat: Column, e: Ellipsoid) -> dict[str, Column]:
    e2 = _excentricity(e.inverse_flattening) ** 2
    s, c = F.sin(F.radians(lat)), F.cos(F.radians(lat))
    n = F.lit(e.axis) / F.sqrt(F.lit(1.0) - F.lit(e2) * s * s)
    return {"x": n * c * F.cos(F.radians(lon)), "y": n * c * F.sin(F.radians(lon)), "z": n * F.lit(1 - e2) * s}


def _turned(v: Column, shift: tuple, back: bool) -> dict[str, Column]:
    tx, ty, tz = shift[:3]
    rx, ry, rz = (math.radians(r / 3600) for r in shift[3:6])
    m = 1 + shift[6] * 1e-6
    x, y, z = v["x"], v["y"], v["z"]
    if back:
        x, y, z = ((c - F.lit(t)) / F.lit(m) for c, t in ((x, tx), (y, ty), (z, tz)))
        return {"x": x + F.lit(rz) * y - F.lit(ry) * z, "y": y - F.lit(rz) * x + F.lit(rx) * z, "z": z + F.lit(ry) * x - F.lit(rx) * y}
    return {"x": F.lit(tx) + F.lit(m) * (x - F.lit(rz) * y + F.lit(ry) * z), "y": F.lit(ty) + F.lit(m) * (F.lit(rz) * x + y - F.lit(rx) * z), "z": F.lit(tz) + F.lit(m) * (F.lit(-ry) * x + F.lit(rx) * y + z)}


def _geographic(v: Column, e: Ellipsoid) -> Column:
    """Degrees of geocentric metres (Bowring's closed form)."""
    b = e.axis * (1 - 1 / e.inverse_flattening)
    e2, other = 1 - (b / e.axis) ** 2, (e.axis / b) ** 2 - 1
    p = F.sqrt(v["x"] * v["x"] + v["y"] * v["y"])
    values = {"lon": F.atan2(v["y"], v["x"]), "p": p, "z": v["z"], "t": F.atan2(v["z"] * F.lit(e.axis), p * F.lit(b))}
    cube = lambda c: c * c * c
    lat = lambda w: F.atan2(w["z"] + F.lit(other * b) * cube(F.sin(w["t"])), w["p"] - F.lit(e2 * e.axis) * cube(F.cos(w["t"])))
    return bind(values, lambda w: _pair(F.degrees(w["lon"]), F.degrees(lat(w)), ("lon", "lat")))


def shifted(lon: Column, lat: Column, source: Ellipsoid, target: Ellipsoid, shift: tuple, back: bool = False) -> Column:
    """Degrees (lon, lat) on another datum."""
    return bind(_geocentric(lon, lat, source), lambda v: bind(_turned(v, shift, back), lambda w: _geographic(w, target)))


def to_degrees(x: Column, y: Column, s: System) -> Column:
    """Longitude and latitude on WGS 84, as a struct, of a system's coordinates."""
    own = _pair(x, y, ("lon", "lat")) if s.plane is None else _off_plane(x, y, s.plane)
    if s.shift is None:
        return own
    return bind({"p": own}, lambda v: shifted(v["p"]["lon"], v["p"]["lat"], s.ellipsoid, WGS84, s.shift))


def from_degrees(lon: Column, lat: Column, s: System) -> Column:
    """A system's coordinates (x, y), as a struct, of longitude and latitude on WGS 84."""
    own = _pair(lon, lat, ("lon", "lat")) if s.shift is None else shifted(lon, lat, WGS84, s.ellipsoid, s.shift, back=True)
    if s.plane is None:
        return bind({"p": own}, lambda v: _pair(v["p"]["lon"], v["p"]["lat"], ("x", "y")))
    return bind({"p": own}, lambda v: _on_plane(v["p"]["lon"], v["p"]["lat"], s.plane))
