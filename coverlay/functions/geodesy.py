"""Published closed forms for coordinate work, as column arithmetic on longitude and latitude in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from coverlay.functions.nested import map_points, xy

# GRS80 ellipsoid (fixed values).
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101

# Australian Albers, EPSG:3577 (fixed values): standard parallels, origin.
ALBERS_SP1 = -18.0
ALBERS_SP2 = -36.0
ALBERS_LAT0 = 0.0
ALBERS_LON0 = 132.0

# GDA94 to GDA2020 seven-parameter similarity, coordinate-frame sense (fixed values of the published
# technical manual): metres, arc seconds, parts per million.
SHIFT_T = (0.06155, -0.01087, -0.04019)
SHIFT_R = (-0.0394924, -0.0327221, -0.0328979)
SHIFT_S = -0.009994

_E2 = GRS80_F * (2 - GRS80_F)
_E = math.sqrt(_E2)


def albers_constants() -> dict[str, float]:
    """n, C and rho0 of the ellipsoidal Albers equal-area conic for the fixed parallels above."""

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)

    p0, p1, p2 = (math.radians(v) for v in (ALBERS_LAT0, ALBERS_SP1, ALBERS_SP2))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return {"n": n, "c": c, "rho0": GRS80_A * math.sqrt(c - n * q(p0)) / n}


def albers(lon, lat) -> Column:
    """Equal-area metres, so planar areas of the result are true areas."""
    k = albers_constants()
    s = F.sin(F.radians(lat))
    q = F.lit(1 - _E2) * (
        s / (1 - F.lit(_E2) * s * s) - F.log((1 - F.lit(_E) * s) / (1 + F.lit(_E) * s)) / F.lit(2 * _E)
    )
    rho = F.lit(GRS80_A) * F.sqrt(F.lit(k["c"]) - F.lit(k["n"]) * q) / F.lit(k["n"])
    theta = F.lit(k["n"]) * F.radians(lon - F.lit(ALBERS_LON0))
    return xy(rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta))


def albers_nested(nested) -> Column:
    return map_points(nested, lambda p: albers(p["x"], p["y"]))


def gda2020(lon, lat) -> Column:
    """GDA94 longitude/latitude to GDA2020 by the seven-parameter similarity (national fit, no distortion grid)."""
    sin_lat, cos_lat = F.sin(F.radians(lat)), F.cos(F.radians(lat))
    nu = F.lit(GRS80_A) / F.sqrt(1 - F.lit(_E2) * sin_lat * sin_lat)
    x = nu * cos_lat * F.cos(F.radians(lon))
    y = nu * cos_lat * F.sin(F.radians(lon))
    z = nu * F.lit(1 - _E2) * sin_lat
    tx, ty, tz = SHIFT_T
    rx, ry, rz = (math.radians(v / 3600) for v in SHIFT_R)
    k = 1 + SHIFT_S * 1e-6
    # coordinate-frame rotation matrix rows: (1, rz, -ry), (-rz, 1, rx), (ry, -rx, 1)
    x2 = F.lit(tx) + F.lit(k) * (x + F.lit(rz) * y - F.lit(ry) * z)
    y2 = F.lit(ty) + F.lit(k) * (-F.lit(rz) * x + y + F.lit(rx) * z)
    z2 = F.lit(tz) + F.lit(k) * (F.lit(ry) * x - F.lit(rx) * y + z)
    # Bowring's closed form back to latitude; sub-micrometre at ground level
    b = GRS80_A * (1 - GRS80_F)
    p = F.hypot(x2, y2)
    t = F.atan2(z2 * F.lit(GRS80_A), p * F.lit(b))
    ep2 = _E2 / (1 - _E2)
    lat2 = F.atan2(
        z2 + F.lit(ep2 * b) * F.pow(F.sin(t), F.lit(3.0)),
        p - F.lit(_E2 * GRS80_A) * F.pow(F.cos(t), F.lit(3.0)),
    )
    return xy(F.degrees(F.atan2(y2, x2)), F.degrees(lat2))


def gda2020_nested(nested) -> Column:
    return map_points(nested, lambda p: gda2020(p["x"], p["y"]))
