"""Distances, projections and planar geometry as column expressions."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Earth radii in metres: for clustering, and for the comparison of runs.
CLUSTER_RADIUS, COMPARE_RADIUS = 6371008.8, 6371000.0

# Coefficients (power of first variable, of second, factor) of the published polynomials between
# WGS84 and the Dutch grid (Schreutelkamp and Strang van Hees, 2001), good to a few decimetres within the country.
RD_X0, RD_Y0, LAT0, LON0 = 155000.0, 463000.0, 52.15517440, 5.38720621
TO_X = ((0, 1, 190094.945), (1, 1, -11832.228), (2, 1, -114.221), (0, 3, -32.391), (1, 0, -0.705), (3, 1, -2.340), (1, 3, -0.608), (0, 2, -0.008), (2, 3, 0.148))
TO_Y = ((1, 0, 309056.544), (0, 2, 3638.893), (2, 0, 73.077), (1, 2, -157.984), (3, 0, 59.788), (0, 1, 0.433), (2, 2, -6.439), (1, 1, -0.032), (0, 4, 0.092), (1, 4, -0.054))
TO_LAT = ((0, 1, 3235.65389), (2, 0, -32.58297), (0, 2, -0.24750), (2, 1, -0.84978), (0, 3, -0.06550), (2, 2, -0.01709), (1, 0, -0.00738), (4, 0, 0.00530), (2, 3, -0.00039), (4, 1, 0.00033), (1, 1, -0.00012))
TO_LON = ((1, 0, 5260.52916), (1, 1, 105.94684), (1, 2, 2.45656), (3, 0, -0.81885), (1, 3, 0.05594), (3, 1, -0.05607), (0, 1, 0.01199), (3, 2, -0.00256), (1, 4, 0.00128), (0, 2, 0.00022), (2, 0, -0.00022), (5, 0, 0.00026))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = CLUSTER_RADIUS) -> Column:
    """Great-circle distance in metres; null if any coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def on_sphere(lat: Column, lon: Column, radius: float = CLUSTER_RADIUS) -> tuple[Column, Column, Column]:
    """A place as a point in space, in metres: cells of such points have the same size everywhere, poles included."""
    p, q = F.radians(lat), F.radians(lon)
    return radius * F.cos(p) * F.cos(q), radius * F.cos(p) * F.sin(q), radius * F.sin(p)


def ellipsoidal(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres on the WGS84 ellipsoid by its radii of curvature at the mean latitude.

    Off by less than a millimetre up to 1 km and a centimetre up to 10 km, away from the poles; for long distances there
    is :func:`geodesic`. A column expression, where that one needs a Python worker.
    """
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    mid, dy = F.radians((lat1 + lat2) / 2), F.radians(lat2 - lat1)
    dx = F.radians(F.pmod(lon2 - lon1 + 540.0, F.lit(360.0)) - 180.0)
    w = 1 - e2 * F.pow(F.sin(mid), 2)
    north, east = dy * (a * (1 - e2)) / (w * F.sqrt(w)), dx * F.cos(mid) * a / F.sqrt(w)
    return F.sqrt(north * north + east * east)


def far_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """:func:`ellipsoidal` up to 20 km, beyond that the great circle, which is within 0.6 % at any distance.

    Ranks right within either range and to that share across their border.
    """
    great = haversine(lat1, lon1, lat2, lon2)
    return F.when(great <= 20_000, ellipsoidal(lat1, lon1, lat2, lon2)).otherwise(great)


def _power(x: Column, n: int) -> Column:
    return reduce(lambda a, b: a * b, [x] * n) if n else F.lit(1.0)


def _polynomial(terms, p: Column, q: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(k) * _power(p, i) * _power(q, j) for i, j, k in terms])


def rd_from_wgs84(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Grid coordinates (x, y) in metres."""
    p, q = 0.36 * (lat - LAT0), 0.36 * (lon - LON0)
    return RD_X0 + _polynomial(TO_X, p, q), RD_Y0 + _polynomial(TO_Y, p, q)


def wgs84_from_rd(x: Column, y: Column) -> tuple[Column, Column]:
    """(latitude, longitude) in degrees."""
    p, q = (x - RD_X0) * 1e-5, (y - RD_Y0) * 1e-5
    return LAT0 + _polynomial(TO_LAT, p, q) / 3600, LON0 + _polynomial(TO_LON, p, q) / 3600


def planar(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def along_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Where on the segment a-b, from 0 to 1, the point closest to p lies; 0 on a segment without length."""
    length = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    return F.when(length == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / F.nullif(length, F.lit(0.0)))))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    t = along_segment(px, py, ax, ay, bx, by)
    return planar(px, py, ax + t * (bx - ax), ay + t * (by - ay))


def crossings(px: Column, py: Column, ring: Column) -> Column:
    """How many edges of a ring, an array of (x, y) structs whose last vertex joins the first, a ray to the right crosses.

    The lower end of an edge belongs to it, the upper one doesn't.
    """
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i % n + 1)
        return ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.size(F.filter(F.sequence(F.lit(1), n), crosses))


def edge_distance(px: Column, py: Column, ring: Column) -> Column:
    """Distance from a point to the closest edge of a ring."""
    n = F.size(ring)
    edge = lambda i: segment_distance(px, py, F.element_at(ring, i)["x"], F.element_at(ring, i)["y"], F.element_at(ring, i % n + 1)["x"], F.element_at(ring, i % n + 1)["y"])
    return F.array_min(F.transform(F.sequence(F.lit(1), n), edge))


def in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Whether a point lies in a ring, by the even-odd rule."""
    return crossings(px, py, ring) % 2 == 1


def ring_distance(px: Column, py: Column, ring: Column) -> Column:
    """Distance from a point to the ring's edges; 0 inside."""
    return F.when(in_ring(px, py, ring), 0.0).otherwise(edge_distance(px, py, ring))


@F.pandas_udf(DoubleType())
def geodesic(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """Distance in metres on the WGS84 ellipsoid by Vincenty's inverse formula; null near antipodes or for null input."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(x.to_numpy(float)))) for x in (lat1, lat2))
    diff = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
    lam, done = diff.copy(), np.zeros(len(diff), bool)
    with np.errstate(all="ignore"):
        for _ in range(40):
            sin_s = np.hypot(np.cos(u2) * np.sin(lam), np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * np.cos(lam))
            cos_s = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0, np.cos(u1) * np.cos(u2) * np.sin(lam) / sin_s)
            cos2 = 1 - sin_a**2
            mid = np.where(cos2 == 0, 0, cos_s - 2 * np.sin(u1) * np.sin(u2) / cos2)
            c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
            new = diff + (1 - c) * f * sin_a * (sigma + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
            done = np.abs(new - lam) < 1e-12
            lam = new
            if done[~np.isnan(lam)].all():
                break
        k = cos2 * (a**2 - b**2) / b**2
        big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        delta = big_b * sin_s * (mid + big_b / 4 * (cos_s * (2 * mid**2 - 1) - big_b / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)))
        out = np.where(done, b * big_a * (sigma - delta), np.nan)
    return pd.Series(out).where(~np.isnan(out), None).astype(float)
