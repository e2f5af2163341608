"""Distances on the Earth.

``haversine_km``      great circle on a sphere of the mean Earth radius; a native expression.
``geodesic_km``       ellipsoidal distance on WGS-84, for any pair of finite coordinates.
``geodesic_array_km`` the same from one point to each of a list of points.

The geodesic is an iterative solution, which built-in expressions can't state without either a cap on iterations or
an expression that grows with each step; so it is an Arrow-batched UDF over numpy arrays, and one opaque expression
for the optimiser: it can be filtered, joined and aggregated like any column.

All take latitude/longitude in degrees and return kilometres.
"""

from __future__ import annotations

import math
import re
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

# WGS-84 ellipsoid and the IUGG mean Earth radius.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
WGS84_B_KM = WGS84_A_KM * (1 - WGS84_F)
MEAN_RADIUS_KM = 6371.0088

# Spherical distance (mean radius) and WGS-84 geodesic distance differ by
# well under 1 %; bounds derived on the sphere are scaled by this factor
# before they are compared with either metric.
SPHERE_TO_ELLIPSOID_SAFETY = 0.99


def sql_double(x: float) -> str:
    """A DOUBLE literal in both Spark SQL and DuckDB (exponent form)."""
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    r = repr(float(x))
    return r if "e" in r else r + "E0"


def quote(name: str) -> str:
    """A column name as a Spark SQL identifier."""
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*", name):
        return name
    return "`" + name.replace("`", "``") + "`"


# --- haversine --------------------------------------------------------------

def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_km: float = MEAN_RADIUS_KM) -> str:
    return (
        f"({sql_double(2 * radius_km)} * asin(sqrt(least(1E0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = MEAN_RADIUS_KM) -> Column:
    """Great-circle distance; arguments are column names or Columns."""
    if all(isinstance(c, str) for c in (lat1, lon1, lat2, lon2)):
        return F.expr(haversine_sql(*map(quote, (lat1, lon1, lat2, lon2)), radius_km=radius_km))
    lat1, lon1, lat2, lon2 = (c if isinstance(c, Column) else F.col(c) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


# --- geodesic -----------------------------------------------------------------

def _fast(beta1, beta2, lam):
    """Fixed-point iteration for the spherical longitude difference; NaN where it doesn't settle (near-antipodal pairs)."""
    s1, c1, s2, c2 = np.sin(beta1), np.cos(beta1), np.sin(beta2), np.cos(beta2)
    out = np.full(len(lam), np.nan)
    todo = np.arange(len(lam))
    omega = lam.copy()
    second = (WGS84_A_KM**2 - WGS84_B_KM**2) / WGS84_B_KM**2
    for _ in range(20):
        if not len(todo):
            break
        sl, cl = np.sin(omega[todo]), np.cos(omega[todo])
        a1, b1, a2, b2 = s1[todo], c1[todo], s2[todo], c2[todo]
        ss = np.hypot(b2 * sl, b1 * a2 - a1 * b2 * cl)
        cs = a1 * a2 + b1 * b2 * cl
        sigma = np.arctan2(ss, cs)
        sa = np.where(ss > 0, b1 * b2 * sl / np.where(ss > 0, ss, 1), 0.0)
        c2a = np.maximum(0.0, 1 - sa * sa)
        mid = np.where(c2a > 1e-15, cs - 2 * a1 * a2 / np.where(c2a > 1e-15, c2a, 1), 0.0)
        c = WGS84_F / 16 * c2a * (4 + WGS84_F * (4 - 3 * c2a))
        new = lam[todo] + (1 - c) * WGS84_F * sa * (sigma + c * ss * (mid + c * cs * (2 * mid * mid - 1)))
        done = (np.abs(new - omega[todo]) < 1e-12) & (np.abs(new) <= math.pi)
        u = c2a * second
        big_a = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
        big_b = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
        shift = big_b * ss * (mid + big_b / 4 * (cs * (2 * mid * mid - 1) - big_b / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))
        out[todo[done]] = (WGS84_B_KM * big_a * (sigma - shift))[done]
        omega[todo] = new
        todo = todo[~done & (np.abs(new) <= math.pi)]
    return out


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(24)


def _sure(beta1, beta2, lam):
    """Bisection on the azimuth at the first point, for any pair.

    The pair is mirrored so that the first point is the one farther from the equator and lies south of it, and the
    longitude difference is from 0 to pi; the longitude that a geodesic gains up to the second point's latitude then
    grows with its azimuth. Arc length and longitude are integrals over the auxiliary sphere, by quadrature.
    """
    swap = np.abs(beta1) < np.abs(beta2)
    beta1, beta2 = np.where(swap, beta2, beta1), np.where(swap, beta1, beta2)
    flip = np.where(beta1 > 0, -1.0, 1.0)
    beta1, beta2 = beta1 * flip, beta2 * flip
    # on the equator the first point counts as south of it: -0.0
    s1, c1, s2, c2 = -np.abs(np.sin(beta1)), np.maximum(np.cos(beta1), 1e-15), np.sin(beta2), np.maximum(np.cos(beta2), 1e-15)
    second = (2 - WGS84_F) * WGS84_F / (1 - WGS84_F) ** 2

    def along(azimuth):
        sa, ca = np.sin(azimuth), np.cos(azimuth)
        s0 = sa * c1
        # the azimuth at the second point, on the way north
        ca2 = np.sqrt(np.maximum(0.0, (ca * c1) ** 2 + np.where(c1 < -s1, (c2 - c1) * (c1 + c2), (s1 - s2) * (s1 + s2)))) / c2
        first, last = np.arctan2(s1, ca * c1), np.arctan2(s2, ca2 * c2)
        w1, w2 = np.arctan2(s0 * s1, ca * c1), np.arctan2(s0 * s2, ca2 * c2)
        half = (last - first) / 2
        at = (last + first)[:, None] / 2 + half[:, None] * _NODES
        root = np.sqrt(1 + (second * np.maximum(0.0, 1 - s0 * s0))[:, None] * np.sin(at) ** 2)
        length = WGS84_B_KM * half * (root @ _WEIGHTS)
        turn = half * (((2 - WGS84_F) / (1 + (1 - WGS84_F) * root)) @ _WEIGHTS)
        return (w2 - w1) - WGS84_F * s0 * turn, length

    low, high = np.zeros(len(lam)), np.full(len(lam), math.pi)
    for _ in range(60):
        mid = (low + high) / 2
        gained, _ = along(mid)
        less = gained < lam
        low, high = np.where(less, mid, low), np.where(less, high, mid)
    return along((low + high) / 2)[1]


def geodesic_distances(lat1, lon1, lat2, lon2) -> np.ndarray:
    """WGS-84 distances of arrays of points in km; NaN only where a coordinate is missing or not finite."""
    lat1, lon1, lat2, lon2 = (np.asarray(x, float) for x in (lat1, lon1, lat2, lon2))
    out = np.full(len(lat1), np.nan)
    use = np.flatnonzero(np.isfinite(lat1) & np.isfinite(lon1) & np.isfinite(lat2) & np.isfinite(lon2))
    if not len(use):
        return out
    beta1, beta2 = (np.arctan((1 - WGS84_F) * np.tan(np.radians(x[use]))) for x in (lat1, lat2))
    lam = np.abs(np.radians((lon2[use] - lon1[use] + 180.0) % 360.0 - 180.0))
    got = _fast(beta1, beta2, lam)
    same = (lat1[use] == lat2[use]) & (lam == 0)
    got[same] = 0.0
    rest = np.isnan(got)
    if rest.any():
        got[rest] = _sure(beta1[rest], beta2[rest], lam[rest])
    out[use] = got
    return out


def _distances(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    d = geodesic_distances(lat1, lon1, lat2, lon2)
    return pd.Series(d).astype("Float64").mask(np.isnan(d))


def _array_distances(lat: pd.Series, lon: pd.Series, lats: pd.Series, lons: pd.Series) -> pd.Series:
    sizes = np.array([0 if x is None else len(x) for x in lats])
    if not sizes.sum():
        return pd.Series([None if x is None else [] for x in lats], dtype=object)
    flat = [np.concatenate([np.asarray(x, float) for x in s if x is not None]) for s in (lats, lons)]
    d = geodesic_distances(np.repeat(lat.to_numpy(float), sizes), np.repeat(lon.to_numpy(float), sizes), *flat)
    ends = np.cumsum(sizes)
    return pd.Series([None if x is None else d[e - n : e].tolist() for x, e, n in zip(lats, ends, sizes)], dtype=object)


# Serialised by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
_geodesic = F.pandas_udf(_distances, DoubleType())
_geodesic_array = F.pandas_udf(_array_distances, ArrayType(DoubleType()))


def geodesic_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """WGS-84 geodesic distance; arguments are column names. Null where a coordinate is null or not finite."""
    return _geodesic(*(F.expr(quote(c)).cast("double") for c in (lat1, lon1, lat2, lon2)))


def geodesic_array_km(lat: str, lon: str, lats: Column, lons: Column) -> Column:
    """Distances from (lat, lon) to each point of the two lists."""
    return _geodesic_array(F.expr(quote(lat)), F.expr(quote(lon)), lats, lons)


def with_geodesic_km(df: DataFrame, out: str, lat1: str, lon1: str, lat2: str, lon2: str) -> DataFrame:
    """Add ``out`` = WGS-84 geodesic distance."""
    return df.withColumn(out, geodesic_km(lat1, lon1, lat2, lon2))


# --- lower bound used by the nearest-facility search --------------------------

def block_lower_bound_sql(lat: str, lon: str, g: float) -> str:
    """Lower bound (km) from a point to anything outside its 3x3 block of g-degree cells.

    Latitude: the meridian arc to the block's north/south edge (none beyond a
    pole). Longitude: on the sphere the distance to a meridian at offset d is
    R * asin(cos(lat) * sin(d)) for d <= 90 degrees (clamped beyond); the
    block's edges are clipped at the antimeridian, and a block spanning all
    longitudes has no such bound. Scaled by SPHERE_TO_ELLIPSOID_SAFETY so it
    also bounds the ellipsoidal distance.
    """
    gs, inf = sql_double(g), sql_double(math.inf)
    cx, cy = f"floor(({lon} + 180) / {gs})", f"floor(({lat} + 90) / {gs})"
    west, east = f"(({cx} - 1) * {gs} - 180)", f"(({cx} + 2) * {gs} - 180)"
    south, north = f"(({cy} - 1) * {gs} - 90)", f"(({cy} + 2) * {gs} - 90)"
    per_deg = sql_double(MEAN_RADIUS_KM * math.pi / 180 * SPHERE_TO_ELLIPSOID_SAFETY)
    radius = sql_double(MEAN_RADIUS_KM * SPHERE_TO_ELLIPSOID_SAFETY)
    gap_n = f"CASE WHEN {north} > 90 THEN {inf} ELSE {per_deg} * ({north} - {lat}) END"
    gap_s = f"CASE WHEN {south} <= -90 THEN {inf} ELSE {per_deg} * ({lat} - {south}) END"
    d_lon = f"least({lon} - greatest({west}, -180), least({east}, 180) - {lon})"
    gap_lon = (f"CASE WHEN {west} <= -180 AND {east} >= 180 THEN {inf}"
               f" ELSE {radius} * asin(least(1, cos(radians({lat})) * sin(radians(least({d_lon}, 90))))) END")
    return f"least({gap_n}, {gap_s}, {gap_lon})"
