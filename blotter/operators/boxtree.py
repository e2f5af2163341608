"""Nearest-site search for site tables of any size: a packed tree of bounding boxes that follows the sites.

Sites are sorted along a Morton curve of their unit vectors (x, y, z) and cut into leaves of ``LEAF`` sites, so dense places get small leaves and
empty places none; in three dimensions neither the antimeridian nor the poles are special. Each leaf has its box, one of its sites as
representative and the radius around that one. This directory has at most about ``MOST_LEAVES`` rows whatever the number of sites (leaves then hold more), so every
task can have it; the sites themselves stay distributed.

Each different location is looked up in the directory, in Arrow batches: groups of leaves first, then leaves. A leaf stays a candidate while no other site is surely
nearer: by its box (chord distance), and by the triangle inequality, distance to its representative less its radius. The second
bound uses the metric itself, so it also tells apart leaves that all lie within a per cent of a far point's distance. The (location, leaf) pairs then
meet the leaves' sites in an equi-join that spreads hot leaves (:mod:`blotter.operators.skew`), and each location keeps its minimum.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.geo import MEAN_RADIUS_KM, SPHERE_TO_ELLIPSOID_SAFETY, geodesic_distances, geodesic_km, haversine_sql, sql_double
from blotter.operators.skew import skew_join
from blotter.session import shared_dir

LEAF, MOST_LEAVES = 16, 1 << 16
#: Bounds are compared with this slack (1 mm), far above the rounding of distances.
SLACK_KM = 1e-6
_CHUNK, _PAIRS = 256, 1 << 20

# Serialised by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _axes(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    a, o = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)


def _thirds(v: Column) -> Column:
    """The low 20 bits of a number, two zero bits after each."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def site_leaves(sites: DataFrame, n_sites: int, leaf: int = LEAF, most: int = MOST_LEAVES) -> DataFrame:
    """(leaf, cands, lo, hi, rep, radius) from (lat, lon, k, p) rows: leaves along the curve, stored in the shared folder."""
    shared_dir(sites.sparkSession)
    size = max(leaf, -(-n_sites // most))
    rows = sites.withColumns(dict(zip("xyz", _axes(F.col("lat"), F.col("lon")))))
    code = F.lit(0).cast("long")
    for i, axis in enumerate("xyz"):
        cell = F.least(F.greatest(F.floor((F.col(axis) + 1) * (1 << 19)), F.lit(0)), F.lit((1 << 20) - 1)).cast("long")
        code = code.bitwiseOR(F.shiftleft(_thirds(cell), i))
    keys = ["code", "lat", "lon", "k"]
    placed = rows.withColumn("code", code).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    run = (F.col("pos") % (1 << 33) / size).cast("long")
    placed = placed.withColumn("leaf", F.shiftright("pos", 33) * (1 << 33) + run).withColumn("off", F.abs(F.col("pos") % (1 << 33) % size - size // 2)).drop("pos", "code").checkpoint(eager=True)
    box = [F.array(*[f(a) for a in "xyz"]).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"))]
    out = placed.groupBy("leaf").agg(F.collect_list(F.struct("lat", "lon", "k", "p")).alias("cands"), *box, F.min(F.struct("off", "lat", "lon")).alias("rep"))
    far = f"array_max(transform(cands, s -> {haversine_sql('rep.lat', 'rep.lon', 's.lat', 's.lon')}))"
    return out.withColumn("radius", F.expr(far)).checkpoint(eager=True)


class Directory:
    """Leaves, and groups of consecutive ones, as arrays; :meth:`near` gives the leaves that may hold a point's nearest site."""

    def __init__(self, rows: list, metric: str):
        rows = sorted(rows, key=lambda r: r["leaf"])
        self.geodesic = metric == "geodesic"
        self.leaf = np.array([r["leaf"] for r in rows], np.int64)
        self.lo, self.hi = (np.array([r[c] for r in rows], float).reshape(-1, 3) for c in ("lo", "hi"))
        self.lat, self.lon = (np.array([r["rep"][c] for r in rows], float) for c in ("lat", "lon"))
        safety = SPHERE_TO_ELLIPSOID_SAFETY if self.geodesic else 1.0
        self.safety = safety
        self.radius = np.array([r["radius"] for r in rows], float) / safety
        n = len(rows)
        self.per = max(1, math.isqrt(n))
        first = np.arange(0, n, self.per)
        self.group_lo, self.group_hi = np.minimum.reduceat(self.lo, first), np.maximum.reduceat(self.hi, first)
        middle = np.minimum(first + self.per // 2, n - 1)
        self.group_lat, self.group_lon = self.lat[middle], self.lon[middle]
        group = np.arange(n) // self.per
        self.group_radius = np.maximum.reduceat(_hav(self.lat, self.lon, self.group_lat[group], self.group_lon[group]) / safety + self.radius, first)

    def _far(self, lat1, lon1, lat2, lon2) -> np.ndarray:
        return geodesic_distances(lat1, lon1, lat2, lon2) if self.geodesic else _hav(lat1, lon1, lat2, lon2)

    def _kept(self, p, lat, lon, best, i, j, lo, hi, rep_lat, rep_lon, radius):
        """Of the pairs (point i, box j) those that may hold the nearest site; ``best`` is brought down to known distances."""
        gap = np.maximum(np.maximum(lo[j] - p[i], p[i] - hi[j]), 0)
        least = 2 * MEAN_RADIUS_KM * np.arcsin(np.minimum(1, np.sqrt((gap**2).sum(1)) / 2)) * self.safety
        np.minimum.at(best, i, _hav(lat[i], lon[i], rep_lat[j], rep_lon[j]) / self.safety)
        ok = least <= best[i] + SLACK_KM
        i, j = i[ok], j[ok]
        exact = self._far(lat[i], lon[i], rep_lat[j], rep_lon[j])
        np.minimum.at(best, i, exact)
        ok = exact - radius[j] <= best[i] + SLACK_KM
        return i[ok], j[ok]

    def near(self, lat: np.ndarray, lon: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(point, leaf id, distance that the nearest site surely doesn't exceed), a part of the points at a time."""
        groups = len(self.group_lo)
        for a in range(0, len(lat), _CHUNK):
            la, lo = lat[a : a + _CHUNK], lon[a : a + _CHUNK]
            ra, ro = np.radians(la), np.radians(lo)
            p = np.stack([np.cos(ra) * np.cos(ro), np.cos(ra) * np.sin(ro), np.sin(ra)], 1)
            best = np.full(len(la), np.inf)
            i, j = np.repeat(np.arange(len(la)), groups), np.tile(np.arange(groups), len(la))
            i, j = self._kept(p, la, lo, best, i, j, self.group_lo, self.group_hi, self.group_lat, self.group_lon, self.group_radius)
            step = max(1, _PAIRS // self.per)
            found = []
            for b in range(0, len(i), step):  # pairs are ordered by point
                x = np.repeat(i[b : b + step], self.per)
                y = (j[b : b + step, None] * self.per + np.arange(self.per)).ravel()
                inside = y < len(self.leaf)
                found.append(self._kept(p, la, lo, best, x[inside], y[inside], self.lo, self.hi, self.lat, self.lon, self.radius))
            if found:
                i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                yield i + a, self.leaf[j], best[i]


def _hav(lat1, lon1, lat2, lon2) -> np.ndarray:
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * MEAN_RADIUS_KM * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0, 1 - h)))


def _look_up(directory: Directory):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lat, lon = np.asarray(b.column(0), float), np.asarray(b.column(1), float)
            for i, leaf, most in directory.near(lat, lon):
                yield pa.RecordBatch.from_arrays([pa.array(lat[i]), pa.array(lon[i]), pa.array(leaf), pa.array(most)], names=["plat", "plon", "leaf", "most"])

    return run


def nearest_candidates(locations: DataFrame, sites: DataFrame, n_sites: int, metric: str, leaf: int = LEAF, most: int = MOST_LEAVES) -> DataFrame:
    """(plat, plon, d, k, lat, lon, p): for each different location the sites that can be nearest, with their distances.

    ``locations`` are (plat, plon) rows with finite values, ``sites`` (lat, lon, k, p) rows. The nearest site and all that are as near are among them.
    """
    leaves = site_leaves(sites, n_sites, leaf, most)
    directory = Directory(leaves.select("leaf", "lo", "hi", "rep", "radius").collect(), metric)
    pairs = locations.distinct().mapInArrow(_look_up(directory), "plat double, plon double, leaf long, most double").checkpoint(eager=True)
    met = skew_join(pairs, leaves.select(F.col("leaf").alias("of"), "cands"), [("leaf", "of")])
    scored = f"transform(cands, s -> named_struct('d', {haversine_sql('plat', 'plon', 's.lat', 's.lon')}, 'k', s.k, 'lat', s.lat, 'lon', s.lon, 'p', s.p))"
    met = met.select("plat", "plon", "most", F.expr(scored).alias("c"))
    safety, slack = sql_double(SPHERE_TO_ELLIPSOID_SAFETY if metric == "geodesic" else 1.0), sql_double(SLACK_KM)
    # the bound is made once a leaf: as a field of a lambda's argument it isn't made again for each site
    bound = f"least(most, array_min(transform(c, s -> s.d)) / {safety}) + {slack}"
    near = f"flatten(transform(array(named_struct('c', c, 'm', {bound})), z -> filter(z.c, s -> s.d * {safety} <= z.m)))"
    rows = met.select("plat", "plon", F.expr(f"inline({near})"))
    if metric == "geodesic":
        rows = rows.select("plat", "plon", geodesic_km("plat", "plon", "lat", "lon").alias("d"), "k", "lat", "lon", "p")
    return rows


def nearest_rows(points: DataFrame, sites: DataFrame, n_sites: int, metric: str, ties: bool, with_cands: bool, leaf: int = LEAF, most: int = MOST_LEAVES) -> DataFrame:
    """``points`` (with __plat and __plon) and their ``__pick``, and ``__cands`` if asked for: the sites compared in the end.

    Equal locations are looked up once. Points without finite coordinates get nulls.
    """
    shared_dir(points.sparkSession)
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("__plat", "__plon")]
    locations = points.where(finite[0] & finite[1]).select(F.col("__plat").alias("plat"), F.col("__plon").alias("plon"))
    near = nearest_candidates(locations, sites, n_sites, metric, leaf, most)
    pick = F.struct("d", "k", "lat", "lon", "p")
    if ties or with_cands:
        near = near.checkpoint(eager=True)
    # checkpointed, as a join splits hot keys of stored sides only
    chosen = near.groupBy("plat", "plon").agg(F.min(pick).alias("__pick"), *([F.sort_array(F.collect_list(pick)).alias("__cands")] if with_cands else []))
    if ties:
        top = chosen.select(F.col("plat").alias("a"), F.col("plon").alias("b"), F.col("__pick.d").alias("m"), *(["__cands"] if with_cands else []))
        same = (F.col("plat") == F.col("a")) & (F.col("plon") == F.col("b")) & (F.col("d") == F.col("m"))
        chosen = near.join(top, same).select("plat", "plon", pick.alias("__pick"), *(["__cands"] if with_cands else []))
    return skew_join(points, chosen.checkpoint(eager=True), [("__plat", "plat"), ("__plon", "plon")], "left")
