"""Distance from incidents to facilities: the assigned one, or the nearest one.

``assigned_distance``  joins each point to its responsible site by key (an
equi-join over the key's spellings) and averages the distance per group.

``nearest_facility``   finds each point's nearest site exactly, without a
Cartesian product. Sites are indexed on a pyramid of grids (cell sizes
g, 8g, 64g, ... and finally one cell for the whole globe). At level i a
point looks up the sites in the 3x3 block of cells around its own cell and
takes the closest one; it accepts that answer only when it is strictly
closer than a lower bound on the distance from the point to anything outside
the block. Otherwise the next, coarser level is consulted; the last level
holds every site, so every point is answered and the answer is exact.

Only unresolved points probe coarser levels: their join keys are null once
resolved, so the lookups cost nothing for the rest. With a site table of
proven size the level tables are broadcast and the whole search is one
map-side stage with no shuffle of the points. Beyond that bound the sites
go into a tree of bounding boxes (:mod:`blotter.operators.boxtree`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.geo import (
    SPHERE_TO_ELLIPSOID_SAFETY,
    block_lower_bound_sql,
    geodesic_array_km,
    haversine_km,
    haversine_sql,
    sql_double,
    with_geodesic_km,
)
from blotter.operators.boxtree import nearest_rows
from blotter.operators.joins import DEFAULT_BROADCAST_BYTES, key_spellings_join, measured_bytes, row_bytes
from blotter.operators.layout import spread

# Sites per broadcast: each of ~9 pyramid levels holds every site about 9
# times, so 20k sites stay below ~100 MB of broadcast state.
DEFAULT_MAX_BROADCAST_SITES = 20_000
# Bytes of those sites' rows with their payload; the level tables hold each row some 80 times.
DEFAULT_MAX_SITE_BYTES = 4 << 20

# A site can beat the haversine-nearest one on the ellipsoid only if its
# haversine distance is within this ratio of the minimum (both metrics agree
# to better than 1 %).
_GEODESIC_PRUNE_RATIO = 1.01 / 0.99
_EPS_KM = 1e-9
_INF = float("inf")


# ---------------------------------------------------------------------------
# assigned facility
# ---------------------------------------------------------------------------

def _distance_column(df: DataFrame, out: str, lat: str, lon: str, site_lat: str, site_lon: str,
                     metric: str) -> DataFrame:
    if metric == "haversine":
        return df.withColumn(out, haversine_km(lat, lon, site_lat, site_lon))
    if metric == "geodesic":
        return with_geodesic_km(df, out, lat, lon, site_lat, site_lon)
    raise ValueError(f"unknown metric {metric!r}")


def assign_sites(points: DataFrame, sites: DataFrame, *, point_key: str, site_key: str,
                 pad: str | None = "0", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """points JOIN sites ON point_key = site_key OR point_key = pad || site_key.

    Planned as one equi-join over the distinct spellings of each site key
    (no nested loop). The site side is broadcast only when proven small.
    """
    spellings = [F.col(site_key)]
    if pad:
        spellings.append(F.concat(F.lit(pad), F.col(site_key)))
    small = measured_bytes(sites) * len(spellings) <= max_broadcast_bytes
    return key_spellings_join(points, sites, point_key, spellings, "inner", broadcast_right=small)


def assigned_distance(points: DataFrame, sites: DataFrame, *, by: str | Sequence[str], point_key: str = "area",
                      site_key: str = "prec", pad: str | None = "0", lat: str = "lat", lon: str = "lon",
                      site_lat: str = "y", site_lon: str = "x", metric: str = "geodesic",
                      count_col: str = "crime_total", avg_col: str = "average_distance",
                      max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, partitions: int | None = None) -> DataFrame:
    """Per group: joined rows and the mean distance to the assigned site, over the same rows.

    Only the key, coordinate and ``by`` columns of either side are carried. ``partitions`` spreads the points, for an
    input that one split holds.
    """
    by = [by] if isinstance(by, str) else list(by)
    own = [c for c in by if c in points.columns]
    points = spread(points.select(*dict.fromkeys([point_key, lat, lon, *own])), partitions)
    sites = sites.select(*dict.fromkeys([site_key, site_lat, site_lon, *(c for c in by if c not in own)]))
    joined = assign_sites(points, sites, point_key=point_key, site_key=site_key, pad=pad, max_broadcast_bytes=max_broadcast_bytes)
    with_d = _distance_column(joined, "__distance", lat, lon, site_lat, site_lon, metric)
    return with_d.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col), F.avg("__distance").alias(avg_col))


# ---------------------------------------------------------------------------
# nearest facility
# ---------------------------------------------------------------------------

def _norm_lon(c: Column) -> Column:
    """Longitude wrapped into [-180, 180)."""
    return F.pmod(c + 180.0, F.lit(360.0)) - 180.0


def _cells(lat: Column, lon: Column, g: float | None) -> tuple[Column, Column]:
    if g is None:  # the global level: a single cell, but not a foldable constant
        return F.floor((lon + 180.0) / 1e12), F.floor((lat + 90.0) / 1e12)
    return F.floor((lon + 180.0) / g), F.floor((lat + 90.0) / g)


# (level, cell x, cell y) packed into one long: 2^21 cells per axis covers
# the finest allowed cell size (1e-3 degrees) around the globe.
_AXIS = 1 << 21


def _cell_key(level: int, cx: Column, cy: Column) -> Column:
    return (F.lit(level).cast("long") * _AXIS + cx) * _AXIS + cy


def _pyramid(g0: float, factor: float = 8.0) -> list[float | None]:
    levels: list[float | None] = []
    g = g0
    while g < 180.0:
        levels.append(g)
        g *= factor
    levels.append(None)
    return levels


def _level_table(sites: DataFrame, levels: list[float | None]) -> DataFrame:
    """cell key (level, x, y) -> sites in the 3x3 block of cells around that cell.

    All levels live in one table keyed by one long, so a single broadcast
    serves every probe (the planner reuses the exchange).
    """
    site = F.struct("lat", "lon", "k", "p").alias("site")
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    parts = []
    for i, g in enumerate(levels):
        cx, cy = _cells(F.col("lat"), F.col("lon"), g)
        if g is None:
            placed = sites.select(_cell_key(i, cx, cy).alias("key"), site)
        else:
            placed = sites.select(cx.alias("x0"), cy.alias("y0"), site, F.explode(offsets).alias("o")).select(
                _cell_key(i, F.col("x0") + F.col("o.dx"), F.col("y0") + F.col("o.dy")).alias("key"), "site")
        parts.append(placed)
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionByName(part)
    return placed.groupBy("key").agg(F.collect_list("site").alias("cands"))


def _scored_sql(arr: str) -> str:
    """Candidates as (d, k, lat, lon, p) structs, d by haversine: array_min orders by d, then k."""
    dist = haversine_sql("__plat", "__plon", "__s.lat", "__s.lon")
    return (f"transform({arr}, __s -> named_struct('d', {dist}, 'k', __s.k, 'lat', __s.lat,"
            f" 'lon', __s.lon, 'p', __s.p))")


def _cell_key_sql(i: int, g: float | None) -> str:
    gs = sql_double(1e12 if g is None else g)
    return (f"((CAST({i} AS BIGINT) * {_AXIS} + floor((__plon + 180) / {gs})) * {_AXIS}"
            f" + floor((__plat + 90) / {gs}))")


def _prepare_sites(sites: DataFrame, site_id: str, site_lat: str, site_lon: str,
                   site_cols: Sequence[str]) -> DataFrame:
    payload = [F.col(c) for c in site_cols] or [F.lit(None).cast("string").alias("__none")]
    rows = sites.select(
        F.col(site_lat).cast("double").alias("lat"),
        _norm_lon(F.col(site_lon).cast("double")).alias("lon"),
        F.col(site_id).alias("k"),
        F.struct(*payload).alias("p"),
    )
    # a comparison with NaN is false, as one with null is not true
    return rows.filter("lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")


def _default_cell_deg(sites: DataFrame) -> tuple[int, int, float]:
    """Site count, bytes of the rows, and a cell size of about one site per cell where the sites are.

    The extent is that of the middle nine tenths in each direction, so single far sites don't stretch the cells.
    """
    middle = [0.05, 0.95]
    row = sites.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(sites)).alias("size"), F.percentile_approx("lat", middle, 1000).alias("a"), F.percentile_approx("lon", middle, 1000).alias("o")).first()
    n = int(row["n"])
    if n == 0:
        return 0, 0, 1.0
    span_lat, span_lon = (max(x[1] - x[0], 0.01) for x in (row["a"], row["o"]))
    return n, int(row["size"]), min(max(math.sqrt(span_lat * span_lon / n), 1e-3), 45.0)


def nearest_facility(points: DataFrame, sites: DataFrame, *, lat: str = "lat", lon: str = "lon",
                     site_id: str = "site_id", site_lat: str = "y", site_lon: str = "x",
                     site_cols: Sequence[str] = (), metric: str = "geodesic", ties: bool = False,
                     cell_deg: float | None = None, distance_col: str = "distance_km",
                     candidates_col: str | None = None,
                     max_broadcast_sites: int = DEFAULT_MAX_BROADCAST_SITES, max_site_bytes: int = DEFAULT_MAX_SITE_BYTES,
                     partitions: int | None = None) -> DataFrame:
    """Each point with its nearest site (``site_id``, ``site_cols``, ``distance_col``).

    Equal distances are broken by the smaller ``site_id``. With ``ties=True``
    a point gets one row per site at the minimal distance instead. Points
    without coordinates, or when there are no sites, get nulls (one row).
    ``candidates_col`` (optional) keeps the sites that were compared in the
    end, as an array of (d, k, lat, lon, p) structs. Any column names of the
    points are kept. ``partitions`` spreads the points, for an input that one
    split holds.
    """
    s = _prepare_sites(sites, site_id, site_lat, site_lon, site_cols)
    n_sites, site_bytes, auto_g = _default_cell_deg(s)
    g0 = cell_deg or auto_g
    levels = _pyramid(g0)
    broadcast = n_sites <= max_broadcast_sites and site_bytes <= max_site_bytes
    table = _level_table(s, levels) if broadcast else None
    slack = 1.0 if metric == "haversine" else 1.0 / SPHERE_TO_ELLIPSOID_SAFETY
    if metric not in ("haversine", "geodesic"):
        raise ValueError(f"unknown metric {metric!r}")

    plat = F.col(lat).cast("double")
    plon = _norm_lon(F.col(lon).cast("double"))
    columns = points.columns
    # the caller's columns travel inside one struct, so no name of theirs can meet one of the search
    packed = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("__row")
    base = spread(points, partitions).select(packed, plat.alias("__plat"), plon.alias("__plon"))
    if broadcast:
        found = _search_broadcast(base, table, levels, slack)
        out = _finish(found, metric, ties)
    else:
        out = nearest_rows(base, s, n_sites, metric, ties, bool(candidates_col))
    values = {site_id: F.col("__pick.k"), distance_col: F.col("__pick.d"), **{c: F.col("__pick.p")[c] for c in site_cols}}
    if candidates_col:
        values[candidates_col] = F.col("__cands")
    return out.select(*(F.col(f"__row.`{c}`") for c in columns if c not in values), *(v.alias(k) for k, v in values.items()))


def _probe(df: DataFrame, table: DataFrame, i: int, g: float | None, slack: float,
           resolved: str | None) -> DataFrame:
    """Join level i's candidates; __b{i} = haversine-nearest, __ok{i} = answer proven.

    Points already answered probe with a null key (no match, no work). The
    level is accepted when slack * (haversine minimum) is below the lower
    bound for everything outside the block; slack covers the ellipsoid when
    the metric is geodesic.
    """
    key = _cell_key_sql(i, g)
    if resolved is not None:
        key = f"CASE WHEN NOT ({resolved}) THEN {key} END"
    t = table.alias(f"__L{i}")
    joined = df.join(t, F.expr(key) == F.col(f"__L{i}.key"), "left")
    joined = joined.select(*[df[c] for c in df.columns], F.col(f"__L{i}.cands").alias(f"__c{i}"),
                           F.expr(f"array_min({_scored_sql(f'__L{i}.cands')})").alias(f"__b{i}"))
    lb = sql_double(math.inf) if g is None else block_lower_bound_sql("__plat", "__plon", g)
    return joined.withColumn(f"__ok{i}", F.expr(f"coalesce(__b{i}.d * {sql_double(slack)} < {lb}, false)"))


def _search_broadcast(df: DataFrame, table: DataFrame, levels: list, slack: float) -> DataFrame:
    table = F.broadcast(table)
    resolved = None
    for i, g in enumerate(levels):
        df = _probe(df, table, i, g, slack, resolved)
        resolved = f"__ok{i}" if resolved is None else f"{resolved} OR __ok{i}"
    n = len(levels)
    return df.select(
        "__row", "__plat", "__plon",
        F.coalesce(*[F.when(F.col(f"__ok{i}"), F.col(f"__b{i}")) for i in range(n)]).alias("__hbest"),
        F.coalesce(*[F.when(F.col(f"__ok{i}"), F.col(f"__c{i}")) for i in range(n)]).alias("__cands"),
    )


def _finish(df: DataFrame, metric: str, ties: bool) -> DataFrame:
    """From the answering level's candidates to ``__cands`` (those compared in the end) and ``__pick``.

    Haversine: the search result is final. Geodesic: only sites within the
    pruning ratio of the haversine minimum can be nearest on the ellipsoid;
    the geodesic is solved for those few.
    """
    ratio = "1E0" if metric == "haversine" else sql_double(_GEODESIC_PRUNE_RATIO)
    bound = f"__hbest.d * {ratio} + {sql_double(_EPS_KM)}"
    df = df.withColumn("__near", F.expr(f"filter({_scored_sql('__cands')}, __x -> __x.d <= {bound})"))
    if metric == "geodesic":
        exact = geodesic_array_km("__plat", "__plon", F.expr("transform(__near, __x -> __x.lat)"), F.expr("transform(__near, __x -> __x.lon)"))
        df = df.withColumn("__exact", exact).withColumn("__near", F.expr(
            "zip_with(__near, __exact, (__x, __g) -> named_struct('d', __g, 'k', __x.k, 'lat', __x.lat, 'lon', __x.lon, 'p', __x.p))"))
    df = df.withColumn("__cands", F.col("__near")).withColumn("__best", F.array_min("__near"))
    if ties:
        return df.withColumn("__pick", F.explode_outer(F.expr("filter(__cands, __x -> __x.d = __best.d)")))
    return df.withColumn("__pick", F.col("__best"))


def nearest_distance(points: DataFrame, sites: DataFrame, *, by: str | Sequence[str], id_col: str | None = None,
                     count_col: str = "crime_total", avg_col: str = "average_distance", **kwargs) -> DataFrame:
    """Per group: points and the mean distance to their nearest site.

    ``by`` may name point columns (e.g. ``year``) or site columns passed in
    ``site_cols`` (e.g. the nearest site's ``division``). With ``id_col`` the
    points are first reduced to one row per id (minimum distance, minimum of
    the ``by`` values), as when an id can occur on several rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    distance_col = kwargs.pop("distance_col", "distance_km")
    near = nearest_facility(points, sites, distance_col=distance_col, **kwargs).filter(
        F.col(distance_col).isNotNull()
    )
    if id_col:
        near = near.groupBy(id_col).agg(F.min(distance_col).alias(distance_col), *[F.min(b).alias(b) for b in by])
    return near.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col), F.avg(distance_col).alias(avg_col))
