"""The query catalogue: one callable per operator key, over the benchmark tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; the SQL
oracle for the same key lives in :mod:`blotter.oracle`. Double results are
rounded to 6 decimals so that two engines hash them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.clean import clean_money, zip_prefix
from blotter.functions.geo import haversine_km, with_geodesic_km
from blotter.functions.labels import code_to_label, label_case_sql
from blotter.functions.timeparts import format_us_timestamp, parse_us_timestamp, year_range
from blotter.functions.udfs import daypart_udf
from blotter.operators.dayparts import daypart_counts, hour_prefix_counts, reduce_by_key
from blotter.operators.facilities import assign_sites, assigned_distance, nearest_distance, nearest_facility
from blotter.operators.joins import disjunctive_join, key_spellings_join, union_of_equi_joins, with_join_hint
from blotter.operators.periods import period_counts, top_periods
from blotter.operators.ranking import number_rows, top_rows
from blotter.operators.zones import extreme_zone_counts, extreme_zone_totals, zone_incomes
from blotter.plans.compare import join_table
from blotter.operators.reuse import Reuse
from blotter.operators.skew import skew_join
from blotter.session import delete_path, scratch_path, shared_dir
from blotter.sources import tables as T
from blotter.sources.incidents import (
    INCIDENT_COLUMNS,
    INCIDENT_HEADER,
    load_incidents,
    load_incidents_text,
    read_incidents_by_header,
    typed_incidents,
    write_incident_csv,
)
from blotter.sources.layouts import CORRUPT, malformed_counts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the catalogue queries (the reference's values where they map).
TOP_K = 3
ZONE_YEAR = 1998          # the year whose incidents are placed in zones
EXPORT_SPLIT_YEAR = 1998  # older file: occurred before this year
STREET = "error"          # premise value counted by the part-of-day queries
METRIC = "geodesic"


def _r6(c) -> F.Column:
    return F.round(c if isinstance(c, F.Column) else F.col(c), 6)


# --- sources ---------------------------------------------------------------

def incident_export_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents in the 28-column string layout of the incident files."""
    i = T.incidents_with_area(spark, sf_dir)
    k = F.col("incident_id")
    cols = {c: F.lit(None).cast("string") for c in INCIDENT_COLUMNS}
    cols.update({
        "incident_id": k.cast("string"),
        "reported_raw": F.when(k % 50 == 0, F.lit("not a date")).otherwise(format_us_timestamp("reported_on")),
        "occurred_raw": format_us_timestamp("occurred_on"),
        "hhmm": F.when(k % 89 != 0, F.lpad(((k * 37) % 2400).cast("string"), 4, "0")),
        "area": F.col("area"),
        "victim_age_raw": F.when(k % 53 == 0, F.lit("n/a")).otherwise((k % 90).cast("string")),
        "victim_code": F.col("victim_code"),
        "premise": F.when(k % 41 == 0, F.lit("SHOP, INDOOR")).otherwise(F.col("premise")),
        "weapon_code": F.col("weapon_code"),
        "lat_raw": F.col("lat").cast("string"),
        "lon_raw": F.col("lon").cast("string"),
        "occurred_year": F.year("occurred_on"),
    })
    return i.select(*[v.alias(n) for n, v in cols.items()])


_EXPORTS: dict[tuple, list[str]] = {}


def export_incident_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The older and the newer incident file below the shared folder, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EXPORTS:
        frame = incident_export_frame(spark, sf_dir)
        base = scratch_path(spark, "incidents")
        older, newer = f"{base}/older", f"{base}/newer"
        write_incident_csv(frame.filter(F.col("occurred_year") < EXPORT_SPLIT_YEAR), older, area_header="AREA ")
        write_incident_csv(frame.filter(F.col("occurred_year") >= EXPORT_SPLIT_YEAR), newer, area_header="AREA")
        _EXPORTS[key] = [older, newer]
    return _EXPORTS[key]


def export_multiline_file(spark: SparkSession, sf_dir: str) -> list[str]:
    """All incidents in one layout, with line breaks, commas and quotes inside some premises."""
    key = (spark.sparkContext.applicationId, sf_dir, "multiline")
    if key not in _EXPORTS:
        k = F.col("incident_id").cast("long")
        place = F.when(k % 7 == 0, F.concat(F.lit("ROOM "), k % 13, F.lit(",\nFLOOR ")  , k % 3, F.lit("\n\nREAR"))).when(k % 11 == 0, F.lit('SO-CALLED "YARD",\nGATE')).otherwise(F.col("premise"))
        base = scratch_path(spark, "incidents-multiline")
        write_incident_csv(incident_export_frame(spark, sf_dir).withColumn("premise", place), base)
        _EXPORTS[key] = [base]
    return _EXPORTS[key]


def export_mixed_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two layouts: older incidents in the usual order, newer ones with their columns turned round and two of them left out.

    The newer folder has a further file of the usual layout whose records have too few or too many values.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "mixed")
    if key not in _EXPORTS:
        frame = incident_export_frame(spark, sf_dir)
        base = scratch_path(spark, "incidents-mixed")
        older, newer = f"{base}/older", f"{base}/newer"
        late = F.col("occurred_year") >= EXPORT_SPLIT_YEAR
        write_incident_csv(frame.filter(~late), older, area_header="AREA ")
        turned = [(c, h) for c, h in reversed(list(zip(INCIDENT_COLUMNS, INCIDENT_HEADER))) if c not in ("extra_1", "extra_2")]
        frame.filter(late).select(*[F.col(c).alias(h) for c, h in turned]).write.option("header", True).csv(newer)
        bad = frame.filter(late & (F.col("incident_id").cast("long") % 29 == 0))
        values = F.when(F.col("incident_id").cast("long") % 2 == 0, F.lit(",too,few")).otherwise(F.lit("," * 40))
        lines = bad.select(F.lit(1).alias("o"), F.concat(F.lit("9"), "incident_id", values).alias("value"))
        head = spark.range(1).select(F.lit(0).alias("o"), F.lit(",".join(INCIDENT_HEADER)).alias("value"))
        head.union(lines).coalesce(1).sortWithinPartitions("o").select("value").write.mode("append").text(newer)
        _EXPORTS[key] = [older, newer]
    return _EXPORTS[key]


def drop_exports(spark: SparkSession) -> None:
    """Remove this session's exported files."""
    for key in [k for k in _EXPORTS if k[0] == spark.sparkContext.applicationId]:
        for path in _EXPORTS.pop(key):
            delete_path(spark, path)


def q_csv_scan(spark, d):
    return load_incidents(spark, export_incident_files(spark, d))


def q_text_scan_from_csv(spark, d):
    return load_incidents_text(spark, export_incident_files(spark, d))


def q_text_scan_multiline(spark, d):
    return load_incidents_text(spark, export_multiline_file(spark, d), multiline=True)


def q_csv_scan_by_header(spark, d):
    """The incidents of both layouts; the malformed records, which have ids of their own, are left out here."""
    rows = read_incidents_by_header(spark, export_mixed_files(spark, d))
    return typed_incidents(rows.filter(F.col(CORRUPT).isNull()))


def q_malformed_counts(spark, d):
    """Rows and malformed rows of each file, added up per folder."""
    files = malformed_counts(read_incidents_by_header(spark, export_mixed_files(spark, d)))
    folder = F.regexp_extract("file", "/(older|newer)/[^/]*$", 1).alias("folder")
    return files.groupBy(folder).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_malformed").alias("n_malformed"))


def q_load_count(spark, d):
    return load_incidents(spark, export_incident_files(spark, d)).agg(F.count(F.lit(1)).alias("n_rows"))


def q_union_all(spark, d):
    i = T.incidents(spark, d).select("incident_id", "occurred_on")
    cut = F.lit(f"{EXPORT_SPLIT_YEAR}-01-01").cast("date")
    return i.filter(F.col("occurred_on") < cut).unionByName(i.filter(F.col("occurred_on") >= cut))


def q_union_distinct(spark, d):
    i = T.incidents(spark, d).select("victim_code", "weapon_code", "occurred_on")
    cut = F.lit(f"{EXPORT_SPLIT_YEAR}-01-01").cast("date")
    a = i.filter(F.col("occurred_on") < cut).select("victim_code", "weapon_code")
    b = i.filter(F.col("occurred_on") >= cut).select("victim_code", "weapon_code")
    return a.union(b).distinct()


# --- projection and typing -------------------------------------------------

def q_typed_projection(spark, d):
    o = T.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("incident_id"),
        F.col("o_totalprice").cast("string").try_cast("double").alias("total_price"),
        F.date_format("o_orderdate", "yyyy").try_cast("int").alias("year"),
        F.col("o_orderstatus").alias("status"),
    )


def q_parse_us_timestamp(spark, d):
    o = T.table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = F.when(k % 50 == 0, F.lit("not a date")).otherwise(format_us_timestamp("o_orderdate"))
    return o.select(k.alias("incident_id"), parse_us_timestamp(raw).alias("occurred_on"))


# --- filters ---------------------------------------------------------------

def q_filter_eq(spark, d):
    return T.timed_events(spark, d).filter(F.col("premise") == STREET).select("incident_id", "hhmm")


def q_filter_not_null(spark, d):
    return T.incidents(spark, d).filter(F.col("weapon_code").isNotNull()).select("incident_id", "weapon_code")


def q_filter_null_island(spark, d):
    i = T.incidents(spark, d)
    return i.filter((F.col("lat") != 0) & (F.col("lon") != 0)).select("incident_id", "lat", "lon")


def q_filter_prefix(spark, d):
    i = T.incidents(spark, d)
    return i.filter(F.substring("weapon_code", 1, 1) == "1").select("incident_id", "weapon_code")


def q_filter_like(spark, d):
    return spark.sql(
        "SELECT incident_id, weapon_code FROM {i} WHERE weapon_code LIKE '1%'", i=T.incidents(spark, d)
    )


def q_filter_year(spark, d):
    i = T.incidents(spark, d)
    return (
        i.filter(F.col("victim_code").isNotNull())
        .filter(year_range("occurred_on", ZONE_YEAR))
        .select("incident_id", "occurred_on", "victim_code")
    )


# --- scalar cleaning -------------------------------------------------------

def q_zip_prefix(spark, d):
    return T.geocode(spark, d).select("lat", "lon", "zip", zip_prefix("zip").alias("zip5"))


def q_clean_money(spark, d):
    return T.income(spark, d).select("zip", "income_raw", clean_money("income_raw").alias("income"))


def q_code_to_label(spark, d):
    i = T.incidents(spark, d)
    return i.select("incident_id", "victim_code", code_to_label("victim_code").alias("victim_descent"))


# --- periods ---------------------------------------------------------------

def q_monthly_counts(spark, d):
    return period_counts(T.incidents(spark, d), "occurred_on")


def q_top_months_per_year(spark, d):
    return top_periods(T.incidents(spark, d), "occurred_on", k=TOP_K)


def q_top_months_per_year_sql(spark, d):
    return spark.sql(
        f"""
        WITH months AS (
          SELECT trunc(occurred_on, 'MM') AS first_day, count(*) AS crime_total FROM {{i}} GROUP BY 1
        ), placed AS (
          SELECT first_day, crime_total, rank() OVER (PARTITION BY year(first_day) ORDER BY crime_total DESC) AS rank FROM months
        )
        SELECT year(first_day) AS year, month(first_day) AS month, crime_total, rank FROM placed WHERE rank <= {TOP_K}
        """,
        i=T.incidents(spark, d),
    )


def q_months_named_windows_sql(spark, d):
    """Every month with its rank, its place (ties broken) and the running total, over two windows of one WINDOW clause."""
    return spark.sql(
        """
        WITH months AS (
          SELECT year(occurred_on) AS year, month(occurred_on) AS month, count(*) AS crime_total FROM {i} GROUP BY 1, 2
        )
        SELECT year, month, crime_total,
               rank() OVER busy AS rank, row_number() OVER placed AS place, sum(crime_total) OVER placed AS running_total
        FROM months
        WINDOW busy AS (PARTITION BY year ORDER BY crime_total DESC),
               placed AS (PARTITION BY year ORDER BY crime_total DESC, month ROWS UNBOUNDED PRECEDING)
        """,
        i=T.incidents(spark, d),
    )


def q_top_days_per_weapon(spark, d):
    """The busiest days of each weapon code: ranked and placed over named windows, at most TOP_K places a code."""
    days = T.incidents(spark, d).groupBy("weapon_code", "occurred_on").agg(F.count(F.lit(1)).alias("crime_total"))
    return top_rows(days, ["weapon_code"], [("crime_total", "desc")], TOP_K, tie_break=["occurred_on"])


def q_incidents_numbered(spark, d):
    """All incidents numbered within their weapon code, newest first; days share a rank."""
    i = T.incidents(spark, d).select("incident_id", "weapon_code", "occurred_on")
    return number_rows(i, ["weapon_code"], [("occurred_on", "desc")], tie_break=["incident_id"])


# --- part of day -----------------------------------------------------------

def q_daypart_counts(spark, d):
    return daypart_counts(T.timed_events(spark, d), "hhmm", where=F.col("premise") == STREET)


def q_daypart_counts_sql(spark, d):
    return spark.sql(
        f"""
        SELECT period_of_day, count(*) AS crime_total FROM (
          SELECT CASE
                   WHEN try_cast(hhmm AS INT) BETWEEN 500 AND 1159 THEN '05:00-11:59'
                   WHEN try_cast(hhmm AS INT) BETWEEN 1200 AND 1659 THEN '12:00-16:59'
                   WHEN try_cast(hhmm AS INT) BETWEEN 1700 AND 2059 THEN '17:00-20:59'
                   WHEN try_cast(hhmm AS INT) BETWEEN 0 AND 459
                     OR try_cast(hhmm AS INT) BETWEEN 2100 AND 2359 THEN '21:00-03:59'
                   ELSE 'Null' END AS period_of_day
          FROM {{e}} WHERE premise = '{STREET}')
        GROUP BY period_of_day
        ORDER BY crime_total DESC, period_of_day
        """,
        e=T.timed_events(spark, d),
    )


def q_daypart_counts_isin(spark, d):
    return hour_prefix_counts(T.timed_events(spark, d), "hhmm", where=F.col("premise") == STREET)


def q_reduce_by_key(spark, d):
    e = T.table(spark, d, "events")
    return reduce_by_key(e, "event_type", "value").select("event_type", _r6("total").alias("total"))


# --- joins -----------------------------------------------------------------

def _zone_income_rows(spark, d) -> DataFrame:
    return T.income(spark, d).select(F.col("zip").alias("zone_zip"), clean_money("income_raw").alias("income"))


def q_inner_join_expr(spark, d):
    g = T.geocode(spark, d)
    inc = _zone_income_rows(spark, d)
    return g.join(inc, g["zip"] == inc["zone_zip"], "inner").select("lat", "lon", "zip", "income")


def q_inner_join_using(spark, d):
    zones = zone_incomes(T.income(spark, d).select("zip", clean_money("income_raw").alias("income")))
    return T.geocode(spark, d).join(zones, "zip").select("lat", "lon", "zip", "income")


def q_inner_join_multi_key(spark, d):
    i = T.incidents(spark, d).alias("i")
    g = T.geocode(spark, d).alias("g")
    cond = (F.col("i.lat") == F.col("g.lat")) & (F.col("i.lon") == F.col("g.lon"))
    return i.join(g, cond, "inner").select(F.col("i.incident_id"), F.col("g.zip"))


def q_left_join_multi_key(spark, d):
    i = T.incidents(spark, d).alias("i")
    g = T.geocode(spark, d).alias("g")
    cond = (F.col("i.lat") == F.col("g.lat")) & (F.col("i.lon") == F.col("g.lon"))
    return i.join(g, cond, "left").select(F.col("i.incident_id"), F.col("g.zip"))


def q_left_join_skewed(spark, d):
    """The left join on two keys with its hot keys (Null Island, a popular corner) spread over several tasks."""
    i = T.incidents(spark, d).select("incident_id", "lat", "lon")
    g = T.geocode(spark, d).select(F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon"), "zip")
    return skew_join(i, g, [("lat", "g_lat"), ("lon", "g_lon")], "left").select("incident_id", "zip")


def q_inner_join_skewed(spark, d):
    """Incidents of customers by area: a join on one key, with hot areas spread."""
    i = T.incidents_with_area(spark, d).select("incident_id", F.col("area").cast("int").alias("area_no"))
    s = T.stations(spark, d).select("site_id", "division")
    return skew_join(i, s, [("area_no", "site_id")]).select("incident_id", "division")


# --- zones -----------------------------------------------------------------

def _income_clean(spark, d) -> DataFrame:
    return T.income(spark, d).select("zip", clean_money("income_raw").alias("income"))


def q_min_income_per_zone(spark, d):
    return zone_incomes(_income_clean(spark, d))


def q_bottom_k(spark, d):
    return zone_incomes(_income_clean(spark, d)).orderBy(F.col("income").asc(), "zip").limit(TOP_K)


def q_top_k(spark, d):
    return zone_incomes(_income_clean(spark, d)).orderBy(F.col("income").desc(), "zip").limit(TOP_K)


def _zone_facts(spark, d) -> DataFrame:
    return T.incidents(spark, d).filter(year_range("occurred_on", ZONE_YEAR))


def q_income_extremes(spark, d):
    return extreme_zone_counts(_zone_facts(spark, d), T.geocode(spark, d), _income_clean(spark, d), k=TOP_K)


def q_income_extremes_cached(spark, d):
    """The per-zone counts cached while the (small) result is made and stored, then released."""
    shared_dir(spark)
    with Reuse() as reuse:
        counts = extreme_zone_counts(_zone_facts(spark, d), T.geocode(spark, d), _income_clean(spark, d), k=TOP_K, reuse=reuse)
        return counts.checkpoint(eager=True)


def q_income_extremes_total(spark, d):
    return extreme_zone_totals(q_income_extremes(spark, d))


def q_income_extremes_sql(spark, d):
    label = label_case_sql("p.victim_code")
    return spark.sql(
        f"""
        WITH facts AS (
          SELECT lat, lon, victim_code FROM {{i}}
          WHERE victim_code IS NOT NULL
            AND occurred_on >= DATE'{ZONE_YEAR}-01-01' AND occurred_on < DATE'{ZONE_YEAR + 1}-01-01'),
        per_zone AS (
          SELECT g.zip, f.victim_code, count(*) AS n
          FROM facts f JOIN {{g}} g ON f.lat = g.lat AND f.lon = g.lon
          WHERE g.zip IS NOT NULL
          GROUP BY g.zip, f.victim_code),
        zone_income AS (
          SELECT zip, min(income) AS income FROM {{inc}}
          WHERE zip IS NOT NULL AND income IS NOT NULL GROUP BY zip),
        relevant AS (
          SELECT * FROM zone_income z WHERE EXISTS (SELECT 1 FROM per_zone p WHERE p.zip = z.zip)),
        extremes AS (
          (SELECT zip, 'highest' AS side FROM relevant ORDER BY income DESC, zip LIMIT {TOP_K})
          UNION ALL
          (SELECT zip, 'lowest' AS side FROM relevant ORDER BY income ASC, zip LIMIT {TOP_K}))
        SELECT e.side, p.victim_code, {label} AS victim_descent, sum(p.n) AS crime_total
        FROM per_zone p JOIN extremes e ON p.zip = e.zip
        GROUP BY e.side, p.victim_code
        ORDER BY side, crime_total DESC, victim_code
        """,
        i=T.incidents(spark, d),
        g=T.geocode(spark, d),
        inc=_income_clean(spark, d),
    )


# --- facilities ------------------------------------------------------------

def _located(spark, d, with_area: bool = True) -> DataFrame:
    i = T.incidents_with_area(spark, d) if with_area else T.incidents(spark, d)
    return i.filter((F.col("lat") != 0) & (F.col("lon") != 0)).withColumn("year", F.year("reported_on"))


def _cores(spark) -> int:
    """The tables here are single splits: their points are dealt to all cores."""
    return spark.sparkContext.defaultParallelism


def _firearm(df: DataFrame) -> DataFrame:
    return df.filter(F.col("weapon_code").startswith("1"))


def _armed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("weapon_code").isNotNull())


def q_or_join(spark, d):
    i = T.incidents_with_area(spark, d)
    s = T.stations(spark, d)
    joined = key_spellings_join(i, s, "area", [s["prec"], F.concat(F.lit("0"), s["prec"])], "inner",
                                broadcast_right=False)
    return joined.select("incident_id", "site_id", "division")


def q_or_join_rewritten(spark, d):
    i = T.incidents_with_area(spark, d)
    s = T.stations(spark, d)
    return union_of_equi_joins(i, s, "area", [s["prec"], F.concat(F.lit("0"), s["prec"])]).select(
        "incident_id", "site_id", "division"
    )


def q_or_join_disjoint(spark, d):
    """A left join on three conditions that can hold at once: two spellings of the area, or an urgent incident of the customer's station."""
    i = T.incidents_with_area(spark, d).select("incident_id", "area", "weapon_code", F.pmod("o_custkey", F.lit(60)).alias("home"))
    s = T.stations(spark, d).select("site_id", F.nullif("prec", F.lit("7")).alias("prec"))
    branches = [
        [("area", "prec")],
        [("area", F.lpad("prec", 2, "0"))],
        [("home", "site_id"), (F.substring("weapon_code", 1, 1), F.lit("1"))],
    ]
    return disjunctive_join(i, s, branches, "left").select("incident_id", "site_id")


def q_haversine_distance(spark, d):
    j = assign_sites(_firearm(_located(spark, d)), T.stations(spark, d), point_key="area", site_key="prec")
    return j.select("incident_id", "site_id", _r6(haversine_km("lat", "lon", "y", "x")).alias("distance_km"))


def q_geodesic_distance(spark, d):
    j = assign_sites(_firearm(_located(spark, d)), T.stations(spark, d), point_key="area", site_key="prec")
    j = with_geodesic_km(j, "distance_km", "lat", "lon", "y", "x")
    return j.select("incident_id", "site_id", _r6("distance_km").alias("distance_km"))


def _finish_avg(df: DataFrame, by: str, order_desc_count: bool) -> DataFrame:
    out = df.select(by, _r6("average_distance").alias("average_distance"), "crime_total")
    return out.orderBy(F.col("crime_total").desc(), by) if order_desc_count else out.orderBy(by)


def _responsible_by_year(metric):
    def q(spark, d):
        r = assigned_distance(_firearm(_located(spark, d)), T.stations(spark, d), by="year", metric=metric, partitions=_cores(spark))
        return _finish_avg(r, "year", False)
    return q


def _responsible_by_division(metric):
    def q(spark, d):
        r = assigned_distance(_armed(_located(spark, d)), T.stations(spark, d), by="division", metric=metric, partitions=_cores(spark))
        return _finish_avg(r, "division", True)
    return q


def _nearest_by_year(metric):
    def q(spark, d):
        r = nearest_distance(_firearm(_located(spark, d, with_area=False)), T.stations(spark, d), by="year",
                             id_col="incident_id", metric=metric, partitions=_cores(spark))
        return _finish_avg(r, "year", False)
    return q


def _nearest_by_division(metric):
    def q(spark, d):
        r = nearest_distance(_armed(_located(spark, d, with_area=False)), T.stations(spark, d), by="division",
                             site_cols=("division",), metric=metric, partitions=_cores(spark))
        return _finish_avg(r, "division", True)
    return q


def _assigned_sql(spark, d, metric: str, where: str, by_expr: str, by_name: str, order: str) -> DataFrame:
    dist = "__d"
    i = _located(spark, d)
    s = T.stations(spark, d)
    sql = f"""
        SELECT i.*, s.site_id, s.division, s.y, s.x
        FROM {{i}} i
        JOIN (SELECT st.*, key FROM {{s}} st
              LATERAL VIEW explode(array_distinct(array(prec, concat('0', prec)))) k AS key) s
          ON i.area = s.key
        WHERE {where}
    """
    joined = spark.sql(sql, i=i, s=s)
    if metric == "haversine":
        joined = joined.withColumn(dist, haversine_km("lat", "lon", "y", "x"))
    else:
        joined = with_geodesic_km(joined, dist, "lat", "lon", "y", "x")
    return spark.sql(
        f"""
        SELECT {by_expr} AS {by_name}, round(avg({dist}), 6) AS average_distance, count(*) AS crime_total
        FROM {{j}} GROUP BY {by_expr} ORDER BY {order}
        """,
        j=joined,
    )


def _responsible_by_year_sql(metric):
    return lambda spark, d: _assigned_sql(spark, d, metric, "i.weapon_code LIKE '1%'", "year", "year", "year")


def _responsible_by_division_sql(metric):
    return lambda spark, d: _assigned_sql(spark, d, metric, "i.weapon_code IS NOT NULL", "division", "division",
                                          "crime_total DESC, division")


def _candidates(spark, d, metric: str, where) -> DataFrame:
    """Exploded exact candidate sets of the nearest search (not all pairs)."""
    pts = where(_located(spark, d, with_area=False)).select("incident_id", "year", "lat", "lon")
    near = nearest_facility(pts, T.stations(spark, d), site_cols=("division",), metric=metric,
                            candidates_col="cands", partitions=_cores(spark))
    return near.select("incident_id", "year", F.inline("cands")).select(
        "incident_id", "year", F.col("k").alias("site_id"), F.col("p.division").alias("division"),
        F.col("d").alias("distance"))


def _nearest_by_year_sql(metric):
    def q(spark, d):
        return spark.sql(
            """
            WITH nearest AS (SELECT min_by(struct(year, distance), distance) AS n FROM {c} GROUP BY incident_id)
            SELECT n.year AS year, round(avg(n.distance), 6) AS average_distance, count(*) AS crime_total
            FROM nearest GROUP BY n.year ORDER BY 1
            """,
            c=_candidates(spark, d, metric, _firearm),
        )
    return q


def _nearest_by_division_sql(metric):
    def q(spark, d):
        return spark.sql(
            """
            WITH nearest AS (SELECT min(struct(distance, site_id, division)) AS n FROM {c} GROUP BY incident_id)
            SELECT n.division AS division, round(mean(n.distance), 6) AS average_distance, count(n.site_id) AS crime_total
            FROM nearest GROUP BY n.division ORDER BY crime_total DESC, division
            """,
            c=_candidates(spark, d, metric, _armed),
        )
    return q


def q_nearest_station_by_division_window_sql(spark, d):
    """The incident's first candidate by ROW_NUMBER over a named window, then per division."""
    return spark.sql(
        """
        SELECT division, round(avg(distance), 6) AS average_distance, count(*) AS crime_total
        FROM (
          SELECT division, distance, row_number() OVER by_distance AS place
          FROM {c}
          WINDOW by_distance AS (PARTITION BY incident_id ORDER BY distance, site_id)
        )
        WHERE place = 1
        GROUP BY division
        ORDER BY crime_total DESC, division
        """,
        c=_candidates(spark, d, METRIC, _armed),
    )


def q_nearest_with_ties(spark, d):
    pts = _armed(_located(spark, d, with_area=False)).select("incident_id", "lat", "lon")
    near = nearest_facility(pts, T.stations(spark, d), metric=METRIC, ties=True, partitions=_cores(spark))
    return near.select("incident_id", "site_id", _r6("distance_km").alias("distance_km"))


def q_nearest_outlet_tree(spark, d):
    """All incidents, those at (0, 0) too, and their nearest outlet: the search for site tables that aren't broadcast."""
    pts = T.incidents(spark, d).select("incident_id", "lat", "lon")
    near = nearest_facility(pts, T.outlets(spark, d), site_id="outlet_id", metric="haversine", max_broadcast_sites=0)
    return near.select("incident_id", "outlet_id", _r6("distance_km").alias("distance_km"))


# --- sorting ---------------------------------------------------------------

def q_sort_asc(spark, d):
    i = T.incidents(spark, d)
    return i.groupBy(F.year("occurred_on").alias("year")).agg(F.count(F.lit(1)).alias("crime_total")).orderBy("year")


def q_sort_desc(spark, d):
    i = T.incidents(spark, d)
    return (
        i.groupBy("weapon_code").agg(F.count(F.lit(1)).alias("crime_total"))
        .orderBy(F.col("crime_total").desc(), "weapon_code")
    )


# --- user-defined functions ------------------------------------------------


def q_udf_scalar(spark, d):
    e = T.timed_events(spark, d).filter(F.col("premise") == STREET)
    return e.groupBy(daypart_udf("hhmm").alias("period_of_day")).agg(F.count(F.lit(1)).alias("crime_total"))


def q_udf_in_sql(spark, d):
    spark.udf.register("daypart_of", daypart_udf)
    return spark.sql(
        f"""
        SELECT daypart_of(hhmm) AS period_of_day, count(*) AS crime_total
        FROM {{e}} WHERE premise = '{STREET}' GROUP BY daypart_of(hhmm)
        """,
        e=T.timed_events(spark, d),
    )


# --- join strategies -------------------------------------------------------

def _hint_query(hint: str):
    def q(spark, d):
        i = T.incidents(spark, d).select("incident_id", "o_custkey")
        c = T.table(spark, d, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("area")
        )
        return with_join_hint(i, c, "o_custkey", "inner", hint).select("incident_id", "area")
    return q


def q_join_plans(spark, d):
    """How each hint is planned (the join's node, build side and what feeds it), beside the rows that the join gives."""
    hinted = {hint: _hint_query(hint)(spark, d) for hint in ("broadcast", "merge", "shuffle_hash")}
    counted = None
    for label, df in hinted.items():
        n = df.agg(F.lit(label).alias("label"), F.count(F.lit(1)).alias("n_rows"))
        counted = n if counted is None else counted.unionByName(n)
    return join_table(spark, hinted).join(counted, "label").withColumnRenamed("label", "hint")


def queries() -> dict[str, Query]:
    return {
        "csv_scan": q_csv_scan,
        "text_scan_from_csv": q_text_scan_from_csv,
        "text_scan_multiline": q_text_scan_multiline,
        "csv_scan_by_header": q_csv_scan_by_header,
        "malformed_counts": q_malformed_counts,
        "load_count": q_load_count,
        "union_all": q_union_all,
        "union_distinct": q_union_distinct,
        "typed_projection": q_typed_projection,
        "parse_us_timestamp": q_parse_us_timestamp,
        "filter_eq": q_filter_eq,
        "filter_not_null": q_filter_not_null,
        "filter_null_island": q_filter_null_island,
        "filter_prefix": q_filter_prefix,
        "filter_like": q_filter_like,
        "filter_year": q_filter_year,
        "zip_prefix": q_zip_prefix,
        "clean_money": q_clean_money,
        "code_to_label": q_code_to_label,
        "monthly_counts": q_monthly_counts,
        "top_months_per_year": q_top_months_per_year,
        "top_months_per_year_sql": q_top_months_per_year_sql,
        "months_named_windows_sql": q_months_named_windows_sql,
        "top_days_per_weapon": q_top_days_per_weapon,
        "incidents_numbered": q_incidents_numbered,
        "daypart_counts": q_daypart_counts,
        "daypart_counts_sql": q_daypart_counts_sql,
        "daypart_counts_isin": q_daypart_counts_isin,
        "reduce_by_key": q_reduce_by_key,
        "inner_join_expr": q_inner_join_expr,
        "inner_join_using": q_inner_join_using,
        "inner_join_multi_key": q_inner_join_multi_key,
        "left_join_multi_key": q_left_join_multi_key,
        "left_join_skewed": q_left_join_skewed,
        "inner_join_skewed": q_inner_join_skewed,
        "min_income_per_zone": q_min_income_per_zone,
        "bottom_k": q_bottom_k,
        "top_k": q_top_k,
        "income_extremes": q_income_extremes,
        "income_extremes_sql": q_income_extremes_sql,
        "income_extremes_cached": q_income_extremes_cached,
        "income_extremes_total": q_income_extremes_total,
        "or_join": q_or_join,
        "or_join_rewritten": q_or_join_rewritten,
        "or_join_disjoint": q_or_join_disjoint,
        "haversine_distance": q_haversine_distance,
        "geodesic_distance": q_geodesic_distance,
        "responsible_station_by_year": _responsible_by_year(METRIC),
        "responsible_station_by_division": _responsible_by_division(METRIC),
        "responsible_station_by_year_sql": _responsible_by_year_sql(METRIC),
        "responsible_station_by_division_sql": _responsible_by_division_sql(METRIC),
        "nearest_station_by_year": _nearest_by_year(METRIC),
        "nearest_station_by_division": _nearest_by_division(METRIC),
        "nearest_station_by_year_sql": _nearest_by_year_sql(METRIC),
        "nearest_station_by_division_sql": _nearest_by_division_sql(METRIC),
        "responsible_station_by_year_haversine": _responsible_by_year("haversine"),
        "nearest_station_by_division_haversine": _nearest_by_division("haversine"),
        "nearest_station_by_division_window_sql": q_nearest_station_by_division_window_sql,
        "nearest_with_ties": q_nearest_with_ties,
        "nearest_outlet_tree": q_nearest_outlet_tree,
        "sort_asc": q_sort_asc,
        "sort_desc": q_sort_desc,
        "udf_scalar": q_udf_scalar,
        "udf_in_sql": q_udf_in_sql,
        "join_plans": q_join_plans,
        "join_hint_broadcast": _hint_query("broadcast"),
        "join_hint_merge": _hint_query("merge"),
        "join_hint_shuffle_hash": _hint_query("shuffle_hash"),
    }
