"""Oracle SQL (DuckDB dialect) for every catalogue key.

Each statement recomputes the key's result from the raw benchmark views
(``orders``, ``customer``, ``nation``, ``supplier``, ``events``) with the
same role definitions as :mod:`blotter.sources.tables`, written
as plain SQL. The geodesic here is Vincenty's fixed-point iteration, unrolled
step by step; the library solves it in another way (functions/geo.py). The nearest-facility oracles use the
straightforward all-pairs form, which is fine for a small check.
"""

from __future__ import annotations

from blotter.functions.labels import label_case_sql

TOP_K = 3
ZONE_YEAR = 1998
SPLIT_YEAR = 1998
STREET = "error"
US_TS = "%m/%d/%Y %I:%M:%S %p"

# --- distances -------------------------------------------------------------

# WGS-84 ellipsoid and the IUGG mean Earth radius.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
WGS84_B_KM = WGS84_A_KM * (1 - WGS84_F)
MEAN_RADIUS_KM = 6371.0088
VINCENTY_ITERATIONS = 8
_CONVERGED = 1e-11


def sql_double(x: float) -> str:
    r = repr(float(x))
    return r if "e" in r else r + "E0"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """2 R atan2(sqrt(h), sqrt(1 - h))."""
    h = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
         f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({sql_double(2 * MEAN_RADIUS_KM)} * atan2(sqrt({h}), sqrt(greatest(0, 1 - {h}))))"


_OMF = sql_double(1 - WGS84_F)
_F = sql_double(WGS84_F)
_F16 = sql_double(WGS84_F / 16)
_ZERO = "CAST(0 AS DOUBLE)"

VINCENTY_STATE = ("L", "su1", "cu1", "su2", "cu2", "lam", "lam_prev", "sl", "cl", "ss", "cs", "sg", "sa", "c2a",
                  "c2sm")

VINCENTY_INIT = {
    "L": "radians({lon2} - {lon1})",
    "su1": f"sin(atan({_OMF} * tan(radians({{lat1}}))))",
    "cu1": f"cos(atan({_OMF} * tan(radians({{lat1}}))))",
    "su2": f"sin(atan({_OMF} * tan(radians({{lat2}}))))",
    "cu2": f"cos(atan({_OMF} * tan(radians({{lat2}}))))",
    "lam": "radians({lon2} - {lon1})",
    "lam_prev": "CAST(10 AS DOUBLE)",
    **{n: _ZERO for n in ("sl", "cl", "ss", "cs", "sg", "sa", "c2a", "c2sm")},
}

_C = f"({_F16} * {{c2a}} * (4 + {_F} * (4 - 3 * {{c2a}})))"

VINCENTY_STEPS: list[dict[str, str]] = [
    {"lam_prev": "{lam}", "sl": "sin({lam})", "cl": "cos({lam})"},
    {"ss": "sqrt(pow({cu2} * {sl}, 2) + pow({cu1} * {su2} - {su1} * {cu2} * {cl}, 2))",
     "cs": "{su1} * {su2} + {cu1} * {cu2} * {cl}"},
    # coincident points give 0/0: sin(alpha) is null, the distance is 0 at the end
    {"sg": "atan2({ss}, {cs})", "sa": "CASE WHEN {ss} = 0 THEN NULL ELSE {cu1} * {cu2} * {sl} / {ss} END"},
    # equatorial lines have cos^2(alpha) = 0; cos(2 sigma_m) is then taken as 0
    {"c2a": "1 - {sa} * {sa}",
     "c2sm": f"coalesce({{cs}} - CASE WHEN 1 - {{sa}} * {{sa}} = 0 THEN NULL"
             f" ELSE 2 * {{su1}} * {{su2}} / (1 - {{sa}} * {{sa}}) END, {_ZERO})"},
    {"lam": f"{{L}} + (1 - {_C}) * {_F} * {{sa}} * ({{sg}} + {_C} * {{ss}} * ({{c2sm}}"
            f" + {_C} * {{cs}} * (-1 + 2 * {{c2sm}} * {{c2sm}})))"},
]

_U2 = f"({{c2a}} * {sql_double((WGS84_A_KM ** 2 - WGS84_B_KM ** 2) / WGS84_B_KM ** 2)})"
_BIG_A = f"(1 + {_U2} / 16384 * (4096 + {_U2} * (-768 + {_U2} * (320 - 175 * {_U2}))))"
_BIG_B = f"({_U2} / 1024 * (256 + {_U2} * (-128 + {_U2} * (74 - 47 * {_U2}))))"
_D_SIGMA = (f"({_BIG_B} * {{ss}} * ({{c2sm}} + {_BIG_B} / 4 * ({{cs}} * (-1 + 2 * {{c2sm}} * {{c2sm}})"
            f" - {_BIG_B} / 6 * {{c2sm}} * (-3 + 4 * {{ss}} * {{ss}}) * (-3 + 4 * {{c2sm}} * {{c2sm}}))))")
# near-antipodal pairs where the iteration does not settle give null
VINCENTY_FINAL = (f"CASE WHEN {{lat1}} = {{lat2}} AND {{lon1}} = {{lon2}} THEN {_ZERO}"
                  f" WHEN abs({{lam}} - {{lam_prev}}) < {sql_double(_CONVERGED)}"
                  f" THEN {sql_double(WGS84_B_KM)} * {_BIG_A} * ({{sg}} - {_D_SIGMA}) END")


# --- role views ------------------------------------------------------------

INCIDENTS = """incidents AS (
  SELECT o_orderkey AS incident_id,
         CAST(o_orderdate AS DATE) AS occurred_on,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS reported_on,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS weapon_code,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS victim_code,
         CASE WHEN o_orderkey % 97 = 0 THEN 0.0
              ELSE 33.70 + ((o_orderkey * 7919) % 6400) / 10000 END AS lat,
         CASE WHEN o_orderkey % 97 = 0 THEN 0.0
              ELSE -118.67 + ((o_orderkey * 104729) % 5200) / 10000 END AS lon,
         o_custkey
  FROM orders)"""

INCIDENTS_AREA = """incidents_area AS (
  SELECT i.*, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS area, c.c_mktsegment AS premise
  FROM incidents i JOIN customer c ON i.o_custkey = c.c_custkey)"""

STATIONS = """stations AS (
  SELECT n_nationkey AS site_id, CAST(n_nationkey AS VARCHAR) AS prec, n_name AS division,
         33.70 + ((n_nationkey * 2551 + 1217) % 6400) / 10000 AS y,
         -118.67 + ((n_nationkey * 3571 + 911) % 5200) / 10000 AS x
  FROM nation)"""

MONTHS = """months AS (
  SELECT year(occurred_on) AS year, month(occurred_on) AS month, count(*) AS crime_total FROM incidents GROUP BY 1, 2)"""

_ZONE = "lpad(CAST(CAST(floor(li / 1280) * 5 + floor(lo / 1040) AS INTEGER) AS VARCHAR), 4, '0')"
GEOCODE = f"""geo_pts AS (
  SELECT 33.70 + ((o_orderkey * 7919) % 6400) / 10000 AS lat,
         -118.67 + ((o_orderkey * 104729) % 5200) / 10000 AS lon,
         (o_orderkey * 7919) % 6400 AS li, (o_orderkey * 104729) % 5200 AS lo
  FROM orders WHERE o_orderkey % 97 <> 0),
geocode AS (
  SELECT DISTINCT lat, lon,
         CASE WHEN (li + lo) % 23 = 0 THEN NULL
              WHEN (li + lo) % 19 = 0 THEN '9' || {_ZONE} || '-' || lpad(CAST(li % 10000 AS VARCHAR), 4, '0')
              ELSE '9' || {_ZONE} END AS zip
  FROM geo_pts)"""

_AMOUNT = "CAST(floor(abs(s_acctbal) * 7) AS BIGINT)"
INCOME = f"""income AS (
  SELECT '9' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS zip,
         CASE WHEN s_suppkey % 17 = 0 THEN ''
              WHEN {_AMOUNT} >= 1000 THEN '$' || CAST({_AMOUNT} // 1000 AS VARCHAR) || ','
                                          || lpad(CAST({_AMOUNT} % 1000 AS VARCHAR), 3, '0')
              ELSE '$' || CAST({_AMOUNT} AS VARCHAR) END AS income_raw
  FROM supplier),
income_clean AS (
  SELECT zip, TRY_CAST(regexp_replace(income_raw, '[^0-9]', '', 'g') AS INTEGER) AS income FROM income),
zone_income AS (
  SELECT zip, min(income) AS income FROM income_clean
  WHERE zip IS NOT NULL AND income IS NOT NULL GROUP BY zip)"""

EVENTS = """timed_events AS (
  SELECT event_id AS incident_id,
         CASE WHEN event_id % 101 <> 0 THEN strftime(ts, '%H%M') END AS hhmm,
         event_type AS premise, value
  FROM events)"""

LOCATED = """located AS (
  SELECT *, CAST(year(reported_on) AS INTEGER) AS year FROM incidents_area WHERE lat <> 0 AND lon <> 0)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def vincenty_ctes(src: str, lat1: str, lon1: str, lat2: str, lon2: str, out: str = "distance_km",
                  prefix: str = "v", iterations: int = VINCENTY_ITERATIONS) -> tuple[list[str], str]:
    """Vincenty's inverse method as a chain of CTEs over ``src`` (one per step)."""
    inputs = {"lat1": lat1, "lon1": lon1, "lat2": lat2, "lon2": lon2}
    names = {**inputs, **{n: f"v_{n}" for n in VINCENTY_STATE}}
    init = ", ".join(f"CAST({VINCENTY_INIT[n].format(**inputs)} AS DOUBLE) AS v_{n}" for n in VINCENTY_STATE)
    ctes = [f"{prefix}0 AS (SELECT *, {init} FROM {src})"]
    k = 0
    for _ in range(iterations):
        for step in VINCENTY_STEPS:
            repl = ", ".join(f"{t.format(**names)} AS v_{n}" for n, t in step.items())
            ctes.append(f"{prefix}{k + 1} AS (SELECT * REPLACE ({repl}) FROM {prefix}{k})")
            k += 1
    ctes.append(f"{prefix}_out AS (SELECT *, {VINCENTY_FINAL.format(**names)} AS {out} FROM {prefix}{k})")
    return ctes, f"{prefix}_out"


# --- oracle statements -----------------------------------------------------

def _typed_export() -> str:
    return _with(INCIDENTS, INCIDENTS_AREA) + """
SELECT CAST(incident_id AS VARCHAR) AS incident_id,
       CASE WHEN incident_id % 50 = 0 THEN NULL ELSE reported_on END AS reported_on,
       occurred_on,
       CASE WHEN incident_id % 89 <> 0 THEN lpad(CAST((incident_id * 37) % 2400 AS VARCHAR), 4, '0') END AS hhmm,
       area,
       CASE WHEN incident_id % 53 = 0 THEN NULL ELSE CAST(incident_id % 90 AS INTEGER) END AS victim_age,
       victim_code,
       CASE WHEN incident_id % 41 = 0 THEN 'SHOP, INDOOR' ELSE premise END AS premise,
       weapon_code, lat, lon
FROM incidents_area"""


def _daypart_case(col: str) -> str:
    t = f"TRY_CAST({col} AS INTEGER)"
    return (f"CASE WHEN {t} BETWEEN 500 AND 1159 THEN '05:00-11:59' "
            f"WHEN {t} BETWEEN 1200 AND 1659 THEN '12:00-16:59' "
            f"WHEN {t} BETWEEN 1700 AND 2059 THEN '17:00-20:59' "
            f"WHEN {t} BETWEEN 0 AND 459 OR {t} BETWEEN 2100 AND 2359 THEN '21:00-03:59' "
            "ELSE 'Null' END")


def _daypart_counts() -> str:
    return _with(EVENTS) + f"""
SELECT {_daypart_case('hhmm')} AS period_of_day, count(*) AS crime_total
FROM timed_events WHERE premise = '{STREET}' GROUP BY 1"""


def _hour_prefix_case(col: str) -> str:
    p = f"substr({col}, 1, 2)"
    return (f"CASE WHEN {p} IN ('05','06','07','08','09','10','11') THEN 'morning' "
            f"WHEN {p} IN ('12','13','14','15','16') THEN 'afternoon' "
            f"WHEN {p} IN ('17','18','19','20') THEN 'evening' "
            f"WHEN {p} IN ('21','22','23','00','01','02','03','04') THEN 'night' END")


def _top_months() -> str:
    return _with(INCIDENTS) + f"""
SELECT year, month, crime_total, rank FROM (
  SELECT CAST(year(occurred_on) AS INTEGER) AS year, CAST(month(occurred_on) AS INTEGER) AS month,
         count(*) AS crime_total,
         CAST(rank() OVER (PARTITION BY year(occurred_on) ORDER BY count(*) DESC) AS INTEGER) AS rank
  FROM incidents GROUP BY year(occurred_on), month(occurred_on)) t
WHERE rank <= {TOP_K}"""


def _income_extremes_cte() -> str:
    label = label_case_sql("p.victim_code")
    return f""",
facts AS (
  SELECT lat, lon, victim_code FROM incidents
  WHERE victim_code IS NOT NULL AND year(occurred_on) = {ZONE_YEAR}),
per_zone AS (
  SELECT g.zip, f.victim_code, count(*) AS n
  FROM facts f JOIN geocode g ON f.lat = g.lat AND f.lon = g.lon
  WHERE g.zip IS NOT NULL GROUP BY g.zip, f.victim_code),
relevant AS (SELECT * FROM zone_income z WHERE z.zip IN (SELECT zip FROM per_zone)),
extremes AS (
  SELECT zip, 'highest' AS side FROM (
    SELECT zip, row_number() OVER (ORDER BY income DESC, zip) AS rn FROM relevant) t WHERE rn <= {TOP_K}
  UNION ALL
  SELECT zip, 'lowest' AS side FROM (
    SELECT zip, row_number() OVER (ORDER BY income ASC, zip) AS rn FROM relevant) t WHERE rn <= {TOP_K}),
extreme_counts AS (
  SELECT e.side, p.victim_code, {label} AS victim_descent, sum(p.n) AS crime_total
  FROM per_zone p JOIN extremes e ON p.zip = e.zip GROUP BY e.side, p.victim_code)
"""


def _income_extremes() -> str:
    return (
        "WITH " + ",\n".join([INCIDENTS, GEOCODE, INCOME]) + _income_extremes_cte()
        + "SELECT side, victim_code, victim_descent, CAST(crime_total AS BIGINT) AS crime_total FROM extreme_counts"
    )


def _income_extremes_total() -> str:
    return (
        "WITH " + ",\n".join([INCIDENTS, GEOCODE, INCOME]) + _income_extremes_cte()
        + "SELECT victim_descent, CAST(sum(crime_total) AS BIGINT) AS crime_total "
          "FROM extreme_counts GROUP BY victim_descent"
    )


_SPELLINGS_JOIN = """assigned AS (
  SELECT l.*, s.site_id, s.division, s.y, s.x
  FROM located l JOIN stations s ON l.area = s.prec OR l.area = '0' || s.prec)"""


def _assigned_distance_rows(where: str) -> str:
    return "WITH " + ",\n".join([INCIDENTS, INCIDENTS_AREA, STATIONS, LOCATED, _SPELLINGS_JOIN]) + f"""
SELECT * FROM assigned WHERE {where}"""


def _assigned(by: str, where: str, metric: str) -> str:
    base = [INCIDENTS, INCIDENTS_AREA, STATIONS, LOCATED, _SPELLINGS_JOIN,
            f"pairs AS (SELECT * FROM assigned WHERE {where})"]
    if metric == "haversine":
        base.append(f"dist AS (SELECT *, {haversine_sql('lat', 'lon', 'y', 'x')} AS distance_km FROM pairs)")
        src = "dist"
    else:
        ctes, src = vincenty_ctes("pairs", "lat", "lon", "y", "x")
        base.extend(ctes)
    return "WITH " + ",\n".join(base) + f"""
SELECT {by}, round(avg(distance_km), 6) AS average_distance, count(*) AS crime_total
FROM {src} GROUP BY {by}"""


def _nearest(by: str, where: str, metric: str, per_id_min: bool) -> str:
    base = [INCIDENTS, INCIDENTS_AREA, STATIONS,
            "pts AS (SELECT incident_id, CAST(year(reported_on) AS INTEGER) AS year, lat, lon FROM incidents"
            f" WHERE lat <> 0 AND lon <> 0 AND {where})",
            "pairs AS (SELECT p.*, s.site_id, s.division, s.y, s.x FROM pts p CROSS JOIN stations s)"]
    if metric == "haversine":
        base.append(f"dist AS (SELECT *, {haversine_sql('lat', 'lon', 'y', 'x')} AS distance_km FROM pairs)")
        src = "dist"
    else:
        ctes, src = vincenty_ctes("pairs", "lat", "lon", "y", "x")
        base.extend(ctes)
    if per_id_min:
        body = f"""
SELECT year, round(avg(md), 6) AS average_distance, count(*) AS crime_total
FROM (SELECT incident_id, min(distance_km) AS md, min(year) AS year FROM {src} GROUP BY incident_id) t
GROUP BY year"""
    else:
        body = f"""
SELECT {by}, round(avg(distance_km), 6) AS average_distance, count(*) AS crime_total
FROM (SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY distance_km, site_id) AS rn FROM {src}) t
WHERE rn = 1 GROUP BY {by}"""
    return "WITH " + ",\n".join(base) + body


def _nearest_ties(metric: str) -> str:
    base = [INCIDENTS, STATIONS,
            "pts AS (SELECT incident_id, lat, lon FROM incidents"
            " WHERE lat <> 0 AND lon <> 0 AND weapon_code IS NOT NULL)",
            "pairs AS (SELECT p.*, s.site_id, s.y, s.x FROM pts p CROSS JOIN stations s)"]
    ctes, src = vincenty_ctes("pairs", "lat", "lon", "y", "x") if metric == "geodesic" else (
        [f"dist AS (SELECT *, {haversine_sql('lat', 'lon', 'y', 'x')} AS distance_km FROM pairs)"], "dist")
    base.extend(ctes)
    return "WITH " + ",\n".join(base) + f"""
SELECT incident_id, site_id, round(distance_km, 6) AS distance_km
FROM (SELECT *, rank() OVER (PARTITION BY incident_id ORDER BY distance_km) AS rk FROM {src}) t WHERE rk = 1"""


def _hint_join() -> str:
    return _with(INCIDENTS) + """
SELECT i.incident_id, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS area
FROM incidents i JOIN customer c ON i.o_custkey = c.c_custkey"""


def oracle_sql() -> dict[str, str]:
    W = _with
    firearm = "weapon_code LIKE '1%'"
    armed = "weapon_code IS NOT NULL"
    hint = _hint_join()
    return {
        "csv_scan": _typed_export(),
        "text_scan_from_csv": _typed_export(),
        "text_scan_multiline": f"""
SELECT * EXCLUDE (k) REPLACE (CASE WHEN k % 7 = 0 THEN 'ROOM ' || (k % 13) || ',' || chr(10) || 'FLOOR ' || (k % 3) || chr(10) || chr(10) || 'REAR'
                       WHEN k % 11 = 0 THEN 'SO-CALLED "YARD",' || chr(10) || 'GATE' ELSE premise END AS premise)
FROM (SELECT *, CAST(incident_id AS BIGINT) AS k FROM ({_typed_export()}) e) t""",
        "csv_scan_by_header": _typed_export(),
        "malformed_counts": W(INCIDENTS, INCIDENTS_AREA) + f"""
SELECT CASE WHEN late THEN 'newer' ELSE 'older' END AS folder, count(*) + sum(bad)::BIGINT AS n_rows, sum(bad)::BIGINT AS n_malformed
FROM (SELECT late, CASE WHEN late AND incident_id % 29 = 0 THEN 1 ELSE 0 END AS bad
      FROM (SELECT incident_id, occurred_on >= DATE '{SPLIT_YEAR}-01-01' AS late FROM incidents_area) i) t
GROUP BY late""",
        "load_count": W(INCIDENTS, INCIDENTS_AREA) + "SELECT count(*) AS n_rows FROM incidents_area",
        "union_all": W(INCIDENTS) + "SELECT incident_id, occurred_on FROM incidents",
        "union_distinct": W(INCIDENTS) + f"""
SELECT victim_code, weapon_code FROM incidents WHERE occurred_on < DATE '{SPLIT_YEAR}-01-01'
UNION
SELECT victim_code, weapon_code FROM incidents WHERE occurred_on >= DATE '{SPLIT_YEAR}-01-01'""",
        "typed_projection": """
SELECT CAST(o_orderkey AS VARCHAR) AS incident_id, o_totalprice AS total_price,
       CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status FROM orders""",
        "parse_us_timestamp": """
SELECT o_orderkey AS incident_id,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS occurred_on
FROM orders""",
        "filter_eq": W(EVENTS) + f"SELECT incident_id, hhmm FROM timed_events WHERE premise = '{STREET}'",
        "filter_not_null": W(INCIDENTS) + "SELECT incident_id, weapon_code FROM incidents WHERE weapon_code IS NOT NULL",
        "filter_null_island": W(INCIDENTS) + "SELECT incident_id, lat, lon FROM incidents WHERE lat <> 0 AND lon <> 0",
        "filter_prefix": W(INCIDENTS) + "SELECT incident_id, weapon_code FROM incidents WHERE substr(weapon_code, 1, 1) = '1'",
        "filter_like": W(INCIDENTS) + f"SELECT incident_id, weapon_code FROM incidents WHERE {firearm}",
        "filter_year": W(INCIDENTS) + f"""
SELECT incident_id, occurred_on, victim_code FROM incidents
WHERE victim_code IS NOT NULL AND year(occurred_on) = {ZONE_YEAR}""",
        "zip_prefix": W(GEOCODE) + "SELECT lat, lon, zip, split_part(zip, '-', 1) AS zip5 FROM geocode",
        "clean_money": W(INCOME) + """
SELECT zip, income_raw, TRY_CAST(regexp_replace(income_raw, '[^0-9]', '', 'g') AS INTEGER) AS income FROM income""",
        "code_to_label": W(INCIDENTS) + f"""
SELECT incident_id, victim_code, {label_case_sql('victim_code')} AS victim_descent FROM incidents""",
        "monthly_counts": W(INCIDENTS) + """
SELECT CAST(year(occurred_on) AS INTEGER) AS year, CAST(month(occurred_on) AS INTEGER) AS month,
       count(*) AS crime_total FROM incidents GROUP BY 1, 2""",
        "top_months_per_year": _top_months(),
        "top_months_per_year_sql": _top_months(),
        "months_named_windows_sql": W(INCIDENTS, MONTHS) + """
SELECT year, month, crime_total,
       1 + (SELECT count(*) FROM months o WHERE o.year = m.year AND o.crime_total > m.crime_total) AS rank,
       (SELECT count(*) FROM months o WHERE o.year = m.year AND (-o.crime_total, o.month) <= (-m.crime_total, m.month)) AS place,
       (SELECT sum(o.crime_total) FROM months o WHERE o.year = m.year AND (-o.crime_total, o.month) <= (-m.crime_total, m.month)) AS running_total
FROM months m""",
        "top_days_per_weapon": W(INCIDENTS) + f"""
SELECT weapon_code, occurred_on, crime_total, rank, place FROM (
  SELECT *, rank() OVER (PARTITION BY weapon_code ORDER BY crime_total DESC) AS rank,
         row_number() OVER (PARTITION BY weapon_code ORDER BY crime_total DESC, occurred_on) AS place
  FROM (SELECT weapon_code, occurred_on, count(*) AS crime_total FROM incidents GROUP BY 1, 2) d) t
WHERE place <= {TOP_K}""",
        "incidents_numbered": W(INCIDENTS) + """
SELECT incident_id, weapon_code, occurred_on,
       row_number() OVER (PARTITION BY weapon_code ORDER BY occurred_on DESC NULLS LAST, incident_id) AS place,
       rank() OVER (PARTITION BY weapon_code ORDER BY occurred_on DESC NULLS LAST) AS rank
FROM incidents""",
        "daypart_counts": _daypart_counts(),
        "daypart_counts_sql": _daypart_counts(),
        "daypart_counts_isin": W(EVENTS) + f"""
SELECT period_of_day, count(*) AS crime_total FROM (
  SELECT {_hour_prefix_case('hhmm')} AS period_of_day FROM timed_events WHERE premise = '{STREET}') t
WHERE period_of_day IS NOT NULL GROUP BY period_of_day""",
        "reduce_by_key": "SELECT event_type, round(sum(value), 6) AS total FROM events GROUP BY event_type",
        "inner_join_expr": W(GEOCODE, INCOME) + """
SELECT g.lat, g.lon, g.zip, i.income FROM geocode g JOIN income_clean i ON g.zip = i.zip""",
        "inner_join_using": W(GEOCODE, INCOME) + """
SELECT g.lat, g.lon, g.zip, z.income FROM geocode g JOIN zone_income z USING (zip)""",
        "inner_join_multi_key": W(INCIDENTS, GEOCODE) + """
SELECT i.incident_id, g.zip FROM incidents i JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon""",
        "left_join_multi_key": W(INCIDENTS, GEOCODE) + """
SELECT i.incident_id, g.zip FROM incidents i LEFT JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon""",
        "left_join_skewed": W(INCIDENTS, GEOCODE) + """
SELECT i.incident_id, g.zip FROM incidents i LEFT JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon""",
        "inner_join_skewed": W(INCIDENTS, INCIDENTS_AREA, STATIONS) + """
SELECT i.incident_id, s.division FROM incidents_area i JOIN stations s ON CAST(i.area AS INTEGER) = s.site_id""",
        "min_income_per_zone": W(INCOME) + "SELECT zip, income FROM zone_income",
        "bottom_k": W(INCOME) + f"SELECT zip, income FROM zone_income ORDER BY income ASC, zip LIMIT {TOP_K}",
        "top_k": W(INCOME) + f"SELECT zip, income FROM zone_income ORDER BY income DESC, zip LIMIT {TOP_K}",
        "income_extremes": _income_extremes(),
        "income_extremes_sql": _income_extremes(),
        "income_extremes_cached": _income_extremes(),
        "income_extremes_total": _income_extremes_total(),
        "or_join": W(INCIDENTS, INCIDENTS_AREA, STATIONS) + """
SELECT i.incident_id, s.site_id, s.division
FROM incidents_area i JOIN stations s ON i.area = s.prec OR i.area = '0' || s.prec""",
        "or_join_rewritten": W(INCIDENTS, INCIDENTS_AREA, STATIONS) + """
SELECT i.incident_id, s.site_id, s.division
FROM incidents_area i JOIN stations s ON i.area = s.prec OR i.area = '0' || s.prec""",
        "or_join_disjoint": W(INCIDENTS, INCIDENTS_AREA, STATIONS) + """
SELECT i.incident_id, s.site_id
FROM incidents_area i LEFT JOIN (SELECT site_id, nullif(prec, '7') AS prec FROM stations) s
  ON i.area = s.prec OR i.area = lpad(s.prec, 2, '0') OR (i.o_custkey % 60 = s.site_id AND substr(i.weapon_code, 1, 1) = '1')""",
        "haversine_distance": _assigned_distance_rows(firearm).replace(
            "SELECT * FROM assigned",
            f"SELECT incident_id, site_id, round({haversine_sql('lat', 'lon', 'y', 'x')}, 6) AS distance_km"
            " FROM assigned"),
        "geodesic_distance": "WITH " + ",\n".join(
            [INCIDENTS, INCIDENTS_AREA, STATIONS, LOCATED, _SPELLINGS_JOIN,
             f"pairs AS (SELECT * FROM assigned WHERE {firearm})"]
            + vincenty_ctes("pairs", "lat", "lon", "y", "x")[0])
        + "\nSELECT incident_id, site_id, round(distance_km, 6) AS distance_km FROM v_out",
        "responsible_station_by_year": _assigned("year", firearm, "geodesic"),
        "responsible_station_by_division": _assigned("division", armed, "geodesic"),
        "responsible_station_by_year_sql": _assigned("year", firearm, "geodesic"),
        "responsible_station_by_division_sql": _assigned("division", armed, "geodesic"),
        "nearest_station_by_year": _nearest("year", firearm, "geodesic", True),
        "nearest_station_by_division": _nearest("division", armed, "geodesic", False),
        "nearest_station_by_year_sql": _nearest("year", firearm, "geodesic", True),
        "nearest_station_by_division_sql": _nearest("division", armed, "geodesic", False),
        "responsible_station_by_year_haversine": _assigned("year", firearm, "haversine"),
        "nearest_station_by_division_haversine": _nearest("division", armed, "haversine", False),
        "nearest_station_by_division_window_sql": _nearest("division", armed, "geodesic", False),
        "nearest_with_ties": _nearest_ties("geodesic"),
        "nearest_outlet_tree": W(INCIDENTS) + f""", outlets AS (
  SELECT c_custkey AS outlet_id, 33.70 + ((c_custkey * 3253) % 6389) / 10000 AS y, -118.67 + ((c_custkey * 4099) % 5197) / 10000 AS x FROM customer),
best AS (
  SELECT incident_id, min({{'d': {haversine_sql('lat', 'lon', 'y', 'x')}, 'k': outlet_id}}) AS m FROM incidents CROSS JOIN outlets GROUP BY incident_id)
SELECT incident_id, m.k AS outlet_id, round(m.d, 6) AS distance_km FROM best""",
        "sort_asc": W(INCIDENTS) + """
SELECT CAST(year(occurred_on) AS INTEGER) AS year, count(*) AS crime_total FROM incidents GROUP BY 1 ORDER BY 1""",
        "sort_desc": W(INCIDENTS) + """
SELECT weapon_code, count(*) AS crime_total FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1""",
        "udf_scalar": _daypart_counts(),
        "udf_in_sql": _daypart_counts(),
        "join_plans": W(INCIDENTS) + """
SELECT p.*, (SELECT count(*) FROM incidents i JOIN customer c ON i.o_custkey = c.c_custkey) AS n_rows
FROM (VALUES ('broadcast', 0, 'BroadcastHashJoin', 'Inner', 'right', 0, 1, 0),
             ('merge', 0, 'SortMergeJoin', 'Inner', NULL, 2, 0, 2),
             ('shuffle_hash', 0, 'ShuffledHashJoin', 'Inner', 'right', 2, 0, 0))
  AS p(hint, join_no, join_node, join_type, build_side, shuffles, broadcasts, sorts)""",
        "join_hint_broadcast": hint,
        "join_hint_merge": hint,
        "join_hint_shuffle_hash": hint,
    }
