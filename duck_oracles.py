"""Independent DuckDB formulations of the registered queries.

Each query re-derives the incident-shaped stand-ins from the base tables
in SQL. Where the Spark side formats a date as text and parses it back, the
oracle uses the date directly and applies the same validity rule to the
key, so the text round trip is checked rather than repeated. Numeric
literals are written as doubles (``33.7e0``); DuckDB reads ``33.7`` as a
decimal.
"""

from __future__ import annotations

# Victim descent code book, written out here so that the oracle
# doesn't depend on the table under test.
LABELS = {
    "A": "Other Asian", "B": "Black", "C": "Chinese", "D": "Cambodian", "F": "Filipino", "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican", "I": "American Indian/Alaskan Native", "J": "Japanese", "K": "Korean", "L": "Laotian",
    "O": "Other", "P": "Pacific Islander", "S": "Samoan", "U": "Hawaiian", "V": "Vietnamese", "W": "White",
    "X": "Unknown", "Z": "Asian Indian",
}

F_WGS84 = 1 / 298.257223563
A_WGS84 = 6378137.0
B_WGS84 = (1 - F_WGS84) * A_WGS84
R_MEAN_KM = 6371.0088

INC = f"""
inc AS (
    SELECT o_orderkey AS dr_no,
           c_custkey,
           o_orderdate,
           CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 THEN o_orderdate END AS ts,
           CAST(c_nationkey AS INTEGER) AS area,
           CASE WHEN o_orderkey % 31 = 0 THEN NULL
                ELSE CAST(100 + (o_orderkey * 7) % 500 AS INTEGER) END AS weapon_cd,
           CASE WHEN o_orderkey % 211 = 0 THEN 0.0e0 ELSE 33.7e0 + (o_orderkey % 700) / 1000 END AS lat,
           CASE WHEN o_orderkey % 211 = 0 THEN 0.0e0 ELSE -118.7e0 + (o_orderkey % 500) / 1000 END AS lon,
           CASE WHEN c_custkey % 23 = 0 THEN NULL
                ELSE substr('{"".join(LABELS)}-', CAST(c_custkey % 20 + 1 AS INTEGER), 1) END AS vict_descent
    FROM orders JOIN customer ON o_custkey = c_custkey
)"""

GEO = """
geo AS (
    SELECT DISTINCT lat, lon,
           CASE WHEN (dr_no % 3500) % 41 = 0 THEN NULL
                ELSE CAST(90000 + (dr_no % 3500) % 25 AS VARCHAR)
                     || CASE WHEN (dr_no % 3500) % 3 = 0 THEN ';90013' ELSE '' END END AS zip_raw
    FROM inc
    WHERE lat <> 0 OR lon <> 0
)"""

INCOME = """
income AS (
    SELECT CAST(90000 + n_nationkey AS VARCHAR) AS zip,
           CASE WHEN n_nationkey % 8 = 7 THEN NULL
                ELSE CAST((20 + ((n_nationkey * 37) % 25) * 3) * 1000 AS INTEGER) END AS income
    FROM nation
)"""

STATIONS = """
stations AS (
    SELECT CAST(n_nationkey AS INTEGER) AS prec, n_name AS division,
           33.7e0 + (n_nationkey % 700) / 1000 AS st_lat,
           -118.7e0 + (n_nationkey % 500) / 1000 AS st_lon
    FROM nation
)"""

JOINED_1997 = """
joined AS (
    SELECT i.dr_no, i.vict_descent, substr(g.zip_raw, 1, 5) AS zip, m.income
    FROM inc i
    JOIN geo g ON i.lat = g.lat AND i.lon = g.lon
    JOIN income m ON substr(g.zip_raw, 1, 5) = m.zip
    WHERE i.vict_descent IS NOT NULL AND i.ts IS NOT NULL AND year(i.ts) = 1997
      AND g.zip_raw IS NOT NULL AND m.income IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _recode_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _band_case(t: str) -> str:
    return (f"CASE WHEN {t} BETWEEN 500 AND 1159 THEN 'Πρωί' "
            f"WHEN {t} BETWEEN 1200 AND 1659 THEN 'Απόγευμα' "
            f"WHEN {t} BETWEEN 1700 AND 2059 THEN 'Βράδυ' ELSE 'Νύχτα' END")


def _geodesic_global() -> str:
    """Distances by halving pi - lambda for every pair: no fixed-point iteration, no limit on convergence."""
    f = F_WGS84
    e2 = (A_WGS84 ** 2 - B_WGS84 ** 2) / B_WGS84 ** 2
    sphere = """
        sqrt((cos(u2) * sin(x)) ** 2 + (sin(u1 + u2) - 2e0 * sin(u1) * cos(u2) * sin(x / 2e0) ** 2) ** 2) AS ss,
        sin(u1) * sin(u2) - cos(u1) * cos(u2) * cos(x) AS cs"""
    angles = """
        atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0e0 ELSE cos(u1) * cos(u2) * sin(x) / ss END AS sa"""
    middle = "CASE WHEN 1e0 - sa * sa = 0 THEN 0e0 ELSE cs - 2e0 * sin(u1) * sin(u2) / (1e0 - sa * sa) END AS m"
    cc = f"({f / 16!r} * (1e0 - sa * sa) * (4e0 + {f!r} * (4e0 - 3e0 * (1e0 - sa * sa))))"
    turn = f"(1e0 - {cc}) * {f!r} * sa * (sig + {cc} * ss * (m + {cc} * cs * (2e0 * m * m - 1e0)))"
    series_a = "(1e0 + q / 16384e0 * (4096e0 + q * (-768e0 + q * (320e0 - 175e0 * q))))"
    series_b = "(q / 1024e0 * (256e0 + q * (-128e0 + q * (74e0 - 47e0 * q))))"
    half_cc = f"({f / 16!r} * (1e0 - s * s) * (4e0 + {f!r} * (4e0 - 3e0 * (1e0 - s * s))))"
    return f"""
WITH RECURSIVE pairs AS (
    SELECT k, lat1, lon1,
           CASE k % 4 WHEN 0 THEN -lat1 + (k % 11 - 5) / 10e0 WHEN 1 THEN lat1
                      WHEN 2 THEN CASE WHEN k % 3 = 0 THEN 90e0 ELSE -90e0 END
                      ELSE CAST(k * 13 % 161 - 80 AS DOUBLE) END AS lat2,
           CASE k % 4 WHEN 0 THEN lon1 + 180 - (k % 13) / 10e0 WHEN 1 THEN lon1
                      ELSE CAST(k * 17 % 360 - 180 AS DOUBLE) END AS lon2
    FROM (SELECT o_orderkey AS k, CAST(o_orderkey % 161 - 80 AS DOUBLE) AS lat1,
                 CAST(o_orderkey * 7 % 360 - 180 AS DOUBLE) AS lon1 FROM orders)
), start AS (
    SELECT k, atan({1 - f!r} * tan(radians(lat1))) AS u1, atan({1 - f!r} * tan(radians(lat2))) AS u2,
           pi() - abs(radians(CASE WHEN lon2 - lon1 > 180 THEN lon2 - lon1 - 360
                                   WHEN lon2 - lon1 < -180 THEN lon2 - lon1 + 360 ELSE lon2 - lon1 END)) AS gap
    FROM pairs
), halving AS (
    SELECT k, u1, u2, gap, 0e0 AS lo, gap AS hi, 0 AS i FROM start
    UNION ALL
    SELECT k, u1, u2, gap, CASE WHEN x + {turn} < gap THEN x ELSE lo END, CASE WHEN x + {turn} < gap THEN hi ELSE x END,
           i + 1
    FROM (SELECT *, {middle} FROM (SELECT *, {angles} FROM (SELECT *, {sphere}
          FROM (SELECT *, (lo + hi) / 2e0 AS x FROM halving WHERE i < 110))))
), free AS (
    SELECT k, 0e0 AS s, gap, 0 AS i FROM start WHERE u1 + u2 = 0
    UNION ALL
    SELECT k, gap / (pi() * {f!r} * (1e0 - {half_cc})), gap, i + 1 FROM free WHERE i < 20
), solved AS (
    SELECT *, (1e0 - sa * sa) * {e2!r} AS q
    FROM (SELECT *, {middle} FROM (SELECT *, {angles} FROM (SELECT *, {sphere}
          FROM (SELECT *, (lo + hi) / 2e0 AS x FROM halving WHERE i = 110))))
), lengths AS (
    SELECT k, x, u1 + u2 AS opposite, {B_WGS84 / 1000!r} * {series_a} * (sig - {series_b} * ss * (m + {series_b} / 4e0 * (
           cs * (2e0 * m * m - 1e0) - {series_b} / 6e0 * m * (4e0 * ss * ss - 3e0) * (4e0 * m * m - 3e0)))) AS km
    FROM solved
), half_round AS (
    SELECT k, {B_WGS84 / 1000!r} * {series_a} * pi() AS km FROM (SELECT k, (1e0 - s * s) * {e2!r} AS q FROM free WHERE i = 20)
)
SELECT l.k AS dr_no, CASE WHEN l.k % 37 <> 0 AND l.k % 41 <> 0 AND l.k % 43 <> 0
                          THEN round(CASE WHEN opposite = 0 AND x < 1e-12 THEN h.km ELSE l.km END, 3) END AS distance_km
FROM lengths l LEFT JOIN half_round h ON l.k = h.k
"""


def _vincenty_ctes(src: str, keep: list[str], lat1: str, lon1: str, lat2: str, lon2: str,
                   out: str = "distance_km", iterations: int = 12) -> tuple[list[str], str]:
    """Chained CTEs computing Vincenty's inverse distance; returns (ctes, last name)."""
    f = F_WGS84
    ctes: list[str] = []
    cols: dict[str, str] = {c: c for c in keep}
    prev = src
    n = 0

    def step(new: dict[str, str]) -> None:
        nonlocal prev, n
        items = dict((c, c) for c in cols)
        items.update(new)
        for c in new:
            cols[c] = c
        sel = ", ".join(f"{expr} AS {name}" for name, expr in items.items())
        name = f"vz{n}"
        ctes.append(f"{name} AS MATERIALIZED (SELECT {sel} FROM {prev})")
        prev, n = name, n + 1

    step({"vL": f"radians({lon2}) - radians({lon1})",
          "u1": f"atan({1 - f!r} * tan(radians({lat1})))",
          "u2": f"atan({1 - f!r} * tan(radians({lat2})))"})
    step({"su1": "sin(u1)", "cu1": "cos(u1)", "su2": "sin(u2)", "cu2": "cos(u2)", "lam": "vL"})

    def trig() -> None:
        step({"sl": "sin(lam)", "cl": "cos(lam)"})
        step({"ss": "sqrt((cu2 * sl) * (cu2 * sl) + (cu1 * su2 - su1 * cu2 * cl) * (cu1 * su2 - su1 * cu2 * cl))",
              "cs": "su1 * su2 + cu1 * cu2 * cl"})
        step({"sig": "atan2(ss, cs)",
              "sa": "CASE WHEN ss = 0 THEN 0.0e0 ELSE cu1 * cu2 * sl / ss END"})
        step({"c2a": "1.0e0 - sa * sa"})
        step({"c2sm": "CASE WHEN c2a = 0 THEN 0.0e0 ELSE cs - 2.0e0 * su1 * su2 / c2a END",
              "cc": f"{f / 16!r} * c2a * (4.0e0 + {f!r} * (4.0e0 - 3.0e0 * c2a))"})

    for _ in range(iterations):
        trig()
        step({"lprev": "lam",
              "lam": f"vL + (1.0e0 - cc) * {f!r} * sa * (sig + cc * ss * (c2sm + cc * cs * (-1.0e0 + 2.0e0 * c2sm * c2sm)))"})
    trig()
    e2 = (A_WGS84 ** 2 - B_WGS84 ** 2) / B_WGS84 ** 2
    step({"usq": f"c2a * {e2!r}"})
    step({"bigA": "1.0e0 + usq / 16384.0e0 * (4096.0e0 + usq * (-768.0e0 + usq * (320.0e0 - 175.0e0 * usq)))",
          "bigB": "usq / 1024.0e0 * (256.0e0 + usq * (-128.0e0 + usq * (74.0e0 - 47.0e0 * usq)))"})
    dsig = ("bigB * ss * (c2sm + bigB / 4.0e0 * (cs * (-1.0e0 + 2.0e0 * c2sm * c2sm)"
            " - bigB / 6.0e0 * c2sm * (-3.0e0 + 4.0e0 * ss * ss) * (-3.0e0 + 4.0e0 * c2sm * c2sm)))")
    step({out: f"CASE WHEN abs(lam - lprev) <= 1e-12 THEN {B_WGS84 / 1000.0!r} * bigA * (sig - ({dsig})) "
               "ELSE error('not converged') END"})
    return ctes, prev


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"sin((radians({lat2}) - radians({lat1})) / 2) * sin((radians({lat2}) - radians({lat1})) / 2)"
         f" + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * sin((radians({lon2}) - radians({lon1})) / 2) * sin((radians({lon2}) - radians({lon1})) / 2)")
    return f"{2 * R_MEAN_KM!r} * asin(sqrt(least({h}, 1.0e0)))"


FAULTY = "c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 OR c_custkey % 19 = 0"

CUSTOMER_NOTES = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       c_mktsegment || ', "' || c_name || '"' AS note
FROM customer
"""

TOP_MONTHS = _with(INC, """
counts AS (
    SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS crime_total
    FROM inc WHERE ts IS NOT NULL GROUP BY 1, 2
),
ranked AS (
    SELECT year, month, crime_total,
           CAST(rank() OVER (PARTITION BY year ORDER BY crime_total DESC) AS INTEGER) AS ranking
    FROM counts
)""") + """
SELECT year, month, crime_total, ranking FROM ranked WHERE ranking <= 3
ORDER BY year, crime_total DESC, month
"""

DAY_BAND_COUNTS = f"""
WITH ev AS (
    SELECT CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS t FROM events WHERE event_type = 'error'
)
SELECT {_band_case('t')} AS time_of_day, count(*) AS crime_total
FROM ev GROUP BY 1 ORDER BY 2 DESC, 1
"""


def _top_keys(end: str) -> str:
    best, order = ("max", "DESC") if end == "top" else ("min", "ASC")
    return f"""
keys AS (
    SELECT zip FROM joined GROUP BY zip ORDER BY {best}(income) {order}, zip LIMIT 3
)"""


def _profile(end: str, distinct: bool) -> str:
    if distinct:
        keys = _top_keys(end)
    else:
        order = "income DESC" if end == "top" else "income ASC"
        keys = f"""
keys AS (
    SELECT DISTINCT zip FROM (SELECT zip FROM joined ORDER BY {order}, zip LIMIT 3)
)"""
    return _with(INC, GEO, INCOME, JOINED_1997, keys) + f"""
SELECT {_recode_case('vict_descent')} AS vict_descent, count(*) AS total_victims
FROM joined WHERE zip IN (SELECT zip FROM keys)
GROUP BY 1 ORDER BY 2 DESC, 1
"""


def _profile_both() -> str:
    keys = """
keys AS (
    SELECT zip, 'top' AS "end" FROM (
        SELECT zip FROM joined GROUP BY zip ORDER BY max(income) DESC, zip LIMIT 3)
    UNION ALL
    SELECT zip, 'bottom' AS "end" FROM (
        SELECT zip FROM joined GROUP BY zip ORDER BY min(income) ASC, zip LIMIT 3)
)"""
    return _with(INC, GEO, INCOME, JOINED_1997, keys) + f"""
SELECT k."end" AS "end", {_recode_case('j.vict_descent')} AS vict_descent, count(*) AS total_victims
FROM joined j JOIN keys k ON j.zip = k.zip
GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC, 2
"""


def _key_list(end: str) -> str:
    return _with(INC, GEO, INCOME, JOINED_1997, _top_keys(end)) + """
SELECT string_agg(zip, ',' ORDER BY zip) AS zips FROM keys
"""


STATIONS_DUP_POINTS = """
stations_dup_points AS (
    SELECT prec, division, st_lat, st_lon FROM stations
    UNION ALL
    SELECT prec, division || '_B', st_lat, st_lon FROM stations WHERE prec % 5 = 0
)"""

STATIONS_FIRST = """
stations_first AS (
    SELECT prec, min(division) AS division, any_value(st_lat) AS st_lat, any_value(st_lon) AS st_lon
    FROM stations_dup_points GROUP BY prec
)"""


def _station_profile(source: str = "stations", extra: tuple[str, ...] = (), known: str = "true") -> str:
    firearm = f"""
pairs AS (
    SELECT s.prec, s.division, i.lat, i.lon, s.st_lat, s.st_lon
    FROM inc i JOIN {source} s ON i.area = s.prec
    WHERE i.weapon_cd IS NOT NULL AND CAST(i.weapon_cd AS VARCHAR) LIKE '1%'
      AND i.lat IS NOT NULL AND i.lon IS NOT NULL AND (i.lat <> 0 OR i.lon <> 0) AND {known}
)"""
    ctes, last = _vincenty_ctes("pairs", ["prec", "division"], "lat", "lon", "st_lat", "st_lon")
    return _with(INC, STATIONS, *extra, firearm, *ctes) + f"""
SELECT division, count(*) AS incidents_total, round(avg(distance_km), 3) AS average_distance
FROM {last} GROUP BY prec, division ORDER BY 2 DESC, 1
"""


def _geodesic_rows() -> str:
    pairs = """
pairs AS (
    SELECT i.dr_no, i.lat, i.lon, s.st_lat, s.st_lon FROM inc i JOIN stations s ON i.area = s.prec
)"""
    ctes, last = _vincenty_ctes("pairs", ["dr_no"], "lat", "lon", "st_lat", "st_lon")
    return _with(INC, STATIONS, pairs, *ctes) + f"""
SELECT dr_no, round(distance_km, 3) AS distance_km FROM {last}
"""


STATIONS_DUP = """
stations_dup AS (
    SELECT prec, division FROM stations
    UNION ALL
    SELECT prec, division || '_B' FROM stations WHERE prec % 5 = 0
)"""

JOIN_DUP = _with(INC, STATIONS, STATIONS_DUP) + """
SELECT i.dr_no, s.prec, s.division FROM inc i JOIN stations_dup s ON i.area = s.prec
"""

HOT_AREA = _with(INC, STATIONS, STATIONS_DUP, """
hot AS (
    SELECT dr_no, CAST(CASE dr_no % 3 WHEN 0 THEN 7 WHEN 1 THEN area END AS INTEGER) AS prec FROM inc
)""")

ORACLES: dict[str, str] = {
    "csv_roundtrip_scan": CUSTOMER_NOTES,
    "csv_to_parquet": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "text_line_parse": CUSTOMER_NOTES,
    "csv_reject_counts": f"""
SELECT count(*) AS n_rows, count(*) FILTER ({FAULTY}) AS n_rejects FROM customer
""",
    "csv_reject_rows": f"""
SELECT CASE WHEN c_custkey % 11 = 0 THEN c_custkey || ',cut off'
            WHEN c_custkey % 13 = 0 THEN line || ',"one, more"'
            WHEN c_custkey % 17 = 0 THEN 'key ' || line ELSE c_custkey || ',"open' END AS record,
       CASE WHEN c_custkey % 11 = 0 THEN 'too few fields' WHEN c_custkey % 13 = 0 THEN 'too many fields'
            WHEN c_custkey % 17 = 0 THEN 'value does not fit its type' ELSE 'open quote' END AS reason,
       true AS has_file, (SELECT count(*) FROM customer WHERE NOT ({FAULTY})) AS n_rows,
       (SELECT count(*) FROM customer WHERE {FAULTY}) AS n_rejects
FROM (SELECT c_custkey, concat_ws(',', c_custkey, c_name, c_nationkey, CAST(c_acctbal AS VARCHAR), c_mktsegment,
             '"' || c_mktsegment || ', ""' || c_name || '""' || '"') AS line FROM customer) WHERE {FAULTY}
""",
    "csv_accepted_rows": f"{CUSTOMER_NOTES} WHERE NOT ({FAULTY})",
    "q1_from_csv": TOP_MONTHS,
    "q1_from_raw_parquet": TOP_MONTHS,
    "q1_from_typed_parquet": TOP_MONTHS,
    "q2_from_text": f"""
WITH times AS (
    SELECT (o_orderkey % 24) * 100 + o_orderkey % 60 AS t
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 53 <> 0
)
SELECT {_band_case('t')} AS time_of_day, count(*) AS crime_total FROM times GROUP BY 1 ORDER BY 2 DESC, 1
""",
    "q3_from_typed_parquet": _profile("top", True),
    "q4_from_text": _station_profile(known="i.dr_no % 43 <> 0 AND i.dr_no % 47 <> 0 AND s.prec % 7 <> 3"),
    "sql_over_view": """
SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
""",
    "union_by_position": """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""",
    "parse_valid_dates": _with(INC) + """
SELECT dr_no, ts AS date_reported, CAST(ts AS DATE) AS report_date FROM inc WHERE ts IS NOT NULL
""",
    "monthly_counts": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS crime_total
FROM orders GROUP BY 1, 2
""",
    "monthly_rank": """
WITH counts AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) AS crime_total
    FROM orders GROUP BY 1, 2
)
SELECT year, month, crime_total,
       CAST(rank() OVER (PARTITION BY year ORDER BY crime_total DESC) AS INTEGER) AS ranking
FROM counts
""",
    "top_months_per_year": TOP_MONTHS,
    "top_months_per_year_sql": TOP_MONTHS,
    "day_band_label": f"""
WITH ev AS (SELECT event_id AS dr_no, CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS time_occ FROM events)
SELECT dr_no, time_occ, {_band_case('time_occ')} AS time_of_day FROM ev
""",
    "day_band_counts": DAY_BAND_COUNTS,
    "day_band_counts_sql": DAY_BAND_COUNTS,
    "code_prefix_filter": _with(INC) + """
SELECT dr_no, weapon_cd FROM inc WHERE CAST(weapon_cd AS VARCHAR) LIKE '1%'
""",
    "null_island_filter": _with(INC) + """
SELECT dr_no, lat, lon FROM inc WHERE lat IS NOT NULL AND lon IS NOT NULL AND (lat <> 0 OR lon <> 0)
""",
    "money_to_int": """
SELECT o_orderkey AS dr_no,
       CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE CAST(floor(o_totalprice) AS INTEGER) END AS income
FROM orders
""",
    "zip5": _with(INC, GEO) + """
SELECT lat, lon, substr(zip_raw, 1, 5) AS zip FROM geo
""",
    "recode_labels": f"""
SELECT l_orderkey, l_linenumber, {_recode_case('l_returnflag')} AS l_returnflag FROM lineitem
""",
    "filter_year": _with(INC) + """
SELECT dr_no FROM inc WHERE ts IS NOT NULL AND year(ts) = 1997
""",
    "join_two_keys": _with(INC, GEO) + """
SELECT i.dr_no, i.lat, i.lon, g.zip_raw FROM inc i JOIN geo g ON i.lat = g.lat AND i.lon = g.lon
""",
    "join_one_key_broadcast": _with(INC, STATIONS) + """
SELECT i.dr_no, s.prec, s.division FROM inc i JOIN stations s ON i.area = s.prec
""",
    "join_one_key_merge": JOIN_DUP,
    "join_one_key_shuffle_hash": JOIN_DUP,
    "join_one_key_salted": JOIN_DUP,
    "join_hot_key_salted": HOT_AREA + """
SELECT h.dr_no, h.prec, s.division FROM hot h LEFT JOIN stations_dup s ON h.prec = s.prec
""",
    "hot_keys": HOT_AREA + """
SELECT prec, count(*) AS n_rows FROM hot GROUP BY prec HAVING count(*) * 10 > (SELECT count(*) FROM hot)
""",
    "join_mixed_type_key": _with(INC, GEO) + """
SELECT g.lat, g.lon, '0' || substr(g.zip_raw, 2, 4) AS zip,
       CASE WHEN n_nationkey % 8 = 7 THEN ''
            ELSE '$' || CAST(20 + ((n_nationkey * 37) % 25) * 3 AS VARCHAR) || ',000' END AS income_raw
FROM geo g JOIN nation n ON '0' || substr(g.zip_raw, 2, 4) = lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0')
WHERE g.zip_raw IS NOT NULL
""",
    "lookup_with_default": _with(INC, STATIONS, STATIONS_DUP) + """
SELECT i.dr_no, i.area AS prec, CASE WHEN m.prec IS NULL THEN 'Unknown' ELSE m.division END AS division
FROM inc i LEFT JOIN (
    SELECT prec, min(CASE WHEN prec <> 5 THEN division END) AS division
    FROM stations_dup WHERE prec NOT IN (3, 7, 11) GROUP BY prec
) m ON i.area = m.prec
""",
    "top_k_keys": _key_list("top"),
    "bottom_k_keys": _key_list("bottom"),
    "in_list_filter": _with(INC, GEO, INCOME, JOINED_1997, _top_keys("top")) + """
SELECT dr_no, zip, income FROM joined WHERE zip IN (SELECT zip FROM keys)
""",
    "semi_join_filter": _with(INC, GEO, INCOME, JOINED_1997, _top_keys("top")) + """
SELECT dr_no, zip, income FROM joined WHERE zip IN (SELECT zip FROM keys)
""",
    "group_count_avg": """
SELECT l_returnflag, count(*) AS n_rows, round(avg(l_quantity), 3) AS avg_qty FROM lineitem GROUP BY 1
""",
    "composite_reduce_mean": """
SELECT l_returnflag, lower(l_returnflag) AS flag_lower, count(*) AS n_rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 3) AS mean_price
FROM lineitem GROUP BY 1
""",
    "geodesic_km": _geodesic_rows(),
    "geodesic_km_global": _geodesic_global(),
    "udf_distance": _with(INC, STATIONS) + f"""
SELECT i.dr_no, round({_haversine('i.lat', 'i.lon', 's.st_lat', 's.st_lon')}, 3) AS distance_km
FROM inc i JOIN stations s ON i.area = s.prec
""",
    "profile_top_income_zips": _profile("top", True),
    "profile_bottom_income_zips": _profile("bottom", True),
    "profile_top_income_rows": _profile("top", False),
    "profile_bottom_income_rows": _profile("bottom", False),
    "profile_top_income_broadcast": _profile("top", True),
    "profile_top_income_merge": _profile("top", True),
    "profile_both_ends": _profile_both(),
    "station_profile": _station_profile(),
    "station_profile_broadcast": _station_profile(),
    "station_profile_merge": _station_profile(),
    "station_profile_map_lookup": _station_profile("stations_first", (STATIONS_DUP_POINTS, STATIONS_FIRST)),
    "station_profile_all_pairs": _station_profile("stations_dup_points", (STATIONS_DUP_POINTS,)),
    "result_size": _with(INC, STATIONS) + """
SELECT count(*) AS n_rows FROM (
    SELECT DISTINCT s.prec FROM inc i JOIN stations s ON i.area = s.prec
    WHERE i.weapon_cd IS NOT NULL AND CAST(i.weapon_cd AS VARCHAR) LIKE '1%'
      AND i.lat IS NOT NULL AND i.lon IS NOT NULL AND (i.lat <> 0 OR i.lon <> 0)
)
""",
}
