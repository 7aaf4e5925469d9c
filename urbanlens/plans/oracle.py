"""Independent DuckDB SQL for every catalogue query.

Written straight from the question over the raw tables (no shared code with
the Spark side), with output names and types matching the Spark results:
``year``/``month``/``hour``/``ranking`` are INTEGER, counts and sums BIGINT.
"""

from __future__ import annotations

from urbanlens.plans import inputs as I

_DEG = "0.017453292519943295"  # degrees -> radians factor, as a double literal

_PERIOD = """CASE WHEN c BETWEEN 500 AND 1159 THEN 'morning'
                  WHEN c BETWEEN 1200 AND 1659 THEN 'afternoon'
                  WHEN c BETWEEN 1700 AND 2059 THEN 'evening'
                  ELSE 'night' END"""


def _share(round_fn: str, table_sql: str = "events") -> str:
    return f"""
WITH e AS (SELECT {_PERIOD} AS period
           FROM (SELECT hour(ts) * 100 + minute(ts) AS c FROM {table_sql} WHERE event_type = 'error')),
     g AS (SELECT period, count(*) AS n FROM e GROUP BY period)
SELECT period, {round_fn}(n * 100 / sum(n) OVER (), 2) AS percentage
FROM g ORDER BY percentage DESC, period"""


_EVENT_TYPE_COUNTS = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"

_INCOME = """CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(floor(s_acctbal) AS DOUBLE) END"""


def _coord(key: str, base: float, mult: int, span: int) -> str:
    return f"({base}::DOUBLE + (({key} * {mult}) % {span}) / {I.COORD_SCALE}::DOUBLE)"


def _pairs(site: str = "{0}", tie: str = "ord") -> str:
    plat = _coord("c_custkey", I.LAT_BASE, I.POINT_LAT_MULT, I.LAT_SPAN)
    plon = _coord("c_custkey", I.LON_BASE, I.POINT_LON_MULT, I.LON_SPAN)
    slat = _coord("s_suppkey", I.LAT_BASE, I.SITE_LAT_MULT, I.LAT_SPAN)
    slon = _coord("s_suppkey", I.LON_BASE, I.SITE_LON_MULT, I.LON_SPAN)
    return f"""
p AS (SELECT c_custkey, {plat} * {_DEG} AS la, {plon} * {_DEG} AS lo FROM customer),
s AS (SELECT s_suppkey AS ord, s_name AS division, {site.format(slat)} * {_DEG} AS la, {site.format(slon)} * {_DEG} AS lo
      FROM supplier),
h AS (SELECT p.c_custkey, s.ord, s.division,
             sin((s.la - p.la) / 2) * sin((s.la - p.la) / 2)
             + cos(p.la) * cos(s.la) * (sin((s.lo - p.lo) / 2) * sin((s.lo - p.lo) / 2)) AS a
      FROM p CROSS JOIN s),
d AS (SELECT c_custkey, ord, division,
             2 * 6371.0::DOUBLE * atan2(sqrt(a), sqrt(greatest(1 - a, 0.0))) AS distance FROM h),
best AS (SELECT c_custkey, arg_min(division, (distance, {tie})) AS division, min(distance) AS distance
         FROM d GROUP BY c_custkey)"""


_BLOCKS = """SELECT CASE WHEN l_orderkey % 11 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS zip,
                    CASE WHEN l_linenumber % 4 = 0 OR l_suppkey % 13 = 0 THEN 0
                         ELSE CAST(l_quantity AS BIGINT) END AS population,
                    CAST(l_linenumber AS BIGINT) AS housing FROM lineitem"""

_AREA_RATIO = f"""
WITH b AS (SELECT zip, CAST(sum(population) AS BIGINT) AS p, CAST(sum(housing) AS BIGINT) AS h
           FROM ({_BLOCKS}) GROUP BY zip),
     i AS (SELECT CAST(s_suppkey AS VARCHAR) AS zip, {_INCOME} AS income FROM supplier
           UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 1234.0 FROM supplier WHERE s_suppkey % 10 = 0)
SELECT b.zip, round(CAST(h AS DOUBLE) * income / CAST(NULLIF(p, 0) AS DOUBLE)) AS average_income
FROM b JOIN i ON b.zip = i.zip"""


def _area_ratio_strict(where: str, rounded: str = "round_even({0}, 2)") -> str:
    return f"""
WITH b AS (SELECT zip, CAST(sum(population) AS BIGINT) AS p, CAST(sum(housing) AS BIGINT) AS h
           FROM ({_BLOCKS})
           WHERE zip IS NOT NULL AND population IS NOT NULL AND housing IS NOT NULL AND population > 0
           GROUP BY zip),
     i AS (SELECT CAST(s_suppkey AS VARCHAR) AS zip, CAST(floor(s_acctbal) AS BIGINT) AS income
           FROM supplier WHERE s_acctbal >= 0 AND {where}
           UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 1234 FROM supplier WHERE s_suppkey % 10 = 0 AND {where})
SELECT b.zip, {rounded.format("CAST(h AS DOUBLE) * CAST(income AS DOUBLE) / CAST(p AS DOUBLE)")} AS average_income
FROM b JOIN i ON b.zip = i.zip WHERE p <> 0"""


def _counted(source: str, table: str, **conditions: str) -> str:
    return " UNION ALL ".join(f"SELECT '{source}' AS source, '{what}' AS what, count(*) AS n FROM {table} WHERE {where}"
                              for what, where in {"rows": "TRUE", **conditions}.items())


_SOURCE_REJECTS = " UNION ALL ".join((
    _counted("crimes", "events", bad_date="event_id % 5 = 0 OR (event_id % 5 <> 0 AND ts IS NULL)",
             bad_clock="event_id % 5 = 1", bad_coordinates="event_id % 5 IN (3, 4)"),
    _counted("blocks", "lineitem", no_key="l_linenumber = 1", bad_population="l_linenumber = 2",
             bad_housing="l_linenumber = 5"),
    _counted("income", "supplier", short_line="FALSE", bad_income="s_acctbal < 0",
             not_whole="s_acctbal < 0 OR s_suppkey % 7 = 0"),
    _counted("stations", "supplier", bad_coordinates="s_suppkey % 3 = 0"),
))


# Digits of a double's exact value, as text: no rounding of its shortest decimal form.
_BINARY = "CAST(printf('%.{1}f', {0}) AS DOUBLE)"

_ROUGH_SHARE = f"""
SELECT 'share' AS source, period AS what, CAST(round(round(n * 100 / sum(n) OVER (), 2) * 100) AS BIGINT) AS n
FROM (SELECT period, count(*) AS n FROM (
  SELECT {_PERIOD} AS period FROM (SELECT CASE WHEN event_id % 5 IN (1, 2) THEN NULL ELSE hour(ts) * 100 + minute(ts) END AS c
                                   FROM events WHERE event_type = 'error')) GROUP BY period)"""

_ROUGH_LINES = """
SELECT CAST(s_suppkey AS VARCHAR) AS line, 'too few fields' AS reason FROM supplier WHERE s_suppkey % 9 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'too few fields' FROM supplier WHERE s_suppkey % 9 = 0 AND s_suppkey % 10 = 0"""


def _monthly(rank_fn: str, order_tail: str) -> str:
    return f"""
WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                  count(*) AS crime_total
           FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
     r AS (SELECT *, CAST({rank_fn}() OVER (PARTITION BY year ORDER BY crime_total DESC{order_tail})
                         AS INTEGER) AS ranking FROM c)
SELECT year, month, crime_total, ranking FROM r WHERE ranking <= 3
ORDER BY year, crime_total DESC, ranking, month"""


_MONTHLY_PER_SOURCE = f"""
WITH src AS (SELECT o_orderdate AS t,
                    CASE WHEN o_orderdate < TIMESTAMP '{I.ORDERS_SPLIT}' THEN 0 ELSE 1 END AS source
             FROM orders WHERE o_orderdate IS NOT NULL),
     c AS (SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, source,
                  count(*) AS crime_total FROM src GROUP BY 1, 2, 3),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month, source)
                         AS INTEGER) AS ranking FROM c)
SELECT year, month, crime_total, ranking FROM r WHERE ranking <= 3
ORDER BY year, crime_total DESC, ranking"""


def _site_coords_sql() -> str:
    return (f"{_coord('s_suppkey', I.LON_BASE, I.SITE_LON_MULT, I.LON_SPAN)} AS lon, "
            f"{_coord('s_suppkey', I.LAT_BASE, I.SITE_LAT_MULT, I.LAT_SPAN)} AS lat")


_NEAREST_SUMMARY = f"""WITH {_pairs()}
SELECT division, round(avg(distance), 2) AS avg_distance, count(*) AS crime_total
FROM best GROUP BY division"""

ORACLE_SQL: dict[str, str] = {
    "time_of_day_share": _share("round"),
    "time_of_day_share_half_even": _share("round_even"),
    "time_of_day_share_udf": _share("round"),
    "time_of_day_share_two_sources": _share("round"),
    "time_of_day_share_csv": _share("round"),
    "time_of_day_share_parquet": _share("round"),
    "csv_parquet_roundtrip": _EVENT_TYPE_COUNTS,
    "event_time_parse": """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3""",
    "semicolon_csv_scan": f"SELECT s_suppkey, {_INCOME} AS income FROM supplier",
    "multiline_json_scan": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "single_file_csv_sink": _EVENT_TYPE_COUNTS,
    "monthly_top3_rank": _monthly("rank", ""),
    "monthly_top3_row_number": _monthly("row_number", ", month"),
    "monthly_top3_rank_text": _monthly("rank", ""),
    "monthly_top3_per_source": _MONTHLY_PER_SOURCE,
    "monthly_top3_per_source_df": _MONTHLY_PER_SOURCE,
    "feature_flatten": f"SELECT s_suppkey, s_name, s_nationkey, {_site_coords_sql()} FROM supplier",
    "money_clean": f"SELECT s_suppkey, {_INCOME} AS income FROM supplier",
    "area_ratio": _AREA_RATIO,
    "area_ratio_broadcast": _AREA_RATIO,
    "area_ratio_merge": _AREA_RATIO,
    "area_ratio_shuffle_hash": _AREA_RATIO,
    "area_ratio_strict": _area_ratio_strict("TRUE"),
    "area_ratio_strict_csv": _area_ratio_strict("s_suppkey % 7 <> 0 AND s_suppkey % 9 <> 0"),
    "area_ratio_feature_lines": _AREA_RATIO,
    "source_rejects": _SOURCE_REJECTS,
    "area_ratio_geojson": _AREA_RATIO,
    "nearest_site_assign": f"WITH {_pairs()} SELECT c_custkey, division, round(distance, 6) AS distance FROM best",
    "nearest_site_assign_grid": f"WITH {_pairs()} SELECT c_custkey, division, round(distance, 6) AS distance FROM best",
    # Of the odd coordinates only 95.5 (out of the usual range, but a number) is kept.
    "nearest_site_rejects": """
SELECT 'rows' AS what, count(*) AS n FROM customer
UNION ALL SELECT 'bad_coordinates', count(*) FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 5 <> 4
UNION ALL SELECT 'assigned', count(*) FROM customer WHERE NOT (c_custkey % 7 = 0 AND c_custkey % 5 <> 4)""",
    "nearest_site_summary": _NEAREST_SUMMARY,
    "nearest_site_summary_csv": _NEAREST_SUMMARY,
    "geojson_split_scan": "SELECT c_custkey, c_name || '}\"{[\\' AS c_name, c_nationkey FROM customer",
    "area_ratio_geojson_split": _AREA_RATIO,
    "mixed_headers_scan": f"SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 <> 2 THEN {_INCOME} END AS income FROM supplier",
    "quarantine_rows": _area_ratio_strict("s_suppkey % 7 <> 0 AND s_suppkey % 9 <> 0"),
    "quarantine_lines": _ROUGH_LINES,
    "nearest_site_file_order": f"""WITH {_pairs("(floor({0} * 10) / 10)", "-ord")}
SELECT c_custkey, division, round(distance, 6) AS distance FROM best""",
    "binary_rounding": f"""
SELECT l_orderkey, l_linenumber, {_BINARY.format("x", 2)} AS cents, {_BINARY.format("x * 1.1::DOUBLE", 1)} AS tenths
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS DOUBLE) + CAST(l_orderkey % 100 AS DOUBLE) / 100.0::DOUBLE
             + 0.005::DOUBLE AS x FROM lineitem)""",
    "area_ratio_binary": _area_ratio_strict("TRUE", _BINARY.replace("{1}", "2")),
    "nearest_site_exact_mean": f"""WITH {_pairs()}
SELECT division, round(CAST(sum(CAST(round(distance * 1099511627776) AS HUGEINT)) AS DOUBLE) / count(*) / 1099511627776, 6)
  AS avg_distance, count(*) AS crime_total FROM best GROUP BY division""",
    "observed_rejects": f"{_SOURCE_REJECTS} UNION ALL {_ROUGH_SHARE}",
    "ordered_single_file": "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS line FROM customer",
}
