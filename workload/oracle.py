"""The same results in DuckDB SQL, written from the rules and not from the code."""

from __future__ import annotations

_RAW = """
raw AS (
  SELECT event_type AS vendor_id,
         CAST(ts AS VARCHAR) AS tpep_pickup_datetime,
         CAST(ts + to_minutes(event_id % 97 - 5) AS VARCHAR) AS tpep_dropoff_datetime,
         CASE WHEN event_id % 101 = 0 THEN 'n/a'
              WHEN event_id % 3 = 0 THEN CAST(user_id % 7 AS VARCHAR) || '.0'
              ELSE CAST(user_id % 7 AS VARCHAR) END AS passenger_count,
         CAST(CAST(value / 10 AS DECIMAL(18, 3)) AS VARCHAR) AS trip_distance,
         CAST(event_id % 6 AS VARCHAR) AS rate_code_id,
         CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
         CAST(user_id % 25 AS VARCHAR) AS pulocation_id,
         CAST((user_id * 7) % 25 AS VARCHAR) AS dolocation_id,
         CAST(event_id % 5 AS VARCHAR) AS payment_type,
         CASE WHEN event_id % 89 <> 0
              THEN CAST(CAST(value - 5.0 AS DECIMAL(18, 2)) AS VARCHAR) END AS fare_amount,
         '0.5' AS extra,
         '0.5' AS mta_tax,
         CAST(CAST(value * 0.15 AS DECIMAL(18, 4)) AS VARCHAR) AS tip_amount,
         '0.0' AS tolls_amount,
         '0.3' AS improvement_surcharge,
         CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) AS total_amount,
         '0.0' AS congestion_surcharge
  FROM events
)"""

_TYPED = (
    _RAW
    + """,
typed AS (
  SELECT vendor_id,
         TRY_CAST(regexp_replace(passenger_count, '\\.0$', '') AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(rate_code_id AS INTEGER) AS rate_code_id,
         store_and_fwd_flag,
         CAST(pulocation_id AS INTEGER) AS pulocation_id,
         CAST(dolocation_id AS INTEGER) AS dolocation_id,
         CAST(payment_type AS INTEGER) AS payment_type,
         CAST(fare_amount AS DOUBLE) AS fare_amount,
         CAST(extra AS DOUBLE) AS extra,
         CAST(mta_tax AS DOUBLE) AS mta_tax,
         CAST(tip_amount AS DOUBLE) AS tip_amount,
         CAST(tolls_amount AS DOUBLE) AS tolls_amount,
         CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
         CAST(year(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_year,
         CAST(month(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_month,
         CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime
  FROM raw
)"""
)

_VALID = "fare_amount >= 0 AND passenger_count > 0 AND dropoff_datetime >= pickup_datetime"

_DURATION = "(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60.0"
_DAY_PART = """CASE WHEN hour(pickup_datetime) BETWEEN 5 AND 11 THEN 'morning'
              WHEN hour(pickup_datetime) BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN hour(pickup_datetime) BETWEEN 17 AND 20 THEN 'evening'
              ELSE 'night' END"""
_WEEKEND = "dayofweek(pickup_datetime) IN (0, 6)"
_TIP = "CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100.0 ELSE 0.0 END"

_DERIVED = f"""
         {_DURATION} AS trip_duration_minutes,
         {_DAY_PART} AS time_of_day,
         {_WEEKEND} AS is_weekend,
         {_TIP} AS tip_percentage"""

# Copies of a trip agree in all columns shown, so distinct rows are the trips.
_SILVER = (
    _TYPED
    + f""",
silver AS (
  SELECT DISTINCT *, {_DERIVED}
  FROM typed WHERE {_VALID}
)"""
)

_NATIVE = """
native AS (
  SELECT event_id,
         event_type AS vendor_id,
         ts AS pickup_datetime,
         ts + to_minutes(event_id % 97 - 5) AS dropoff_datetime,
         CASE WHEN event_id % 101 <> 0 THEN CAST(user_id % 7 AS INTEGER) END AS passenger_count,
         value / 10 AS trip_distance,
         CAST(user_id % 25 AS INTEGER) AS pulocation_id,
         CAST((user_id * 7) % 25 AS INTEGER) AS dolocation_id,
         CASE WHEN event_id % 89 <> 0 THEN value - 5.0 END AS fare_amount,
         value * CAST(0.15 AS DOUBLE) AS tip_amount,
         value AS total_amount
  FROM events
)"""

_LINES = """
lines AS (
  SELECT CAST(l_suppkey AS INTEGER) AS pulocation_id,
         CAST(year(l_shipdate) AS INTEGER) AS pickup_year,
         CAST(month(l_shipdate) AS INTEGER) AS pickup_month,
         l_extendedprice AS total_amount,
         l_extendedprice AS fare_amount,
         l_discount AS tip_amount,
         l_quantity AS trip_distance
  FROM lineitem
)"""


def _sum(column: str) -> str:
    """Exact sum at four decimals, as a double."""
    return f"(CAST(sum(CAST(round({column} * 10000) AS BIGINT)) AS DOUBLE) / 10000.0)"


def _avg(column: str) -> str:
    return f"({_sum(column)} / count({column}))"


_COUNT = "CAST(count(*) AS INTEGER) AS total_trips"
_REVENUE = f"{_sum('total_amount')} AS total_revenue"
_MEANS = f"{_avg('fare_amount')} AS avg_fare, {_avg('tip_amount')} AS avg_tip"
_PER_MILE = f"""CASE WHEN {_sum('trip_distance')} > 0
       THEN {_sum('total_amount')} / {_sum('trip_distance')} ELSE 0.0 END AS revenue_per_mile"""


def _gold(ctes: str, relation: str, *measures: str) -> str:
    return f"""WITH {ctes}
SELECT pulocation_id AS zone_id, pickup_year AS year, pickup_month AS month,
       {', '.join(measures)}
FROM {relation} GROUP BY ALL"""


_GOLD_OF_LINES = _gold(_LINES, "lines", _COUNT, _REVENUE, _MEANS, _PER_MILE)
_GOLD_OF_TRIPS = _gold(_SILVER, "silver", _COUNT, _REVENUE, _MEANS, _PER_MILE)

_BRONZE_MONTHS = f"""WITH {_RAW}
SELECT CAST(year(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_year,
       CAST(month(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_month,
       2 * count(*) AS rows, count(*) AS resent_rows,
       count(DISTINCT tpep_pickup_datetime) AS pickups
FROM raw GROUP BY ALL"""

_INTEGER_TEXT = "regexp_matches(text, '^ *[+-]?[0-9]*\\.?[0-9]* *$') AND text <> ''"
_WHOLE = (
    "regexp_extract(text, '^ *([+-]?)', 1) || '0' || regexp_extract(text, '^ *[+-]?([0-9]*)', 1)"
)


_LINE_PICKUPS = """
SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_shipdate END AS moment,
       CASE WHEN l_orderkey % 97 = 0 THEN 'on ' || l_shipdate
            ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS pickup
FROM lineitem"""


def _per_month(pickups: str) -> str:
    """Rows and distinct pickup texts of each month, null for unreadable ones."""
    return f"""
SELECT CAST(year(moment) AS INTEGER) AS pickup_year, CAST(month(moment) AS INTEGER) AS pickup_month,
       count(*) AS rows, count(DISTINCT pickup) AS pickups
FROM ({pickups}) GROUP BY ALL"""


def _matched(column: str) -> str:
    """Rows up to an eighth of a column's greatest value; files are to be skipped."""
    return f"""
SELECT '{column}' AS filtered, TRUE AS skips, count(*) AS matched
FROM lineitem WHERE {column} <= (SELECT max({column}) / 8 FROM lineitem)"""


def _exact(column: str) -> str:
    """Exact sum of doubles, added as integers of 2^-72; digits, unlike a cast, are rounded once."""
    units = f"sum(CAST({column} * pow(2.0, 72) AS HUGEINT))"
    return f"(CAST(CAST({units} AS VARCHAR) AS DOUBLE) / pow(2.0, 72))"


_GOLD_EXACT = _gold(
    _LINES,
    "lines",
    _COUNT,
    f"{_exact('total_amount')} AS total_revenue",
    f"{_exact('fare_amount')} / count(fare_amount) AS avg_fare",
    f"{_exact('tip_amount')} / count(tip_amount) AS avg_tip",
    f"""CASE WHEN {_exact('trip_distance')} > 0
       THEN {_exact('total_amount')} / {_exact('trip_distance')} ELSE 0.0 END AS revenue_per_mile""",
)


def _select(ctes: str, columns: str, relation: str, where: str = "") -> str:
    return f"WITH {ctes}\nSELECT {columns} FROM {relation}" + (f"\nWHERE {where}" if where else "")


ORACLE = {
    "csv_scan_strings": _select(_RAW, "*", "raw"),
    "source_fallback": _select(_RAW, "*", "raw"),
    "csv_scan_by_header": _select(_RAW, "*", "raw"),
    "bronze_sized_files": f"""
SELECT CAST(year(moment) AS INTEGER) AS pickup_year, count(*) AS rows, TRUE AS near
FROM ({_LINE_PICKUPS}) GROUP BY ALL""",
    "bronze_audit": """
SELECT event_id, TRUE AS has_ingest_time, TRUE AS has_source_file,
       CAST(year(ts) AS INTEGER) AS pickup_year, CAST(month(ts) AS INTEGER) AS pickup_month
FROM events""",
    "bronze_partition_append": _BRONZE_MONTHS,
    "bronze_partition_append_rebalanced": _BRONZE_MONTHS,
    "bronze_months": _per_month(_LINE_PICKUPS),
    "bronze_overwrite": _per_month(_LINE_PICKUPS),
    "append_unregistered": _per_month(
        f"{_LINE_PICKUPS} UNION ALL SELECT CAST(ts AS TIMESTAMP), CAST(ts AS VARCHAR) FROM events"
    ),
    "typing_null_policy": _select(_TYPED, "*", "typed"),
    "typing_mixed_text": f"""
WITH shaped AS (
  SELECT event_id,
         CASE event_id % 8
           WHEN 0 THEN CAST(event_id AS VARCHAR)
           WHEN 1 THEN ' ' || CAST(event_id AS VARCHAR) || '.0 '
           WHEN 2 THEN '-' || CAST(event_id AS VARCHAR) || '.75'
           WHEN 3 THEN ''
           WHEN 4 THEN props
           WHEN 5 THEN CAST(event_id * 1000000000 AS VARCHAR)
           WHEN 6 THEN '.' || CAST(event_id AS VARCHAR)
           ELSE CAST(ts AS VARCHAR) END AS text
  FROM events
)
SELECT event_id,
       CASE WHEN {_INTEGER_TEXT} THEN TRY_CAST({_WHOLE} AS INTEGER) END AS as_int,
       CASE WHEN {_INTEGER_TEXT} THEN TRY_CAST({_WHOLE} AS BIGINT) END AS as_bigint,
       TRY_CAST(trim(text) AS DOUBLE) AS as_double,
       CASE WHEN contains(text, '-0') THEN CAST(TRY_CAST(text AS TIMESTAMP) AS VARCHAR)
            WHEN regexp_matches(text, '^[0-9]{{4}}$') THEN text || '-01-01 00:00:00'
            WHEN regexp_matches(text, '^[0-9]{{5,6}}$') THEN '+' || text || '-01-01 00:00:00'
       END AS as_moment
FROM shaped""",
    "rename_drop_project": _select(
        _TYPED,
        "pickup_datetime AS started, dropoff_datetime AS ended, payment_type, 'USD' AS currency",
        "typed",
    ),
    "valid_rows": _select(_NATIVE, "*", "native", _VALID),
    "valid_fare": _select(_NATIVE, "*", "native", "fare_amount >= 0"),
    "valid_passengers": _select(_NATIVE, "*", "native", "passenger_count > 0"),
    "valid_order": _select(_NATIVE, "*", "native", "dropoff_datetime >= pickup_datetime"),
    "valid_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount
FROM lineitem WHERE l_quantity >= 0 AND l_discount > 0""",
    "epoch_of_pickup": _select(
        _NATIVE, "event_id, CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS pickup_seconds", "native"
    ),
    "trip_duration": _select(_NATIVE, f"event_id, {_DURATION} AS trip_duration_minutes", "native"),
    "calendar_parts": _select(
        _NATIVE,
        """event_id,
       CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
       CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
       CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_weekday""",
        "native",
    ),
    "time_of_day": _select(_NATIVE, f"event_id, {_DAY_PART} AS time_of_day", "native"),
    "weekend_flag": _select(_NATIVE, f"event_id, {_WEEKEND} AS is_weekend", "native"),
    "tip_percentage": _select(_NATIVE, f"event_id, {_TIP} AS tip_percentage", "native"),
    "derived_all": _select(_NATIVE, f"*, {_DERIVED}", "native"),
    "dedup_any": _select(
        _NATIVE,
        """DISTINCT vendor_id, pickup_datetime, dropoff_datetime, pulocation_id, dolocation_id,
       passenger_count, trip_distance, fare_amount, total_amount""",
        "native",
    ),
    "dedup_first_by": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_extendedprice NULLS FIRST,
           l_shipdate NULLS FIRST, l_quantity NULLS FIRST, l_discount NULLS FIRST,
           l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1""",
    "row_counts": f"""
WITH {_SILVER}
SELECT (SELECT 2 * count(*) FROM typed) AS rows_in,
       (SELECT 2 * count(*) FROM typed WHERE {_VALID}) AS rows_valid,
       (SELECT count(*) FROM silver) AS rows_unique""",
    "gold_count": _gold(_LINES, "lines", _COUNT),
    "gold_sum": _gold(_LINES, "lines", _REVENUE),
    "gold_avg": _gold(_LINES, "lines", _MEANS),
    "gold_ratio": _gold(_LINES, "lines", _PER_MILE),
    "gold_metrics": _GOLD_OF_LINES,
    "gold_bigint": _GOLD_OF_LINES.replace("CAST(count(*) AS INTEGER)", "count(*)"),
    "gold_metrics_default": _GOLD_EXACT,
    "gold_metrics_of_trips": _GOLD_OF_TRIPS,
    "silver_replace": _select(_SILVER, "*", "silver"),
    "gold_replace": _GOLD_OF_LINES,
    "replace_managed": _GOLD_OF_LINES,
    "replace_partitioned": _GOLD_OF_LINES,
    "layout_zorder": _GOLD_OF_LINES,
    "layout_range": _GOLD_OF_LINES,
    "layout_zorder_files": f"{_matched('l_partkey')} UNION ALL {_matched('l_suppkey')}",
    "layout_range_files": _matched("l_partkey"),
    "layout_overlaps": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, count(*) AS rows,
       CAST(sum(l_partkey) AS BIGINT) AS parts, year(l_shipdate) = 2000 AND month(l_shipdate) = 5 AS rewritten
FROM lineitem GROUP BY ALL""",
    "bronze_job": f"""
WITH {_RAW},
dated AS (
  SELECT *, CAST(year(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_year,
         CAST(month(CAST(tpep_pickup_datetime AS TIMESTAMP)) AS INTEGER) AS pickup_month
  FROM raw
)
SELECT * FROM dated UNION ALL SELECT * FROM dated""",
    "silver_job": _select(_SILVER, "*", "silver"),
    "silver_after_growth": _select(_SILVER, "*", "silver"),
    "silver_after_partition_drop": """
WITH months AS (
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS pickup_year, CAST(month(l_shipdate) AS INTEGER) AS pickup_month
  FROM lineitem
), bronze AS (
  SELECT * FROM months WHERE l_orderkey % 97 = 0 OR NOT (pickup_year = 1995 AND pickup_month = 3)
)
SELECT pickup_year, pickup_month,
       count(DISTINCT (l_returnflag, CAST(l_shipdate AS DATE), l_suppkey, l_partkey, l_linenumber, l_quantity,
                       l_extendedprice)) AS trips,
       (SELECT count(*) FROM bronze) AS rows_in
FROM bronze WHERE l_orderkey % 97 <> 0 AND l_extendedprice >= 0 AND l_linenumber > 0
GROUP BY pickup_year, pickup_month""",
    "silver_job_counts": f"""
WITH {_SILVER}
SELECT (SELECT count(*) FROM silver) AS rows_in_table,
       (SELECT 2 * count(*) FROM typed) AS rows_in,
       (SELECT count(*) FROM silver) AS rows_out""",
    "gold_job": _GOLD_OF_TRIPS,
    "full_pipeline": _GOLD_OF_TRIPS,
}
