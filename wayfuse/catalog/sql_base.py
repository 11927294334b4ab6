"""Shared SQL for the comparison: the feeds, the canonical rows and the check log as CTEs."""

from __future__ import annotations

import re

from wayfuse.spec import ADAPTERS, CANONICAL_FIELDS, NON_NULLABLE, STRUCTURAL_GAPS

US_LAYOUT = "%m/%d/%Y %I:%M:%S %p"
INGESTED = "2026-01-05 06:00:00"


def _pad(n: str, width: int) -> str:
    return f"lpad(CAST({n} AS VARCHAR), {width}, '0')"


def pct(part: str, whole: str, digits: int) -> str:
    """100 * part / whole rounded half up, in whole numbers."""
    scale = 10 ** digits
    w, p = f"CAST({whole} AS HUGEINT)", f"CAST({part} AS HUGEINT)"
    return (f"CASE WHEN ({whole}) <> 0 THEN CAST((({p}) * {200 * scale} + {w}) // (2 * {w}) AS DOUBLE) "
            f"/ {scale} END")


def round_half_up(x: str, digits: int) -> str:
    scale = 10 ** digits
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale})"


def utc(local: str, zone: str) -> str:
    """UTC time of a wall-clock time, null where the clock shows it twice or never."""
    u = f"(({local} AT TIME ZONE '{zone}') AT TIME ZONE 'UTC')"

    def back(x):
        return f"((({x}) AT TIME ZONE 'UTC') AT TIME ZONE '{zone}')"
    return (f"CASE WHEN {back(u)} = {local} AND {back(u + ' + INTERVAL 1 HOUR')} <> {local} "
            f"AND {back(u + ' - INTERVAL 1 HOUR')} <> {local} THEN {u} END")


def local(ts: str = "crash_timestamp_utc", zone: str = "source_local_timezone") -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE {zone})"


def _coordinate(spots: tuple[str, str, str], suffix: str, spread: str) -> str:
    return (f"CASE WHEN k % 97 = 0 THEN '0' WHEN k % 53 = 0 THEN NULL "
            f"WHEN k % 15 = 0 THEN '{spots[0]}' || {suffix} WHEN k % 15 = 5 THEN '{spots[1]}' || {suffix} "
            f"WHEN k % 15 = 10 THEN '{spots[2]}' || {suffix} ELSE {spread} END")


RAW_A = f"""
SELECT CAST(k AS VARCHAR) AS CRASH_RECORD_ID, strftime(t, '{US_LAYOUT}') AS CRASH_DATE,
  strftime(CASE WHEN k % 5000 = 1 THEN t - INTERVAL 1 DAY
                ELSE t + to_minutes(CAST(k % 90 AS BIGINT)) END, '{US_LAYOUT}') AS DATE_POLICE_NOTIFIED,
  injury AS MOST_SEVERE_INJURY, CAST(k % 4 AS VARCHAR) AS INJURIES_TOTAL,
  CASE WHEN injury = 'FATAL' THEN '1' ELSE '0' END AS INJURIES_FATAL,
  CAST(k % 4 + 1 AS VARCHAR) AS NUM_UNITS,
  {_coordinate(("41.88", "41.75", "41.92"), _pad("q * 3 % 10", 2), "'41.' || " + _pad("6500 + k * 7919 % 3000", 4))} AS LATITUDE,
  {_coordinate(("-87.62", "-87.65", "-87.70"), _pad("q * 7 % 10", 2), "'-87.' || " + _pad("5500 + k * 104729 % 3500", 4))} AS LONGITUDE,
  CASE WHEN k % 211 = 0 THEN '0' WHEN k % 307 = 0 THEN '99' ELSE CAST(15 + k % 5 * 5 AS VARCHAR) END AS POSTED_SPEED_LIMIT,
  'TYPE_' || (k % 6) AS FIRST_CRASH_TYPE, 'CAUSE_' || (k % 12) AS PRIM_CONTRIBUTORY_CAUSE,
  'W_' || (k % 4) AS WEATHER_CONDITION, 'L_' || (k % 3) AS LIGHTING_CONDITION,
  CASE WHEN o_orderstatus = 'F' THEN 'Y' END AS HIT_AND_RUN_I,
  CAST((k % 25 + 1) * 100 + k % 30 AS VARCHAR) AS BEAT_OF_OCCURRENCE
FROM (SELECT *, o_orderkey AS k, o_orderkey // 5 AS q,
        o_orderdate + INTERVAL 23 YEAR + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)) AS t,
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 10 = 0 THEN 'FATAL'
             WHEN o_orderpriority = '1-URGENT' THEN 'INCAPACITATING INJURY'
             WHEN o_orderpriority = '2-HIGH' THEN 'NONINCAPACITATING INJURY'
             WHEN o_orderpriority = '3-MEDIUM' THEN 'REPORTED, NOT EVIDENT'
             WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 20 = 0 THEN NULL
             ELSE 'NO INDICATION OF INJURY' END AS injury
      FROM orders)
"""

RAW_B = f"""
SELECT CAST(e AS VARCHAR) AS collision_id, strftime(ts, '%Y-%m-%d') || 'T00:00:00.000' AS crash_date,
  hour(ts) || ':' || {_pad("minute(ts)", 2)} AS crash_time,
  CASE WHEN event_type = 'error' THEN CAST(e % 3 AS VARCHAR) WHEN event_type = 'click' THEN '0'
       WHEN event_type = 'signup' THEN NULL ELSE CAST(e % 2 AS VARCHAR) END AS number_of_persons_injured,
  CASE WHEN e % 9 = 0 THEN '0' END AS number_of_persons_killed,
  CASE WHEN e % 200 <> 7 THEN CASE WHEN event_type = 'purchase' AND e % 40 = 0 THEN '1' ELSE '0' END END
    AS number_of_pedestrians_killed,
  CASE WHEN e % 200 <> 7 THEN '0' END AS number_of_cyclist_killed,
  CASE WHEN e % 200 <> 7 THEN '0' END AS number_of_motorist_killed,
  CASE WHEN 1 <= user_id % 5 + 1 THEN 'V1' END AS vehicle_type_code1,
  CASE WHEN e % 11 = 0 THEN '' WHEN 2 <= user_id % 5 + 1 THEN 'V2' END AS vehicle_type_code2,
  CASE WHEN 3 <= user_id % 5 + 1 THEN 'V3' END AS vehicle_type_code_3,
  CASE WHEN 4 <= user_id % 5 + 1 THEN 'V4' END AS vehicle_type_code_4,
  CASE WHEN 5 <= user_id % 5 + 1 THEN 'V5' END AS vehicle_type_code_5,
  CASE WHEN e % 43 = 0 THEN '0' ELSE '40.' || {_pad("5000 + e * 7919 % 4000", 4)} END AS latitude,
  CASE WHEN e % 43 = 0 THEN '0' ELSE '-73.' || {_pad("7000 + e * 6007 % 2500", 4)} END AS longitude,
  json_extract_string(props, '$.k') AS contributing_factor_vehicle_1
FROM (SELECT *, event_id AS e FROM events)
"""

RAW_C = f"""
SELECT concat_ws('-', o, p, s, n) AS collision_index,
  strftime(l_shipdate + INTERVAL 20 YEAR, '%d/%m/%Y') AS date,
  {_pad("p % 24", 2)} || ':' || {_pad("s % 60", 2)} AS time,
  CASE WHEN p % 400 = 13 THEN '-1' WHEN n = 1 AND p % 50 = 0 THEN '1' WHEN l_returnflag = 'R' THEN '2'
       ELSE '3' END AS collision_severity,
  CASE WHEN s % 5 = 0 THEN '1' WHEN s % 50 = 1 THEN '48' ELSE '20' END AS police_force,
  CAST(o % 5 + 1 AS VARCHAR) AS number_of_casualties, CAST(p % 4 + 1 AS VARCHAR) AS number_of_vehicles,
  CASE WHEN p % 90 = 0 THEN '-1' ELSE CAST(20 + p % 6 * 10 AS VARCHAR) END AS speed_limit,
  CASE WHEN p % 70 = 0 THEN '-1' ELSE CAST(p % 9 + 1 AS VARCHAR) END AS weather_conditions,
  CASE WHEN p % 80 = 0 THEN '-1' ELSE CAST(p % 5 + 1 AS VARCHAR) END AS light_conditions,
  '51.' || {_pad("3000 + o * 7919 % 4000", 4)} AS latitude, '-0.' || {_pad("1000 + p * 6007 % 3000", 4)} AS longitude
FROM (SELECT *, l_orderkey AS o, l_partkey AS p, l_suppkey AS s, l_linenumber AS n FROM lineitem)
"""


def _valid(lat: str, lon: str, source: str) -> str:
    box = ADAPTERS[source].bounding_box
    (a, b), (c, d) = box["latitude"], box["longitude"]
    la, lo = f"TRY_CAST({lat} AS DOUBLE)", f"TRY_CAST({lon} AS DOUBLE)"
    return (f"CASE WHEN {la} BETWEEN {a} AND {b} AND {lo} BETWEEN {c} AND {d} "
            f"AND NOT ({la} = 0 AND {lo} = 0) THEN 'true' ELSE 'false' END")


def _filled(*slots: str) -> str:
    return " + ".join(f"CASE WHEN trim({s}) <> '' THEN 1 ELSE 0 END" for s in slots)


_KILLED = ["number_of_pedestrians_killed", "number_of_cyclist_killed", "number_of_motorist_killed"]
NYC_KILLED = " + ".join(f"coalesce(TRY_CAST({c} AS INTEGER), 0)" for c in _KILLED)
NYC_VEHICLES = _filled("vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3",
                       "vehicle_type_code_4", "vehicle_type_code_5")
_INJURED = "TRY_CAST(number_of_persons_injured AS INTEGER)"
NYC_SEVERITY = f"""CASE WHEN ({NYC_KILLED}) > 0 THEN 'fatal' WHEN {_INJURED} > 0 THEN 'minor'
  WHEN coalesce({_INJURED}, 0) = 0 AND coalesce({', '.join(_KILLED)}) IS NOT NULL THEN 'none' ELSE 'unknown' END"""
NYC_AUDIT = """'killed=' || coalesce(nullif(trim(number_of_persons_killed), ''), '0') || ',injured='
  || coalesce(nullif(trim(number_of_persons_injured), ''), '0')"""
CHICAGO_SEVERITY = """CASE MOST_SEVERE_INJURY WHEN 'FATAL' THEN 'fatal' WHEN 'INCAPACITATING INJURY' THEN 'serious'
  WHEN 'NONINCAPACITATING INJURY' THEN 'minor' WHEN 'REPORTED, NOT EVIDENT' THEN 'minor'
  WHEN 'NO INDICATION OF INJURY' THEN 'none' ELSE 'unknown' END"""
UK_SEVERITY = "CASE collision_severity WHEN '1' THEN 'fatal' WHEN '2' THEN 'serious' WHEN '3' THEN 'minor' ELSE 'unknown' END"
CHICAGO_VALID = _valid("LATITUDE", "LONGITUDE", "chicago_us")
NYC_VALID = _valid("latitude", "longitude", "nyc_us")
UK_VALID = _valid("latitude", "longitude", "uk_stats19")
UK_CITY = ("CASE WHEN regexp_replace(lower(trim(police_force)), '\\.0$', '') IN "
           "('1', '48', 'metropolitan police', 'city of london') THEN 'London' END")


def _zero(c: str, lat: str, lon: str) -> str:
    return (f"CASE WHEN TRY_CAST({lat} AS DOUBLE) = 0 AND TRY_CAST({lon} AS DOUBLE) = 0 THEN NULL ELSE {c} END")


def _staged(source: str, batch: str, raw: str, columns: dict[str, str]) -> str:
    columns = {**columns, "source_id": f"'{source}'", "batch_id": f"'{batch}'",
               "source_local_timezone": f"'{ADAPTERS[source].timezone}'",
               "ingested_at_utc": f"'{INGESTED}'"}
    return ("SELECT " + ", ".join(f"CAST({columns.get(c, 'NULL')} AS VARCHAR) AS {c}" for c in CANONICAL_FIELDS)
            + f" FROM {raw}")


STAGED_A = _staged("chicago_us", "chicago_us_b1", "raw_a", {
    "crash_id": "'chicago_us:' || CRASH_RECORD_ID", "source_record_id": "CRASH_RECORD_ID",
    "crash_timestamp_utc": "CRASH_DATE", "police_notified_timestamp_utc": "DATE_POLICE_NOTIFIED",
    "city": "'Chicago'", "country": "'US'", "latitude": _zero("LATITUDE", "LATITUDE", "LONGITUDE"),
    "longitude": _zero("LONGITUDE", "LATITUDE", "LONGITUDE"), "has_valid_coordinates": CHICAGO_VALID,
    "severity": CHICAGO_SEVERITY, "source_severity_raw": "MOST_SEVERE_INJURY",
    "num_injured_total": "INJURIES_TOTAL", "num_killed": "INJURIES_FATAL",
    "num_vehicles_involved": "NUM_UNITS", "crash_type": "FIRST_CRASH_TYPE",
    "primary_cause": "PRIM_CONTRIBUTORY_CAUSE", "weather_condition": "WEATHER_CONDITION",
    "lighting_condition": "LIGHTING_CONDITION", "posted_speed_limit_mph": "POSTED_SPEED_LIMIT",
    "hit_and_run": "CASE WHEN HIT_AND_RUN_I = 'Y' THEN 'true' ELSE 'false' END"})
STAGED_B = _staged("nyc_us", "nyc_us_b1", "raw_b", {
    "crash_id": "'nyc_us:' || collision_id", "source_record_id": "collision_id",
    "crash_timestamp_utc": "crash_date || ' ' || crash_time", "city": "'New York City'", "country": "'US'",
    "latitude": _zero("latitude", "latitude", "longitude"),
    "longitude": _zero("longitude", "latitude", "longitude"), "has_valid_coordinates": NYC_VALID,
    "severity": NYC_SEVERITY, "source_severity_raw": NYC_AUDIT,
    "num_injured_total": "number_of_persons_injured", "num_killed": NYC_KILLED,
    "num_vehicles_involved": NYC_VEHICLES, "primary_cause": "contributing_factor_vehicle_1",
    "hit_and_run": "'false'"})
STAGED_C = _staged("uk_stats19", "uk_stats19_b1", "raw_c", {
    "crash_id": "'uk_stats19:' || collision_index", "source_record_id": "collision_index",
    "crash_timestamp_utc": "date || ' ' || time", "city": UK_CITY, "country": "'GB'",
    "latitude": "nullif(latitude, '-1')", "longitude": "nullif(longitude, '-1')",
    "has_valid_coordinates": UK_VALID, "severity": UK_SEVERITY, "source_severity_raw": "collision_severity",
    "num_injured_total": "number_of_casualties", "num_vehicles_involved": "number_of_vehicles",
    "weather_condition": "nullif(weather_conditions, '-1')",
    "lighting_condition": "nullif(light_conditions, '-1')",
    "posted_speed_limit_mph": "nullif(speed_limit, '-1')", "hit_and_run": "'false'"})

PARSED = f"""
SELECT * REPLACE (
  CASE source_id WHEN 'chicago_us' THEN try_strptime(crash_timestamp_utc, '{US_LAYOUT}')
    WHEN 'uk_stats19' THEN try_strptime(crash_timestamp_utc, '%d/%m/%Y %H:%M')
    ELSE try_strptime(left(crash_timestamp_utc, 10) || ' ' || split_part(crash_timestamp_utc, ' ', 2), '%Y-%m-%d %H:%M')
    END AS crash_timestamp_utc,
  try_strptime(police_notified_timestamp_utc, '{US_LAYOUT}') AS police_notified_timestamp_utc)
FROM staged
"""


def _by_source(column: str) -> str:
    return "CASE source_id " + " ".join(
        f"WHEN '{a.source_id}' THEN {utc(column, a.timezone)}" for a in ADAPTERS.values()) + " END"


TIMED = f"""
SELECT * REPLACE ({_by_source('crash_timestamp_utc')} AS crash_timestamp_utc,
  {_by_source('police_notified_timestamp_utc')} AS police_notified_timestamp_utc)
FROM parsed
"""

CURATED = """
SELECT * REPLACE (TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
  has_valid_coordinates = 'true' AS has_valid_coordinates, hit_and_run = 'true' AS hit_and_run,
  TRY_CAST(num_injured_total AS INTEGER) AS num_injured_total, TRY_CAST(num_killed AS INTEGER) AS num_killed,
  TRY_CAST(num_vehicles_involved AS INTEGER) AS num_vehicles_involved,
  TRY_CAST(posted_speed_limit_mph AS INTEGER) AS posted_speed_limit_mph,
  CAST(ingested_at_utc AS TIMESTAMP) AS ingested_at_utc),
  CAST(crash_timestamp_utc AS DATE) AS crash_date_key,
  CAST(year(crash_timestamp_utc) AS INTEGER) AS year, CAST(month(crash_timestamp_utc) AS INTEGER) AS month
FROM timed WHERE crash_timestamp_utc IS NOT NULL
"""

LOCALISED = f"""
SELECT *, CAST({local()} AS DATE) AS local_date, CAST(hour({local()}) AS INTEGER) AS local_hour,
  CAST(isodow({local()}) - 1 AS INTEGER) AS local_dow, CAST(year({local()}) AS INTEGER) AS local_year,
  isodow({local()}) >= 6 AS is_weekend
FROM curated
"""

COMPARABLE = """
SELECT *, city AS city_area FROM localised
WHERE severity IN ('fatal', 'serious', 'minor')
  AND city = CASE source_id WHEN 'chicago_us' THEN 'Chicago' WHEN 'nyc_us' THEN 'New York City' ELSE 'London' END
"""

FRAME_CITIES = """
SELECT * FROM (VALUES ('Chicago vs London', 1, 'Chicago'), ('Chicago vs London', 1, 'London'),
  ('Chicago vs New York City', 2, 'Chicago'), ('Chicago vs New York City', 2, 'New York City'),
  ('All three cities', 3, 'Chicago'), ('All three cities', 3, 'New York City'),
  ('All three cities', 3, 'London')) AS v(frame, frame_no, city_area)
"""

FRAMES = """
SELECT frame, frame_no, cities, CASE WHEN ok THEN s END AS "start", CASE WHEN ok THEN e END AS "end",
  CASE WHEN ok THEN CAST(date_diff('day', s, e) + 1 AS INTEGER) ELSE 0 END AS days
FROM (SELECT frame, frame_no, string_agg(city_area, ', ' ORDER BY city_area) AS cities, max(first) AS s,
        min(last) AS e, count(*) = count(first) AND max(first) <= min(last) AS ok
      FROM frame_cities LEFT JOIN
        (SELECT city_area, min(local_date) AS first, max(local_date) AS last FROM comparable GROUP BY ALL) USING (city_area)
      GROUP BY ALL)
"""

IN_FRAMES = """
SELECT c.*, f.frame, f."start", f."end", f.days FROM comparable c
JOIN frame_cities fc ON fc.city_area = c.city_area
JOIN frames f ON f.frame = fc.frame AND f.days > 0 AND c.local_date BETWEEN f."start" AND f."end"
"""

CITY_FACTS = """
SELECT * FROM (VALUES ('Chicago', 2746388, 589.8), ('New York City', 8804190, 778.2), ('London', 8799800, 1572.0))
  AS v(city_area, residents, area_km2)
"""

DIM_SOURCE = """
SELECT * FROM (VALUES ('chicago_us', 'America/Chicago', 'Chicago', 'US'),
  ('nyc_us', 'America/New_York', 'New York City', 'US'), ('uk_stats19', 'Europe/London', NULL, 'GB'))
  AS v(source_id, source_local_timezone, city, country)
"""

DIM_DATE = """
SELECT DISTINCT crash_date_key AS date_key, CAST(year(crash_date_key) AS INTEGER) AS year,
  CAST(month(crash_date_key) AS INTEGER) AS month, CAST(day(crash_date_key) AS INTEGER) AS day,
  CAST(isodow(crash_date_key) - 1 AS INTEGER) AS day_of_week, isodow(crash_date_key) >= 6 AS is_weekend
FROM curated
"""


def _null_counts() -> str:
    return " + ".join(
        "count(*) FILTER (WHERE {c} IS NULL{gap})".format(c=c, gap="".join(
            f" AND source_id <> '{s}'" for s, g in STRUCTURAL_GAPS.items() if c in g))
        for c in NON_NULLABLE)


def _outside(axis: str) -> str:
    return "CASE source_id " + " ".join(
        "WHEN '{s}' THEN {x} < {a} OR {x} > {b}".format(
            s=a.source_id, x=f"TRY_CAST({axis} AS DOUBLE)", a=a.bounding_box[axis][0], b=a.bounding_box[axis][1])
        for a in ADAPTERS.values()) + " END"


_ENFORCED = "CASE source_id " + " ".join(
    f"WHEN '{s}' THEN {len(set(NON_NULLABLE) - g)}" for s, g in STRUCTURAL_GAPS.items()) + " END"

COUNTERS = f"""
SELECT s.source_id, s.batch_id, count(*) AS n, {_null_counts()} AS null_cells,
  count(*) - count(DISTINCT source_record_id) AS dup_record, count(*) - count(DISTINCT crash_id) AS dup_crash,
  count(*) FILTER (WHERE severity NOT IN ('fatal', 'serious', 'minor', 'none', 'unknown'))
    + count(*) FILTER (WHERE country NOT IN ('US', 'GB')) AS bad_values,
  count(*) FILTER (WHERE TRY_CAST(num_injured_total AS DOUBLE) < 0)
    + count(*) FILTER (WHERE TRY_CAST(num_killed AS DOUBLE) < 0)
    + count(*) FILTER (WHERE TRY_CAST(num_vehicles_involved AS DOUBLE) < 0)
    + count(*) FILTER (WHERE TRY_CAST(posted_speed_limit_mph AS DOUBLE) < 0 OR TRY_CAST(posted_speed_limit_mph AS DOUBLE) > 200)
    + count(*) FILTER (WHERE {_outside('latitude')}) + count(*) FILTER (WHERE {_outside('longitude')}) AS hard,
  count(*) FILTER (WHERE TRY_CAST(posted_speed_limit_mph AS DOUBLE) < 5 OR TRY_CAST(posted_speed_limit_mph AS DOUBLE) > 70) AS soft,
  max(inverted) AS inverted, max(both_dates) AS both_dates
FROM staged s JOIN
  (SELECT source_id, count(*) FILTER (WHERE police_notified_timestamp_utc < crash_timestamp_utc) AS inverted,
     count(*) FILTER (WHERE police_notified_timestamp_utc IS NOT NULL AND crash_timestamp_utc IS NOT NULL) AS both_dates
   FROM parsed GROUP BY ALL) USING (source_id)
GROUP BY ALL
"""

DQ = f"""
SELECT source_id, batch_id, 'schema_check' AS check_name, 'pass' AS status, n AS rows_checked,
  CAST(0 AS BIGINT) AS rows_failed, '25 of 25 columns there' AS details FROM counters
UNION ALL SELECT source_id, batch_id, 'nullability_check', CASE WHEN null_cells > 0 THEN 'fail' ELSE 'pass' END, n, null_cells,
  {_ENFORCED} || ' required columns are filled' FROM counters
UNION ALL SELECT source_id, batch_id, 'uniqueness_check', CASE WHEN dup_record + dup_crash > 0 THEN 'fail' ELSE 'pass' END,
  n, dup_record + dup_crash, CASE WHEN dup_record + dup_crash > 0
    THEN 'surplus copies by source_record_id=' || dup_record || ', by crash_id=' || dup_crash
    ELSE 'each key occurs once' END FROM counters
UNION ALL SELECT source_id, batch_id, 'accepted_values_check', CASE WHEN bad_values > 0 THEN 'fail' ELSE 'pass' END, n,
  bad_values, 'only listed values occur' FROM counters
UNION ALL SELECT source_id, batch_id, 'range_check', CASE WHEN hard > 0 THEN 'fail' WHEN soft > 0 THEN 'warn' ELSE 'pass' END,
  n, CASE WHEN hard > 0 THEN hard ELSE soft END, CASE WHEN soft > 0
    THEN 'unusual posted_speed_limit_mph=' || soft ELSE 'every number is within its limits' END FROM counters
UNION ALL SELECT source_id, batch_id, 'date_logic_check',
  CASE WHEN source_id <> 'chicago_us' THEN 'pass' WHEN inverted > 5 THEN 'fail' WHEN inverted > 0 THEN 'warn' ELSE 'pass' END,
  n, CASE WHEN source_id <> 'chicago_us' THEN 0 ELSE inverted END,
  CASE WHEN source_id <> 'chicago_us' THEN 'Skipped: this source has no police time (structural gap)'
    WHEN inverted > 0 THEN inverted || ' rows with the police time ahead of the crash, up to 5 allowed'
    ELSE 'times in order in ' || both_dates || ' rows that have both' END FROM counters
UNION ALL SELECT source_id, batch_id, 'referential_check', 'pass', n, 0,
  'source found in the dimension: ' || source_id FROM counters
UNION ALL SELECT source_id, batch_id, 'row_count_check', 'pass', n, 0,
  n || ' rows staged, ' || n || ' in the manifest' FROM counters
"""

FRESHNESS = """
SELECT source_id, source_id || '_b1' AS batch_id, 'source_freshness' AS check_name,
  CASE source_id WHEN 'nyc_us' THEN CASE WHEN lag > 180 THEN 'warn' ELSE 'pass' END
    WHEN 'chicago_us' THEN CASE WHEN age > 14 THEN 'warn' ELSE 'pass' END ELSE 'pass' END AS status,
  n AS rows_checked, CAST(0 AS BIGINT) AS rows_failed,
  CASE source_id WHEN 'nyc_us' THEN 'pulled ' || (latest - 90) || ' to ' || latest || ', last record of '
      || latest || ', ' || lag || ' days old' || CASE WHEN lag > 180 THEN ', over the limit of 180' ELSE '' END
    WHEN 'chicago_us' THEN 'UNCHANGED since batch chicago_us_b1: orders, first seen ' || age || ' days back'
      || CASE WHEN age > 14 THEN ', over the 14-day limit' ELSE '' END
    ELSE 'NEW content in lineitem, after batch none' END AS details
FROM (SELECT source_id, count(*) AS n, max(CAST(crash_timestamp_utc AS DATE)) AS latest,
        date_diff('day', max(CAST(crash_timestamp_utc AS DATE)), DATE '2026-01-05') AS lag,
        CAST(floor((epoch(TIMESTAMP '2026-01-05 07:00:00') - epoch(max(crash_timestamp_utc))) / 86400) AS INTEGER) AS age
      FROM parsed GROUP BY source_id)
"""

DQ_LOG = """
SELECT batch_id, source_id, check_name, status, rows_checked, rows_failed, details,
  TIMESTAMP '2026-01-05 07:00:00' AS run_timestamp FROM dq
UNION ALL
SELECT batch_id, source_id, check_name, status, rows_checked, rows_failed, details,
  TIMESTAMP '2026-01-12 07:00:00' AS run_timestamp FROM dq WHERE source_id <> 'nyc_us'
UNION ALL
SELECT batch_id, source_id, check_name, status, rows_checked, rows_failed, details,
  TIMESTAMP '2026-01-05 06:30:00' AS run_timestamp FROM freshness
"""

CTES = {
    "raw_a": RAW_A, "raw_b": RAW_B, "raw_c": RAW_C,
    "staged_a": STAGED_A, "staged_b": STAGED_B, "staged_c": STAGED_C,
    "staged": "SELECT * FROM staged_a UNION ALL SELECT * FROM staged_b UNION ALL SELECT * FROM staged_c",
    "parsed": PARSED, "timed": TIMED, "curated": CURATED, "localised": LOCALISED,
    "comparable": COMPARABLE, "frame_cities": FRAME_CITIES, "frames": FRAMES, "in_frames": IN_FRAMES,
    "city_facts": CITY_FACTS, "dim_source": DIM_SOURCE, "dim_date": DIM_DATE,
    "counters": COUNTERS, "dq": DQ, "freshness": FRESHNESS, "dq_log": DQ_LOG,
}


def _needed(sql: str, found: set[str]) -> set[str]:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            found.add(name)
            _needed(body, found)
    return found


def with_ctes(sql: str) -> str:
    """``sql`` preceded by the shared CTEs it refers to, in their order."""
    needed = _needed(sql, set())
    parts = [f"{name} AS ({body.strip()})" for name, body in CTES.items() if name in needed]
    if not parts:
        return sql.strip()
    sql = sql.strip()
    if own := re.match(r"(?i)(with(?: recursive)?)\b", sql):
        return f"{own[1]} " + ",\n".join(parts) + ",\n" + sql[own.end():].strip()
    return "WITH " + ",\n".join(parts) + "\n" + sql
