"""Queries of the mapping primitives, derivations, time rules and typing."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfuse.catalog import sql_base as S
from wayfuse.catalog.registry import query
from wayfuse.functions import timeparse as T
from wayfuse.functions.derivations import REGISTRY, combine_date_time, count_filled, sum_components
from wayfuse.functions.scalars import to_bool, to_double, to_int
from wayfuse.operators.curate import exclusion_counts, with_keys
from wayfuse.operators.mapping import expression_column, field_column, is_zero_point
from wayfuse.plans.bindings import curated, raw, raw_events, raw_lineitem, raw_orders, staged
from wayfuse.spec import ADAPTERS, CHICAGO, NYC, UK


def _fields(spark, sf, source_id, key, *names):
    rows = raw(spark, sf, source_id)
    adapter = ADAPTERS[source_id]
    return rows.select(key, *[field_column(n, adapter.fields[n], adapter, set(rows.columns)).alias(n)
                              for n in names])


@query("map01_literal", """
SELECT collision_id, 'New York City' AS city, 'US' AS country, CAST(NULL AS VARCHAR) AS crash_type,
  'false' AS hit_and_run FROM raw_b""")
def map01(spark, sf):
    return _fields(spark, sf, "nyc_us", "collision_id", "city", "country", "crash_type", "hit_and_run")


@query("map02_from", """
SELECT CRASH_RECORD_ID AS source_record_id, CRASH_DATE AS crash_timestamp_utc, INJURIES_TOTAL AS num_injured_total,
  FIRST_CRASH_TYPE AS crash_type FROM raw_a""")
def map02(spark, sf):
    return _fields(spark, sf, "chicago_us", F.col("CRASH_RECORD_ID").alias("_k"), "source_record_id",
                   "crash_timestamp_utc", "num_injured_total", "crash_type").drop("_k")


@query("map03_null_sentinel", """
SELECT collision_index, nullif(speed_limit, '-1') AS posted_speed_limit_mph,
  nullif(weather_conditions, '-1') AS weather_condition, nullif(light_conditions, '-1') AS lighting_condition FROM raw_c""")
def map03(spark, sf):
    return _fields(spark, sf, "uk_stats19", "collision_index", "posted_speed_limit_mph",
                   "weather_condition", "lighting_condition")


@query("map04_value_map", f"""
SELECT CRASH_RECORD_ID AS id, {S.CHICAGO_SEVERITY} AS severity,
  CASE WHEN HIT_AND_RUN_I = 'Y' THEN 'true' ELSE 'false' END AS hit_and_run FROM raw_a
UNION ALL SELECT collision_index, {S.UK_SEVERITY}, 'false' FROM raw_c""")
def map04(spark, sf):
    a = _fields(spark, sf, "chicago_us", F.col("CRASH_RECORD_ID").alias("id"), "severity", "hit_and_run")
    c = _fields(spark, sf, "uk_stats19", F.col("collision_index").alias("id"), "severity", "hit_and_run")
    return a.unionByName(c)


@query("map05_derive_fn", f"""
SELECT 'uk_stats19:' || collision_index AS crash_id, date || ' ' || time AS crash_timestamp_utc,
  {S.UK_CITY} AS city, {S.UK_VALID} AS has_valid_coordinates FROM raw_c""")
def map05(spark, sf):
    return _fields(spark, sf, "uk_stats19", F.lit(1).alias("_k"), "crash_id", "crash_timestamp_utc", "city",
                   "has_valid_coordinates").drop("_k")


@query("map06_derive_expression", """
SELECT CRASH_RECORD_ID, coalesce(TRY_CAST(LATITUDE AS DOUBLE) BETWEEN 41.60 AND 42.05, false) AS latitude_inside,
  CASE WHEN trim(CRASH_DATE) <> '' AND trim(POSTED_SPEED_LIMIT) <> '' THEN CRASH_DATE || ' ' || POSTED_SPEED_LIMIT END AS combined
FROM raw_a""")
def map06(spark, sf):
    return raw_orders(spark, sf).select(
        "CRASH_RECORD_ID",
        expression_column("between(LATITUDE, bounding_box.latitude)", CHICAGO).alias("latitude_inside"),
        expression_column("combine_date_and_time(CRASH_DATE, POSTED_SPEED_LIMIT)", CHICAGO).alias("combined"))


@query("map07_canonical_project", "SELECT * FROM staged")
def map07(spark, sf):
    return staged(spark, sf)


@query("map08_zero_coord_null", """
SELECT source_id, count(*) AS n_rows, count(*) FILTER (WHERE zero) AS zero_points,
  count(*) FILTER (WHERE latitude IS NULL) AS without_latitude
FROM (SELECT s.source_id, s.latitude, coalesce(r.lat = '0' AND r.lon = '0', false) AS zero
      FROM staged s JOIN (SELECT 'chicago_us' AS source_id, CRASH_RECORD_ID AS source_record_id, LATITUDE AS lat, LONGITUDE AS lon FROM raw_a
             UNION ALL SELECT 'nyc_us', collision_id, latitude, longitude FROM raw_b) r USING (source_id, source_record_id))
GROUP BY source_id""")
def map08(spark, sf):
    a = raw_orders(spark, sf).select(F.lit("chicago_us").alias("source_id"),
                                     F.col("LATITUDE").alias("lat"), F.col("LONGITUDE").alias("lon"))
    b = raw_events(spark, sf).select(F.lit("nyc_us").alias("source_id"),
                                     F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    zero = is_zero_point(F.col("lat"), F.col("lon"))
    return a.unionByName(b).groupBy("source_id").agg(
        F.count("*").alias("n_rows"), F.count(F.when(zero, 1)).alias("zero_points"),
        F.count(F.when(zero | F.col("lat").isNull(), 1)).alias("without_latitude"))


@query("drv01_crash_id", """
SELECT 'chicago_us:' || CRASH_RECORD_ID AS crash_id FROM raw_a UNION ALL SELECT 'nyc_us:' || collision_id FROM raw_b
UNION ALL SELECT 'uk_stats19:' || collision_index FROM raw_c""")
def drv01(spark, sf):
    return (raw_orders(spark, sf).select(REGISTRY["chicago_crash_id"](CHICAGO).alias("crash_id"))
            .union(raw_events(spark, sf).select(REGISTRY["nyc_crash_id"](NYC)))
            .union(raw_lineitem(spark, sf).select(REGISTRY["uk_crash_id"](UK))))


@query("drv02_combine_date_time", """
SELECT collision_id AS id, crash_date || ' ' || crash_time AS combined,
  CASE WHEN trim(vehicle_type_code2) <> '' THEN crash_date || ' ' || vehicle_type_code2 END AS with_blank FROM raw_b
UNION ALL SELECT collision_index, date || ' ' || time, date || ' ' || time FROM raw_c""")
def drv02(spark, sf):
    b = raw_events(spark, sf).select(
        F.col("collision_id").alias("id"), REGISTRY["nyc_crash_timestamp"](NYC).alias("combined"),
        combine_date_time(F.col("crash_date"), F.col("vehicle_type_code2")).alias("with_blank"))
    t = REGISTRY["uk_crash_timestamp"](UK)
    return b.union(raw_lineitem(spark, sf).select("collision_index", t, t))


@query("drv03_has_valid_coordinates", f"""
SELECT CRASH_RECORD_ID AS id, {S.CHICAGO_VALID} = 'true' AS valid FROM raw_a
UNION ALL SELECT collision_id, {S.NYC_VALID} = 'true' FROM raw_b
UNION ALL SELECT collision_index, {S.UK_VALID} = 'true' FROM raw_c""")
def drv03(spark, sf):
    def of(rows, key, name, adapter):
        return rows.select(F.col(key).alias("id"), REGISTRY[name](adapter).alias("valid"))
    return (of(raw_orders(spark, sf), "CRASH_RECORD_ID", "chicago_has_valid_coordinates", CHICAGO)
            .union(of(raw_events(spark, sf), "collision_id", "nyc_has_valid_coordinates", NYC))
            .union(of(raw_lineitem(spark, sf), "collision_index", "uk_has_valid_coordinates", UK)))


@query("drv04_greater_london", f"SELECT collision_index, police_force, {S.UK_CITY} AS city FROM raw_c")
def drv04(spark, sf):
    return raw_lineitem(spark, sf).select("collision_index", "police_force", REGISTRY["uk_city"](UK).alias("city"))


@query("drv05_sum_components", f"SELECT collision_id, CAST({S.NYC_KILLED} AS INTEGER) AS num_killed FROM raw_b")
def drv05(spark, sf):
    return raw_events(spark, sf).select("collision_id", sum_components(
        ["number_of_pedestrians_killed", "number_of_cyclist_killed", "number_of_motorist_killed"]).alias("num_killed"))


@query("drv06_count_non_missing", f"SELECT collision_id, CAST({S.NYC_VEHICLES} AS INTEGER) AS num_vehicles FROM raw_b")
def drv06(spark, sf):
    return raw_events(spark, sf).select("collision_id", count_filled(
        ["vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3", "vehicle_type_code_4",
         "vehicle_type_code_5"]).alias("num_vehicles"))


@query("drv07_severity_from_counts", f"SELECT collision_id, {S.NYC_SEVERITY} AS severity FROM raw_b")
def drv07(spark, sf):
    return raw_events(spark, sf).select("collision_id", REGISTRY["nyc_severity"](NYC).alias("severity"))


@query("drv08_audit_string", f"SELECT collision_id, {S.NYC_AUDIT} AS source_severity_raw FROM raw_b")
def drv08(spark, sf):
    return raw_events(spark, sf).select(
        "collision_id", REGISTRY["nyc_source_severity_raw"](NYC).alias("source_severity_raw"))


@query("drv09_safe_casts", """
SELECT CRASH_RECORD_ID AS id, TRY_CAST(LATITUDE AS DOUBLE) AS as_double, CAST(trunc(TRY_CAST(LATITUDE AS DOUBLE)) AS INTEGER) AS as_int,
  CAST(NULL AS DOUBLE) AS from_word FROM raw_a
UNION ALL SELECT collision_id, TRY_CAST(number_of_persons_injured AS DOUBLE), TRY_CAST(number_of_persons_injured AS INTEGER),
  NULL FROM raw_b""")
def drv09(spark, sf):
    def of(rows, key, number, word):
        return rows.select(F.col(key).alias("id"), to_double(F.col(number)).alias("as_double"),
                           to_int(F.col(number)).alias("as_int"), to_double(F.col(word)).alias("from_word"))
    return of(raw_orders(spark, sf), "CRASH_RECORD_ID", "LATITUDE", "FIRST_CRASH_TYPE").union(
        of(raw_events(spark, sf), "collision_id", "number_of_persons_injured", "vehicle_type_code1"))


@query("tim01_local_to_utc", """
SELECT source_id, source_record_id, crash_timestamp_utc, police_notified_timestamp_utc FROM timed""")
def tim01(spark, sf):
    rows = staged(spark, sf).select("source_id", "source_record_id", "crash_timestamp_utc",
                                    "police_notified_timestamp_utc")
    return T.with_utc(rows, ["crash_timestamp_utc", "police_notified_timestamp_utc"], ADAPTERS.values())


@query("tim02_exclude_no_utc", """
SELECT source_id, count(*) AS staged_rows, count(crash_timestamp_utc) AS curated_rows,
  count(*) - count(crash_timestamp_utc) AS excluded_rows FROM timed GROUP BY source_id""")
def tim02(spark, sf):
    return exclusion_counts(staged(spark, sf))


@query("tim03_date_key", "SELECT crash_id, crash_timestamp_utc, crash_date_key FROM curated")
def tim03(spark, sf):
    return curated(spark, sf).select("crash_id", "crash_timestamp_utc", "crash_date_key")


@query("tim04_partition_cols", "SELECT crash_id, source_id, year, month FROM curated")
def tim04(spark, sf):
    return with_keys(curated(spark, sf)).select("crash_id", "source_id", "year", "month")


@query("tim05_local_calendar", """
SELECT crash_id, local_date, local_hour, local_dow, local_year, is_weekend FROM localised""")
def tim05(spark, sf):
    return T.add_local_time(curated(spark, sf)).select(
        "crash_id", "local_date", "local_hour", "local_dow", "local_year", "is_weekend")


@query("typ01_canonical_cast", """
SELECT crash_id, latitude, longitude, has_valid_coordinates, num_injured_total, num_killed, num_vehicles_involved,
  posted_speed_limit_mph, hit_and_run, ingested_at_utc, source_row_raw_ref FROM curated""")
def typ01(spark, sf):
    return curated(spark, sf).select(
        "crash_id", "latitude", "longitude", "has_valid_coordinates", "num_injured_total", "num_killed",
        "num_vehicles_involved", "posted_speed_limit_mph", "hit_and_run", "ingested_at_utc", "source_row_raw_ref")


@query("typ02_to_bool", """
SELECT CRASH_RECORD_ID, CASE WHEN HIT_AND_RUN_I = 'Y' THEN true END AS hit_and_run,
  CASE INJURIES_TOTAL WHEN '1' THEN true WHEN '0' THEN false END AS injured FROM raw_a""")
def typ02(spark, sf):
    return raw_orders(spark, sf).select("CRASH_RECORD_ID", to_bool(F.col("HIT_AND_RUN_I")).alias("hit_and_run"),
                                        to_bool(F.col("INJURIES_TOTAL")).alias("injured"))


@query("typ03_mixed_date_parse", f"""
SELECT CRASH_RECORD_ID, CASE WHEN CAST(CRASH_RECORD_ID AS BIGINT) % 2 = 0 THEN t ELSE date_trunc('minute', t) END AS parsed,
  CAST(NULL AS TIMESTAMP) AS unparsed FROM (SELECT *, strptime(CRASH_DATE, '{S.US_LAYOUT}') AS t FROM raw_a)""")
def typ03(spark, sf):
    rows = raw_orders(spark, sf)
    t = F.try_to_timestamp("CRASH_DATE", F.lit("MM/dd/yyyy hh:mm:ss a"))
    day_clock = F.date_format(t, "MM/dd/yyyy HH:mm")
    mixed = F.when(F.col("CRASH_RECORD_ID").cast("long") % 2 == 0, F.col("CRASH_DATE")).otherwise(day_clock)
    return rows.select("CRASH_RECORD_ID", T.parse_mixed(mixed).alias("parsed"),
                       T.parse_mixed(F.col("MOST_SEVERE_INJURY")).alias("unparsed"))
