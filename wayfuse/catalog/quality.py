"""Queries of the staged checks, the audit of a candidate and the table constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfuse.catalog.registry import query
from wayfuse.operators import audit as AU
from wayfuse.operators import checks as C
from wayfuse.operators.publish import dim_date_rows, dim_source
from wayfuse.plans.bindings import BATCHES
from wayfuse.plans.landing import candidate, fact, published, staged_rows
from wayfuse.plans.samples import at, check_log, check_results, freshness_results, raw_totals
from wayfuse.sources.datasets import data_files

SHOWN = ["source_id", "check_name", "status", "rows_checked", "rows_failed"]


def _check(spark, rows, name, totals=None, batches=None):
    return C.run_checks(rows, dim_source(spark), totals, batches, (name,)).select(*SHOWN)


@query("dq01_schema", """
SELECT source_id, 'schema_check' AS check_name, 'fail' AS status, count(*) AS rows_checked, count(*) AS rows_failed FROM staged GROUP BY source_id""")
def dq01(spark, sf):
    return _check(spark, staged_rows(spark, sf).drop("primary_cause"), "schema_check")


@query("dq02_nullability", """
SELECT source_id, 'nullability_check' AS check_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed
FROM (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE severity = 'unknown') AS bad FROM staged GROUP BY source_id)""")
def dq02(spark, sf):
    return _check(spark, staged_rows(spark, sf).withColumn("country", F.when(F.col("severity") != "unknown", F.col("country"))),
                  "nullability_check")


@query("dq03_uniqueness", """
SELECT source_id, 'uniqueness_check' AS check_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed
FROM (SELECT source_id, count(*) AS n, count(*) - count(DISTINCT regexp_replace(source_record_id, '-.*-', '-')) + count(*) - count(DISTINCT crash_id) AS bad
      FROM staged GROUP BY source_id)""")
def dq03(spark, sf):
    short = F.regexp_replace("source_record_id", "-.*-", "-")
    return _check(spark, staged_rows(spark, sf).withColumn("source_record_id", short), "uniqueness_check")


@query("dq04_accepted_values", """
SELECT source_id, 'accepted_values_check' AS check_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed
FROM (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE severity = 'fatal') + count(*) FILTER (WHERE country = 'GB' AND severity = 'serious') AS bad
      FROM staged GROUP BY source_id)""")
def dq04(spark, sf):
    rows = staged_rows(spark, sf)
    bad_country = F.when((F.col("country") == "GB") & (F.col("severity") == "serious"), "UK").otherwise(F.col("country"))
    bad_severity = F.when(F.col("severity") == "fatal", "FATAL").otherwise(F.col("severity"))
    return _check(spark, rows.withColumn("country", bad_country).withColumn("severity", bad_severity), "accepted_values_check")


@query("dq05_range", """
SELECT source_id, 'range_check' AS check_name, CASE WHEN hard > 0 THEN 'fail' WHEN soft > 0 THEN 'warn' ELSE 'pass' END AS status,
  n AS rows_checked, CASE WHEN hard > 0 THEN hard ELSE soft END AS rows_failed
FROM (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE severity = 'fatal' AND source_id = 'uk_stats19') AS hard,
  count(*) FILTER (WHERE TRY_CAST(posted_speed_limit_mph AS DOUBLE) NOT BETWEEN 5 AND 70) AS soft FROM staged GROUP BY source_id)""")
def dq05(spark, sf):
    moved = F.when((F.col("severity") == "fatal") & (F.col("source_id") == "uk_stats19"), "12.5").otherwise(F.col("latitude"))
    return _check(spark, staged_rows(spark, sf).withColumn("latitude", moved), "range_check")


@query("dq06_date_logic", "SELECT source_id, check_name, status, rows_checked, rows_failed FROM dq WHERE check_name = 'date_logic_check'")
def dq06(spark, sf):
    return _check(spark, staged_rows(spark, sf), "date_logic_check")


@query("dq07_referential", """
SELECT CASE source_id WHEN 'nyc_us' THEN 'paris_fr' ELSE source_id END AS source_id, 'referential_check' AS check_name,
  CASE source_id WHEN 'nyc_us' THEN 'fail' ELSE 'pass' END AS status, count(*) AS rows_checked,
  CASE source_id WHEN 'nyc_us' THEN count(*) ELSE 0 END AS rows_failed FROM staged GROUP BY source_id""")
def dq07(spark, sf):
    other = F.when(F.col("source_id") == "nyc_us", "paris_fr").otherwise(F.col("source_id"))
    return _check(spark, staged_rows(spark, sf).withColumn("source_id", other), "referential_check")


@query("dq08_row_count", """
SELECT source_id, 'row_count_check' AS check_name, CASE source_id WHEN 'nyc_us' THEN 'warn' ELSE 'pass' END AS status,
  count(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed FROM staged GROUP BY source_id
UNION ALL SELECT 'empty_source', 'row_count_check', 'fail', 0, 0""")
def dq08(spark, sf):
    rows = staged_rows(spark, sf)
    short = F.when(F.col("source_id") == "nyc_us", F.col("total_records_or_files") - 1).otherwise(F.col("total_records_or_files"))
    totals = raw_totals(rows).withColumn("total_records_or_files", short)
    announced = spark.createDataFrame([*BATCHES.items(), ("empty_source", "empty_b1")], "source_id string, batch_id string")
    return _check(spark, rows, "row_count_check", totals, announced)


@query("dq09_run_checks", "SELECT source_id, check_name, status, rows_checked, rows_failed, batch_id, details FROM dq")
def dq09(spark, sf):
    return check_results(spark, sf).select(*SHOWN, "batch_id", "details")


@query("dq09_absent_column", """
SELECT source_id, check_name,
  CASE check_name WHEN 'schema_check' THEN 'fail' WHEN 'range_check' THEN 'pass' ELSE status END AS status, rows_checked,
  CASE check_name WHEN 'schema_check' THEN rows_checked WHEN 'range_check' THEN 0 ELSE rows_failed END AS rows_failed FROM dq""")
def dq09b(spark, sf):
    """All eight checks report on rows without their speed limits."""
    rows = staged_rows(spark, sf)
    return C.run_checks(rows.drop("posted_speed_limit_mph"), dim_source(spark), raw_totals(rows)).select(*SHOWN)


@query("dq10_freshness", "SELECT source_id, batch_id, check_name, status, rows_checked, rows_failed, details FROM freshness")
def dq10(spark, sf):
    return freshness_results(spark, sf).select("source_id", "batch_id", "check_name", "status", "rows_checked", "rows_failed", "details")


_CONSTRAINTS = {
    **{f"not_null_{c}": f"count(*) FILTER (WHERE {c} IS NULL)" for c in (
        "crash_id", "source_id", "source_record_id", "crash_timestamp_utc", "crash_date_key", "country",
        "has_valid_coordinates", "severity", "hit_and_run", "batch_id")},
    "severity_values": "count(*) FILTER (WHERE severity NOT IN ('fatal', 'serious', 'minor', 'none', 'unknown'))",
    "country_length": "count(*) FILTER (WHERE length(country) <> 2)",
    **{f"non_negative_{c}": f"count(*) FILTER (WHERE {c} < 0)" for c in (
        "num_injured_total", "num_killed", "num_vehicles_involved")},
    "primary_key_crash_id": "count(*) - count(DISTINCT crash_id)",
    "unique_natural_key": "count(*) - count(DISTINCT source_id || '|' || source_record_id)",
    "foreign_key_dim_source": "count(*) FILTER (WHERE source_id NOT IN (SELECT source_id FROM dim_source))",
    "foreign_key_dim_date": "count(*) FILTER (WHERE year(crash_date_key) < 2019)",
}


@query("dq11_table_constraints", """
SELECT constraint_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed FROM (""" + " UNION ALL ".join(
    f"SELECT '{k}' AS constraint_name, count(*) AS n, {v} AS bad FROM curated" for k, v in _CONSTRAINTS.items())
    + """ UNION ALL SELECT 'log_status_values', (SELECT count(*) FROM curated), count(*) FILTER (WHERE status NOT IN ('pass', 'warn', 'fail')) FROM dq_log)""")
def dq11(spark, sf):
    rows = fact(spark, sf)
    calendar = dim_date_rows(rows).where("year >= 2019")  # an unfilled dimension
    return C.table_constraints(rows, dim_source(spark), calendar, check_log(spark, sf))


# -- audit -----------------------------------------------------------------------

_SCHEMA = "SELECT CAST(NULL AS VARCHAR) AS source_id, 'curated_schema_check' AS check_name, 'pass' AS status, count(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed FROM curated"
_UNIQUE = """SELECT CAST(NULL AS VARCHAR) AS source_id, 'curated_uniqueness_check' AS check_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed
FROM (SELECT count(*) AS n, count(*) - count(DISTINCT source_id || '|' || source_record_id) + count(*) - count(DISTINCT crash_id)
  + count(*) FILTER (WHERE crash_id <> source_id || ':' || source_record_id) AS bad FROM curated)"""
_RECONCILE = """SELECT source_id, 'curated_reconciliation_check' AS check_name, CASE WHEN s - c > greatest(s * 0.001, 25) THEN 'fail' ELSE 'pass' END AS status,
  s AS rows_checked, CASE WHEN s - c > greatest(s * 0.001, 25) THEN s - c ELSE 0 END AS rows_failed
FROM (SELECT source_id, count(*) AS s, count(crash_timestamp_utc) AS c FROM timed GROUP BY source_id)"""
_TIMES = """SELECT source_id, 'curated_timestamp_check' AS check_name, CASE WHEN bad > 0 THEN 'fail' ELSE 'pass' END AS status, n AS rows_checked, bad AS rows_failed
FROM (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE crash_timestamp_utc > TIMESTAMP '{run}' + INTERVAL 1 DAY) AS bad FROM curated GROUP BY source_id)"""
_PARTS = """SELECT source_id, 'curated_partition_check' AS check_name, 'pass' AS status, count(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed FROM curated GROUP BY source_id
UNION ALL SELECT NULL, 'curated_partition_check', 'pass', count(*), 0 FROM curated"""


def _expected(spark, sf):
    return staged_rows(spark, sf).groupBy("source_id", "batch_id").agg(F.count("*").alias("staged_rows"))


@query("cdq01_schema_types", _SCHEMA)
def cdq01(spark, sf):
    return AU.schema_check(fact(spark, sf)).select(*SHOWN)


@query("cdq02_uniqueness", _UNIQUE)
def cdq02(spark, sf):
    return AU.uniqueness_check(fact(spark, sf)).select(*SHOWN)


@query("cdq03_reconciliation", _RECONCILE)
def cdq03(spark, sf):
    return AU.reconciliation_check(fact(spark, sf), _expected(spark, sf)).select(*SHOWN)


@query("cdq04_timestamps", _TIMES.format(run="2024-01-15 00:00:00"))
def cdq04(spark, sf):
    return AU.timestamp_check(fact(spark, sf), at("2024-01-15 00:00:00")).select(*SHOWN)


@query("cdq05_partitions", _PARTS)
def cdq05(spark, sf):
    root = published(spark, sf)
    return AU.partition_check(spark.read.parquet(root), data_files(spark, root)).select(*SHOWN)


@query("cdq06_run_curated_checks", " UNION ALL ".join(
    [_SCHEMA, _UNIQUE, _RECONCILE, _TIMES.format(run="2026-01-05 07:00:00"), _PARTS]))
def cdq06(spark, sf):
    return AU.audit(spark, candidate(spark, sf), at("2026-01-05 07:00:00")).select(*SHOWN)
