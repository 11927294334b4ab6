"""Check log and fact variants derived from the given tables, for the log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.functions.timeparse import by_source, parse_local
from wayfuse.operators.checks import append_log, run_checks
from wayfuse.operators.publish import dim_source
from wayfuse.plans.landing import once, staged_rows
from wayfuse.session import saved, scratch_path
from wayfuse.spec import ADAPTERS, TRAILING_WINDOW_DAYS
from wayfuse.streaming.incremental import freshness

FRESHNESS_AT = "2026-01-05 06:30:00"
FIRST_RUN = "2026-01-05 07:00:00"
SECOND_RUN = "2026-01-12 07:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp")


def raw_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_id", "batch_id").agg(F.count("*").alias("total_records_or_files"))


def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_rows(spark, sf_dir)
    return run_checks(rows, dim_source(spark), raw_totals(rows))


def extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract per source: unchanged export, pulled window, new annual files."""
    rows = staged_rows(spark, sf_dir).select("source_id", "crash_timestamp_utc")
    when = by_source(lambda a: parse_local(F.col("crash_timestamp_utc"), a.timestamp_layout),
                     ADAPTERS.values(), F.lit(None))
    last = (rows.withColumn("_t", when).groupBy("source_id")
            .agg(F.max("_t").alias("_last"), F.count("*").alias("row_count")))
    day = F.to_date("_last")
    src = F.col("source_id")
    return last.select(
        "source_id", F.concat("source_id", F.lit("_b1")).alias("batch_id"), "row_count",
        (src != "chicago_us").alias("content_changed"),
        F.when(src == "chicago_us", F.lit("chicago_us_b1")).alias("previous_batch_id"),
        F.col("_last").alias("first_ingested_at"), day.alias("latest_published_date"),
        F.date_sub(day, TRAILING_WINDOW_DAYS).alias("window_since"), day.alias("window_until"),
        F.when(src == "chicago_us", "orders").otherwise("lineitem").alias("source_files"))


def freshness_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(extracts(spark, sf_dir), at(FIRST_RUN))


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the checks, the second without the pulled source, and the freshness rows."""
    return spark.read.parquet(once(spark, sf_dir, "log", lambda: _write_log(spark, sf_dir)))


def _write_log(spark: SparkSession, sf_dir: str) -> str:
    root, results = scratch_path(spark, "dq_run_log"), saved(check_results(spark, sf_dir), "results")
    append_log(results, root, at(FIRST_RUN))
    append_log(results.where("source_id <> 'nyc_us'"), root, at(SECOND_RUN))
    append_log(freshness_results(spark, sf_dir), root, at(FRESHNESS_AT))
    return root
