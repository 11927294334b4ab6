"""The quality report over the check log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if



def report_rows(log: DataFrame, since: Column) -> DataFrame:
    """Log rows since an instant: source (none last), batch, time, check."""
    return (log.where(F.col("run_timestamp") >= since)
            .orderBy(F.col("source_id").asc_nulls_last(), "batch_id", "run_timestamp", "check_name"))


def report_counts(log: DataFrame, since: Column) -> DataFrame:
    return log.where(F.col("run_timestamp") >= since).agg(
        F.count("*").alias("checks_run"), count_if(F.col("status") == "pass").alias("passed"),
        count_if(F.col("status") == "warn").alias("warned"),
        count_if(F.col("status") == "fail").alias("failed"),
        F.countDistinct("source_id").alias("sources"))


def shown(details: Column, width: int = 200) -> Column:
    """Details fit for a table cell: pipes escaped, one line, cut."""
    text = F.coalesce(details, F.lit(""))
    text = F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    return F.left(text, F.lit(width))


def report_cells(log: DataFrame, since: Column) -> DataFrame:
    """The report's table: source named, status in capitals, details shortened."""
    return report_rows(log, since).select(
        F.coalesce("source_id", F.lit("all sources")).alias("source"), "batch_id", "check_name",
        F.upper("status").alias("status"), "rows_checked", "rows_failed",
        shown(F.col("details")).alias("details"), "run_timestamp")


def write_markdown(log: DataFrame, since: Column, path: str) -> None:
    """The report as Markdown text. One run's log is a few dozen rows."""
    counts = report_counts(log, since).select(
        F.lit(0).alias("part"), F.concat(
            F.lit("# Data Quality Report\n\n**"), "passed", F.lit(" pass, "), "warned",
            F.lit(" warn, "), "failed", F.lit(" fail** across "), "sources",
            F.lit(" source(s).\n\n"), F.when(F.col("checks_run") == 0, "No checks were recorded.")
            .otherwise("| Source | Batch | Check | Status | Rows checked | Rows failed | Details |\n"
                       "|---|---|---|---|---:|---:|---|")).alias("value"))
    cells = report_cells(log, since)
    line = F.concat(F.lit("| "), F.concat_ws(
        " | ", "source", "batch_id", "check_name", "status", F.format_number("rows_checked", 0),
        F.format_number("rows_failed", 0), "details"), F.lit(" |"))
    body = cells.select(F.lit(1).alias("part"), line.alias("value"), "source", "batch_id",
                        "run_timestamp", "check_name")
    (counts.unionByName(body, allowMissingColumns=True)
     .orderBy("part", F.col("source") == "all sources", "source", "batch_id", "run_timestamp",
              "check_name")
     .select("value").coalesce(1).write.mode("overwrite").text(path))
