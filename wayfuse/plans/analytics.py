"""The analytical query set over the fact, its dimensions and the check log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, percent, round_half_up
from wayfuse.sources.text import latest_per_key
from wayfuse.spec import INJURY_SEVERITIES, RESIDENTS, SEVERITY_ORDER

# Window of the like-for-like queries and the downtown box: fixed values.
WINDOW = ("2021-01-01", "2025-12-31")
DOWNTOWN = {"latitude": (41.870, 41.890), "longitude": (-87.640, -87.620)}


def _local(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    zones = dim_source.select("source_id", F.col("source_local_timezone").alias("_zone"))
    return fact.join(F.broadcast(zones), "source_id").withColumn(
        "_local", F.from_utc_timestamp("crash_timestamp_utc", F.col("_zone")))


def share_of(df: DataFrame, part: list[str], count: str, name: str, digits: int = 2) -> DataFrame:
    """Share of each row's count in its group; the window runs on aggregated rows."""
    total = F.sum(count).over(W.partitionBy(*part))
    return df.withColumn("_total", total).withColumn(
        name, percent(F.col(count), F.col("_total"), digits)).drop("_total")


def share_of_all(df: DataFrame, count: str, name: str, digits: int = 2) -> DataFrame:
    """Share in the grand total, from a one-row total instead of a single-task window."""
    total = df.agg(F.sum(count).alias("_total"))
    return (df.join(F.broadcast(total))
            .withColumn(name, percent(F.col(count), F.col("_total"), digits)).drop("_total"))


def load_verification(fact: DataFrame) -> DataFrame:
    """Rows, batches and time range per source. Batches are few: counted in two steps."""
    by_batch = fact.groupBy("source_id", "batch_id").agg(
        F.count("*").alias("n"), F.min("crash_timestamp_utc").alias("first"),
        F.max("crash_timestamp_utc").alias("last"))
    return by_batch.groupBy("source_id").agg(
        F.sum("n").alias("crashes"), F.count("batch_id").alias("batches_loaded"),
        F.min("first").alias("earliest_crash_utc"), F.max("last").alias("latest_crash_utc"))


def duplicate_keys(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def per_year_by_source(fact: DataFrame, dim_date: DataFrame, sources: list[str]) -> DataFrame:
    """One row per UTC year, one column per source.

    Counted per date first, so the join with the calendar handles dates, not crashes.
    """
    by_day = fact.groupBy(F.col("crash_date_key").alias("date_key")).agg(
        *[count_if(F.col("source_id") == s).alias(s) for s in sources])
    return (by_day.join(dim_date.select("date_key", "year"), "date_key").groupBy("year")
            .agg(*[F.sum(s).alias(s) for s in sources]))


def local_profile(fact: DataFrame, dim_source: DataFrame, part: Column, name: str) -> DataFrame:
    counted = (_local(fact, dim_source).groupBy("source_id", part.alias(name))
               .agg(F.count("*").alias("crashes")))
    return share_of(counted, ["source_id"], "crashes", "pct_of_source")


def local_hours(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    return local_profile(fact, dim_source, F.hour("_local"), "local_hour")


def local_weekdays(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    """ISO weekday, 1 is Monday."""
    return local_profile(fact, dim_source, F.weekday("_local") + 1, "local_isodow").drop("crashes")


def severity_rank() -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITY_ORDER]), F.col("severity"))


def severity_mix(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("source_id", "severity").agg(F.count("*").alias("crashes"))
    return (share_of(counted, ["source_id"], "crashes", "pct_of_source")
            .orderBy("source_id", severity_rank()))


def _comparable(fact: DataFrame, dim_source: DataFrame, cities: list[str]) -> DataFrame:
    return (_local(fact.where(F.col("severity").isin(*INJURY_SEVERITIES) & F.col("city").isin(*cities)),
                   dim_source)
            .where(F.to_date("_local").between(F.lit(WINDOW[0]).cast("date"),
                                               F.lit(WINDOW[1]).cast("date"))))


def fatal_share(fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    counted = _comparable(fact, dim_source, ["Chicago", "London"]).groupBy("city").agg(
        F.count("*").alias("injury_crashes"),
        count_if(F.col("severity") == "fatal").alias("fatal_crashes"))
    return (counted.withColumn("pct_fatal", percent(F.col("fatal_crashes"), F.col("injury_crashes"), 3))
            .orderBy(F.desc("pct_fatal")))


def top_causes(fact: DataFrame, n: int = 10) -> DataFrame:
    counted = (fact.where((F.col("source_id") == "chicago_us")
                          & F.col("severity").isin("fatal", "serious"))
               .groupBy("primary_cause").agg(F.count("*").alias("fatal_or_serious_crashes")))
    return (share_of_all(counted, "fatal_or_serious_crashes", "pct")
            .orderBy(F.desc("fatal_or_serious_crashes"), F.col("primary_cause").asc_nulls_last())
            .limit(n))


def monthly_trend(fact: DataFrame, source_id: str = "chicago_us", since: str = "2018-01-01") -> DataFrame:
    """Crashes per month and the mean of up to three months.

    The window has no key but runs on one row per month, a few hundred at most.
    """
    monthly = (fact.where((F.col("source_id") == source_id)
                          & (F.col("crash_date_key") >= F.lit(since).cast("date")))
               .groupBy(F.trunc("crash_date_key", "month").alias("month"))
               .agg(F.count("*").alias("crashes")))
    w = W.orderBy("month").rowsBetween(-2, 0)
    return monthly.select("month", "crashes", F.round(
        F.sum("crashes").over(w).cast("decimal(18,0)") / F.count("*").over(w).cast("decimal(18,0)"), 0)
        .cast("double").alias("rolling_3_month_avg"))


def coordinate_coverage(fact: DataFrame) -> DataFrame:
    counted = fact.groupBy("source_id").agg(F.count("*").alias("_n"),
                                            count_if(F.col("has_valid_coordinates")).alias("_ok"))
    return counted.select("source_id", percent(F.col("_ok"), F.col("_n"), 2).alias("pct_valid_coordinates"))


def in_box(box: dict) -> Column:
    return (F.col("has_valid_coordinates") & F.col("latitude").between(*box["latitude"])
            & F.col("longitude").between(*box["longitude"]))


def downtown_severity(fact: DataFrame) -> DataFrame:
    return (fact.where((F.col("source_id") == "chicago_us") & in_box(DOWNTOWN))
            .groupBy("severity").agg(F.count("*").alias("crashes")).orderBy(F.desc("crashes")))


def month_slice(curated: DataFrame, source_id: str, first: str, after: str) -> DataFrame:
    """Rows of one source in a half-open date range.

    Year and month bounds are stated as well, because the folders are named by
    them: the scan then opens only the folders of the range.
    """
    y0, m0 = int(first[:4]), int(first[5:7])
    y1, m1 = int(after[:4]), int(after[5:7])
    month_no = F.col("year") * 12 + F.col("month")
    return curated.where(
        (F.col("source_id") == source_id) & F.col("year").between(y0, y1)
        & month_no.between(y0 * 12 + m0, y1 * 12 + m1)
        & (F.col("crash_date_key") >= F.lit(first).cast("date"))
        & (F.col("crash_date_key") < F.lit(after).cast("date")))


def trace_record(fact: DataFrame, log: DataFrame, source_id: str = "chicago_us",
                 crash_id: str | None = None) -> DataFrame:
    """One record with its batch, its raw manifest and the checks of that batch."""
    rows = fact.where(F.col("source_id") == source_id)
    one = (rows.orderBy("crash_id").limit(1) if crash_id is None
           else rows.where(F.col("crash_id") == crash_id))
    checks = log.select("batch_id", "check_name", "status", "rows_failed")
    return checks.join(F.broadcast(one), "batch_id", "right").select(
        "crash_id", "source_record_id", "crash_timestamp_utc", "severity", "batch_id",
        F.concat(F.lit("data/raw/"), "source_id", F.lit("/"), "batch_id",
                 F.lit("/manifest.json")).alias("raw_manifest_path"),
        "check_name", "status", "rows_failed").orderBy("check_name")


def latest_check_results(log: DataFrame) -> DataFrame:
    latest = latest_per_key(log, ["source_id", "check_name"], [F.desc("run_timestamp")])
    told = F.when(F.col("status") != "pass", F.left("details", F.lit(120)))
    return latest.select("source_id", "check_name", "status", "rows_checked", "rows_failed",
                         told.alias("details"), "run_timestamp")


def injury_rates(spark: SparkSession, fact: DataFrame, dim_source: DataFrame) -> DataFrame:
    population = spark.createDataFrame([(c, RESIDENTS[c]) for c in ("Chicago", "London")],
                                       "city string, residents long")
    years = F.datediff(F.lit(WINDOW[1]).cast("date"), F.lit(WINDOW[0]).cast("date")) + 1
    counted = _comparable(fact, dim_source, ["Chicago", "London"]).groupBy("city").agg(
        F.count("*").alias("injury_crashes"), count_if(F.col("severity") == "fatal").alias("_fatal"))

    def rate(n, digits):
        return round_half_up(F.col(n) / (years / F.lit(365.25)) / F.col("residents") * 100000, digits)

    return (counted.join(F.broadcast(population), "city")
            .select("city", "injury_crashes", rate("injury_crashes", 1).alias("injury_per_100k_per_year"),
                    rate("_fatal", 2).alias("fatal_per_100k_per_year")).orderBy("city"))


def latest_freshness(log: DataFrame) -> DataFrame:
    latest = latest_per_key(log.where("check_name = 'source_freshness'"), ["source_id"],
                            [F.desc("run_timestamp")])
    return latest.select("source_id", "status", "run_timestamp",
                         F.left("details", F.lit(160)).alias("details"))


def per_source_year(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("source_id", F.year("crash_date_key").alias("year"))
            .agg(F.count("*").alias("crashes")))


def fatal_rate_mappable(fact: DataFrame) -> DataFrame:
    counted = fact.where("has_valid_coordinates").groupBy("source_id").agg(
        count_if(F.col("severity") == "fatal").alias("fatal_count"), F.count("*").alias("total_count"))
    return counted.withColumn("fatal_pct", percent(F.col("fatal_count"), F.col("total_count"), 3))


def recent_failures(log: DataFrame, n: int = 50) -> DataFrame:
    return (log.where("status = 'fail'")
            .select("batch_id", "source_id", "check_name", "rows_failed", "run_timestamp")
            .orderBy(F.desc("run_timestamp"), "source_id", "check_name").limit(n))


def clusterable(fact: DataFrame, source_id: str, year: int) -> DataFrame:
    return fact.where((F.col("source_id") == source_id) & F.col("has_valid_coordinates")
                      & F.col("crash_date_key").between(F.lit(f"{year}-01-01").cast("date"),
                                                        F.lit(f"{year}-12-31").cast("date"))) \
        .select("crash_id", "latitude", "longitude", "severity")
