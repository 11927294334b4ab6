"""Tables of the exploratory report, over curated rows and comparison frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, percent
from wayfuse.operators.frames import add_local_time, city_map, in_frames
from wayfuse.plans.analytics import coordinate_coverage, share_of
from wayfuse.spec import INJURY_SEVERITIES

DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def volume(curated: DataFrame, sources: list[str]) -> DataFrame:
    """Rows per local year and source, 0 where there are none."""
    return (add_local_time(curated).groupBy("local_year").pivot("source_id", sources)
            .agg(F.count(F.lit(1))).na.fill(0))


def funnel(curated: DataFrame) -> DataFrame:
    """Rows kept by each rule: all, in the city, injury crashes in the city."""
    in_city = F.coalesce(F.col("city") == city_map()[F.col("source_id")], F.lit(False))
    return curated.groupBy("source_id").agg(
        F.count("*").alias("all_rows"), count_if(in_city).alias("in_city_geography"),
        count_if(in_city & F.col("severity").isin(*INJURY_SEVERITIES)).alias("injury_crashes_in_city"))


def city_shares(spark: SparkSession, rows: DataFrame, frames: DataFrame, part: Column, name: str,
                digits: int) -> DataFrame:
    """Share of a city's rows in the frame by hour, weekday or other part."""
    counted = (in_frames(spark, rows, frames).groupBy("frame", "city_area", part.alias(name))
               .agg(F.count("*").alias("crashes")))
    return share_of(counted, ["frame", "city_area"], "crashes", "pct", digits)


def hour_shares(spark, rows, frames) -> DataFrame:
    return city_shares(spark, rows, frames, F.col("local_hour"), "local_hour", 4)


def weekday_shares(spark, rows, frames) -> DataFrame:
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return city_shares(spark, rows, frames, names[F.col("local_dow")], "weekday", 1)


def weekend_share(spark, rows, frames) -> DataFrame:
    counted = in_frames(spark, rows, frames).groupBy("frame", "city_area").agg(
        F.count("*").alias("_n"), count_if(F.col("is_weekend")).alias("_w"))
    return counted.select("frame", "city_area", percent(F.col("_w"), F.col("_n"), 1).alias("pct_weekend"))


def severity_shares(spark, rows, frames) -> DataFrame:
    """One row per frame and city with the three severities side by side, 0 when absent."""
    counted = (in_frames(spark, rows, frames).groupBy("frame", "city_area")
               .pivot("severity", INJURY_SEVERITIES).agg(F.count(F.lit(1))).na.fill(0))
    n = F.col("fatal") + F.col("serious") + F.col("minor")
    return counted.select("frame", "city_area",
                          *[percent(F.col(s), n, 2).alias(s) for s in INJURY_SEVERITIES])


def latest_log(log: DataFrame, n: int = 40) -> DataFrame:
    return (log.select("source_id", "check_name", "status", "rows_checked", "rows_failed", "run_timestamp")
            .orderBy(F.desc("run_timestamp"), F.col("source_id").asc_nulls_last(), "check_name").limit(n))


__all__ = ["coordinate_coverage", "volume", "funnel", "hour_shares", "weekday_shares",
           "weekend_share", "severity_shares", "latest_log"]
