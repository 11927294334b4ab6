"""Like-for-like comparison frames: same kind of place, event and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.functions.scalars import count_if, round_half_up
from wayfuse.functions.timeparse import add_local_time
from wayfuse.spec import (AREA_KM2, CITY_OF_SOURCE, FRAMES, INJURY_SEVERITIES, RESIDENTS)


def city_map():
    pairs = [F.lit(x) for kv in CITY_OF_SOURCE.items() for x in kv]
    return F.create_map(*pairs)


def comparable_rows(df: DataFrame) -> DataFrame:
    """Injury crashes in the source's own city, with ``city_area``."""
    area = city_map()[F.col("source_id")]
    return (df.where((F.col("city") == area) & F.col("severity").isin(*INJURY_SEVERITIES))
            .withColumn("city_area", area))


def comparable(curated: DataFrame) -> DataFrame:
    return comparable_rows(add_local_time(curated))


def coverage(rows: DataFrame) -> DataFrame:
    """First and last local date and number of rows per city."""
    return rows.groupBy("city_area").agg(F.min("local_date").alias("first"),
                                         F.max("local_date").alias("last"),
                                         F.count("*").alias("injury_crashes"))


def city_facts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(c, RESIDENTS[c], AREA_KM2[c]) for c in RESIDENTS],
        "city_area string, residents long, area_km2 double")


def frame_cities(spark: SparkSession) -> DataFrame:
    """(frame, frame_no, city_area) of the candidate frames."""
    rows = [(name, i, city) for i, (name, cities) in enumerate(FRAMES, 1) for city in cities]
    return spark.createDataFrame(rows, "frame string, frame_no int, city_area string")


def build_frames(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Candidate frames with the window all their cities cover; 0 days when there is none."""
    covered = frame_cities(spark).join(F.broadcast(coverage(rows)), "city_area", "left")
    window = covered.groupBy("frame", "frame_no").agg(
        F.array_join(F.array_sort(F.collect_list("city_area")), ", ").alias("cities"),
        F.max("first").alias("_start"), F.min("last").alias("_end"),
        F.count("*").alias("_wanted"), F.count("first").alias("_have"))
    ok = (F.col("_wanted") == F.col("_have")) & (F.col("_start") <= F.col("_end"))
    return window.select(
        "frame", "frame_no", "cities", F.when(ok, F.col("_start")).alias("start"),
        F.when(ok, F.col("_end")).alias("end"),
        F.when(ok, F.datediff("_end", "_start") + 1).otherwise(0).alias("days"))


def cluster_frames(frames: DataFrame) -> DataFrame:
    """Frames for hotspots: the latest full calendar year of the long frame, the short as it is."""
    long_one, short_one = FRAMES[0][0], FRAMES[1][0]
    whole = F.date_format("end", "MM-dd") == "12-31"
    year = F.when(whole, F.year("end")).otherwise(F.year("end") - 1)
    by_year = (frames.where((F.col("frame") == long_one) & (F.col("days") > 0))
               .withColumn("_year", year).where(F.col("_year") >= F.year("start"))
               .select(F.concat("frame", F.lit(", "), "_year").alias("frame"), "frame_no", "cities",
                       F.greatest("start", F.make_date("_year", F.lit(1), F.lit(1))).alias("start"),
                       F.least("end", F.make_date("_year", F.lit(12), F.lit(31))).alias("end")))
    as_is = (frames.where((F.col("frame") == short_one) & (F.col("days") > 0))
             .select(F.concat("frame", F.lit(", NYC window")).alias("frame"), "frame_no", "cities",
                     "start", "end"))
    return by_year.unionByName(as_is).withColumn("days", F.datediff("end", "start") + 1)


def frame_windows(spark: SparkSession, frames: DataFrame) -> DataFrame:
    """One row per frame with a window and city; a handful of rows."""
    return (frames.where("days > 0").join(frame_cities(spark).select("frame_no", "city_area"),
                                          "frame_no"))


def in_frames(spark: SparkSession, rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows of each frame's cities inside its window, edges included.

    An equi-join on the city against at most a few rows per city; the window is
    a residual condition, so no range join is planned.
    """
    windows = frame_windows(spark, frames).select("frame", "city_area", "start", "end", "days")
    return (rows.join(F.broadcast(windows), "city_area")
            .where(F.col("local_date").between(F.col("start"), F.col("end"))))


def rates(spark: SparkSession, rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Injury and fatal crashes per 100,000 residents and year; a city without rows shows 0."""
    counted = (in_frames(spark, rows, frames).groupBy("frame", "city_area")
               .agg(F.count("*").alias("injury_crashes"),
                    count_if(F.col("severity") == "fatal").alias("fatal_crashes")))
    wanted = (frame_windows(spark, frames).join(F.broadcast(city_facts(spark)), "city_area"))
    d = (wanted.join(F.broadcast(counted), ["frame", "city_area"], "left")
         .na.fill(0, ["injury_crashes", "fatal_crashes"]))

    def rate(n):
        return round_half_up(F.col(n) / (F.col("days") / F.lit(365.25)) / F.col("residents") * 1e5, 3)

    share = F.when(F.col("injury_crashes") > 0,
                   round_half_up(F.col("fatal_crashes") / F.col("injury_crashes") * 100, 3))
    return d.select(
        "frame", "city_area",
        F.concat("start", F.lit(" to "), "end", F.lit(" ("), "days", F.lit(" days)")).alias("window"),
        "injury_crashes", "fatal_crashes", "residents",
        rate("injury_crashes").alias("injury_per_100k_per_year"),
        rate("fatal_crashes").alias("fatal_per_100k_per_year"),
        share.alias("fatal_share_of_injury_pct"))
