import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from wayfuse.catalog import ORACLES, QUERIES
from wayfuse.operators import frames as FR
from wayfuse.operators import hotspots as H
from wayfuse.operators import profile as P
from wayfuse.plans import analytics as A
from wayfuse.plans.landing import fact, published

SMALL = "/root/testdata/sf0.001"
have_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def comparable(spark, spans):
    rows = [(city, dt.date.fromisoformat(d), "minor") for city, days in spans.items() for d in days]
    return spark.createDataFrame(rows, "city_area string, local_date date, severity string")


def test_frames_overlap(spark):
    rows = comparable(spark, {"Chicago": ["2018-01-01", "2024-06-30"], "London": ["2020-03-01", "2023-12-31"],
                              "New York City": ["2024-05-01", "2024-07-30"]})
    got = {r.frame: (str(r.start), str(r.end), r.days) for r in FR.build_frames(spark, rows).collect()}
    assert got["Chicago vs London"] == ("2020-03-01", "2023-12-31", 1401)
    assert got["Chicago vs New York City"] == ("2024-05-01", "2024-06-30", 61)
    assert got["All three cities"] == ("None", "None", 0)
    c = {r.frame: (str(r.start), str(r.end), r.days) for r in FR.cluster_frames(FR.build_frames(spark, rows)).collect()}
    assert c == {"Chicago vs London, 2023": ("2023-01-01", "2023-12-31", 365),
                 "Chicago vs New York City, NYC window": ("2024-05-01", "2024-06-30", 61)}


def test_missing_city_gives_no_window(spark):
    rows = comparable(spark, {"Chicago": ["2018-01-01", "2024-06-30"]})
    frames = FR.build_frames(spark, rows)
    assert {r.days for r in frames.collect()} == {0}
    assert FR.in_frames(spark, rows, frames).count() == 0 and FR.cluster_frames(frames).count() == 0


def test_last_full_year_before_a_short_end(spark):
    rows = comparable(spark, {"Chicago": ["2018-01-01", "2023-12-30"], "London": ["2018-01-01", "2023-12-30"]})
    assert FR.cluster_frames(FR.build_frames(spark, rows)).first().frame == "Chicago vs London, 2022"


def test_rates_show_zero(spark):
    rows = comparable(spark, {"Chicago": ["2020-01-01", "2020-12-31"], "London": ["2019-01-01", "2021-12-31"]})
    got = {r.city_area: r for r in FR.rates(spark, rows, FR.build_frames(spark, rows)).collect()}
    assert got["Chicago"].injury_crashes == 2 and got["London"].injury_crashes == 0
    assert got["London"].fatal_share_of_injury_pct is None and got["London"].injury_per_100k_per_year == 0
    assert got["Chicago"].injury_per_100k_per_year == round(2 / (366 / 365.25) / 2746388 * 1e5, 3)


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("crash_id"))
    a = {r.crash_id for r in H.sampled(df.repartition(3), "crash_id", 1).collect()}
    b = {r.crash_id for r in H.sampled(df.repartition(11), "crash_id", 1).collect()}
    assert a == b and abs(len(a) / 5000 - 0.8) < 0.03
    assert a != {r.crash_id for r in H.sampled(df, "crash_id", 2).collect()}


def test_cluster_summary(spark):
    rows = [(0, 41.0, -87.0, "fatal", 8), (0, 41.2, -87.2, "minor", 9), (0, 41.1, -87.1, "minor", 8), (0, 41.1, -87.1, "minor", 9),
            (-1, 1.0, 1.0, "fatal", 1)]
    df = spark.createDataFrame(rows, "cluster_id int, latitude double, longitude double, severity string, local_hour int")
    r = H.summarize_clusters(df).collect()
    assert len(r) == 1 and (r[0].size, r[0].centroid_lat, r[0].pct_fatal, r[0].pct_serious, r[0].peak_local_hour) == (
        4, 41.1, 25.0, 0.0, 8)


def test_profile_sections(spark):
    rows = [("1", "08/20/2017 01:29:00 PM", "08/20/2017 13:00", "0", "5", "111", "Y"),
            ("2", "bad", None, "41.9", "-87.7", None, None), ("2", "01/01/2018 10:00", "01/03/2018 10:00", "50", "-87.7", "250", None)]
    df = spark.createDataFrame(rows, "CRASH_RECORD_ID string, CRASH_DATE string, DATE_POLICE_NOTIFIED string, LATITUDE string, "
                                     "LONGITUDE string, BEAT_OF_OCCURRENCE string, HIT_AND_RUN_I string")
    c = P.coordinate_report(df).first()
    assert (c.rows_missing, c.rows_zero, c.rows_outside_box) == (0, 1, 1)
    d = {r.column_name: r for r in P.date_report(df).collect()}["CRASH_DATE"]
    assert (d.with_ampm, d.without_ampm, d.failed_to_parse) == (1, 2, 1)
    g = P.date_logic(df).first()
    assert (g.rows_notified_before_crash, g.max_gap_days) == (1, 2.0)
    assert {r.district: r.before_cutoff for r in P.district_coverage(df).collect()} == {1: True, 2: False}
    assert {r.kind: r.extra_rows for r in P.duplicate_report(df).collect()} == {"full_row": 0, "CRASH_RECORD_ID": 1}
    m = {r.column_name: (r.kind, r.null_count, r.pct_null) for r in P.missingness_report(df).collect()}
    assert m["HIT_AND_RUN_I"] == ("yes_only_flag", 2, 66.67)
    s = {r.column_name: r.status for r in P.schema_report(df).collect()}
    assert s["LATITUDE"] == "ok" and s["LOCATION"] == "missing"


def test_categories_keep_null_and_top(spark):
    df = spark.range(100).select(F.when(F.col("id") % 3 != 0, (F.col("id") % 40).cast("string")).alias("WEATHER_CONDITION"))
    out = P.category_report(df, top=5).collect()
    assert len(out) == 5 and out[0].value is None and out[0].n_rows == 34


# -- plans ---------------------------------------------------------------------------

def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@have_data
def test_month_slice_reads_one_folder(spark):
    df = A.month_slice(spark.read.parquet(published(spark, SMALL)), "chicago_us", "2024-03-01", "2024-04-01")
    counted = df.agg(F.count("*"))
    plan = physical(counted)
    assert "PartitionFilters: [isnotnull(source_id" in plan and "(month#" in plan and "PushedFilters: [IsNotNull(crash_date_key)" in plan
    assert "ReadSchema: struct<crash_date_key:date>" in plan


@have_data
def test_spatial_filter_is_pushed_down(spark):
    plan = physical(fact(spark, SMALL).where(A.in_box(A.DOWNTOWN)).select("severity"))
    assert "PushedFilters: [IsNotNull(has_valid_coordinates), IsNotNull(latitude)" in plan
    assert "ReadSchema: struct<latitude:double,longitude:double,has_valid_coordinates:boolean,severity:string>" in plan


@have_data
def test_share_of_total_has_no_single_partition_window(spark):
    plan = physical(A.top_causes(fact(spark, SMALL)))
    assert "Window" not in plan and "TakeOrderedAndProject" in plan


@have_data
def test_frame_rows_use_an_equi_join(spark):
    rows = FR.comparable(fact(spark, SMALL))
    plan = physical(FR.in_frames(spark, rows, FR.build_frames(spark, rows)))
    assert "BroadcastHashJoin [city_area" in plan and "Cartesian" not in plan


# -- registered queries beside their SQL ------------------------------------------------

FAST = ["map03_null_sentinel", "map04_value_map", "drv07_severity_from_counts", "tim01_local_to_utc", "flt08_in_frame",
        "agg08_rates_per_100k", "win04_latest_per_key", "sql06_severity_mix", "sql07_fatal_share", "sql13_latest_check_results",
        "dq09_run_checks", "snk05_upsert_fact", "prf10_categories", "eda07_weekday_shares", "cdq06_run_curated_checks"]


@have_data
@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("ALL_QUERIES") else FAST)
def test_query_matches_sql(spark, name):
    assert differences(spark, connect(SMALL), QUERIES[name], ORACLES[name], SMALL) is None
