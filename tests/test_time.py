import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfuse.functions import timeparse as T
from wayfuse.operators.curate import cast_canonical, drop_without, typed_rows
from wayfuse.spec import ADAPTERS, CANONICAL_FIELDS, CURATED_SCHEMA, STAGED_SCHEMA


def utc(spark, source, texts):
    df = spark.createDataFrame([(i, source, t) for i, t in enumerate(texts)], "i int, source_id string, t string")
    rows = T.with_utc(df, ["t"], ADAPTERS.values()).orderBy("i").collect()
    return [None if r.t is None else r.t.isoformat(sep=" ") for r in rows]


def test_chicago_clock(spark):
    assert utc(spark, "chicago_us", ["08/20/2026 01:29:00 PM", "01/05/2021 12:00:00 AM", "8/2/2026 1:05:00 am"]) == [
        "2026-08-20 18:29:00", "2021-01-05 06:00:00", "2026-08-02 06:05:00"]


def test_hours_of_the_clock_change_are_unknown(spark):
    assert utc(spark, "chicago_us", ["03/10/2024 02:30:00 AM", "11/03/2024 01:30:00 AM", "11/03/2024 02:00:00 AM",
                                     "03/10/2024 01:59:00 AM", "11/03/2024 12:59:00 AM"]) == [
        None, None, "2024-11-03 08:00:00", "2024-03-10 07:59:00", "2024-11-03 05:59:00"]
    assert utc(spark, "uk_stats19", ["31/03/2024 01:30", "27/10/2024 01:30", "27/10/2024 02:00"]) == [
        None, None, "2024-10-27 02:00:00"]


def test_wrong_layout_is_null_not_guessed(spark):
    assert utc(spark, "uk_stats19", ["13/02/2023 08:30", "02/13/2023 08:30", "2023-02-13 08:30", None, "31/02/2023 08:30"]) == [
        "2023-02-13 08:30:00", None, None, None, None]


def test_iso_with_its_own_time(spark):
    assert utc(spark, "nyc_us", ["2026-04-01T00:00:00.000 6:00", "2026-04-01T00:00:00.000 14:50",
                                 "2026-04-01T14:50:00.000", "2026-04-01 06:00", "later"]) == [
        "2026-04-01 10:00:00", "2026-04-01 18:50:00", "2026-04-01 18:50:00", "2026-04-01 10:00:00", None]


def test_clock_changes_of_any_size(spark):
    """Half an hour back and forth, and a whole day left out."""
    def utc_of(zone, *texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(
            F.date_format(T.local_to_utc(F.col("t").cast("timestamp"), zone), "yyyy-MM-dd HH:mm").alias("u"))
        return [r.u for r in df.collect()]
    assert utc_of("Australia/Lord_Howe", "2024-04-07 01:15:00", "2024-04-07 01:45:00", "2024-04-07 02:00:00", "2024-10-06 02:15:00",
                  "2024-10-06 02:30:00") == ["2024-04-06 14:15", None, "2024-04-06 15:30", None, "2024-10-05 15:30"]
    assert utc_of("Pacific/Apia", "2011-12-29 23:30:00", "2011-12-30 12:00:00", "2011-12-31 00:30:00") == [
        "2011-12-30 09:30", None, "2011-12-30 10:30"]


def test_mixed_layouts(spark):
    df = spark.createDataFrame([("08/20/2026 01:29:00 PM",), ("08/20/2026 13:29",), ("x",)], "t string")
    assert [r.v for r in df.select(T.parse_mixed(F.col("t")).alias("v")).collect()] == [
        dt.datetime(2026, 8, 20, 13, 29), dt.datetime(2026, 8, 20, 13, 29), None]


def test_local_calendar_uses_the_rows_zone(spark):
    df = spark.createDataFrame([("2024-01-06 03:00:00", "America/Chicago"), ("2024-01-06 03:00:00", "Europe/London")],
                               "t string, source_local_timezone string").withColumn(
        "crash_timestamp_utc", F.col("t").cast("timestamp"))
    a, b = T.add_local_time(df).collect()
    assert (str(a.local_date), a.local_hour, a.local_dow, a.is_weekend) == ("2024-01-05", 21, 4, False)
    assert (str(b.local_date), b.local_hour, b.local_dow, b.is_weekend) == ("2024-01-06", 3, 5, True)


def staged(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in CANONICAL_FIELDS) for r in rows], STAGED_SCHEMA)


def test_types_hold_when_all_values_are_null(spark):
    out = typed_rows(staged(spark, [{"source_id": "nyc_us", "crash_timestamp_utc": "2026-04-01 6:00"}]))
    want = {f.name: f.dataType for f in CURATED_SCHEMA}
    assert {f.name: f.dataType for f in out.schema} == want


def test_rows_without_utc_are_dropped(spark):
    rows = [{"source_id": "chicago_us", "source_record_id": str(i), "crash_timestamp_utc": t}
            for i, t in enumerate(["11/03/2024 01:30:00 AM", "11/03/2024 03:30:00 AM", None])]
    assert [r.source_record_id for r in typed_rows(staged(spark, rows)).collect()] == ["1"]


def test_values_that_do_not_fit_become_null(spark):
    row = cast_canonical(staged(spark, [{"source_id": "chicago_us", "num_killed": "x", "latitude": "north",
                                         "hit_and_run": "Y", "num_injured_total": "2.0"}])).first()
    assert (row.num_killed, row.latitude, row.hit_and_run, row.num_injured_total) == (None, None, True, 2)


def test_time_is_converted_once_per_row(spark):
    plan = drop_without(cast_canonical(staged(spark, [{"source_id": "x"}])), "crash_timestamp_utc")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("to_utc_timestamp(_local_crash_timestamp_utc") <= 3  # one per source
