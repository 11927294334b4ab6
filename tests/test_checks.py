import pytest
from pyspark.sql import functions as F

from wayfuse.operators import checks as C
from wayfuse.operators import report as R
from wayfuse.operators.publish import dim_source
from wayfuse.spec import CANONICAL_FIELDS, DQ_LOG_SCHEMA, STAGED_SCHEMA

GOOD = {"source_id": "chicago_us", "batch_id": "b1", "crash_timestamp_utc": "01/05/2021 08:00:00 AM",
        "source_local_timezone": "America/Chicago", "city": "Chicago", "country": "US", "has_valid_coordinates": "true",
        "severity": "minor", "hit_and_run": "false", "ingested_at_utc": "2026-01-01 00:00:00", "latitude": "41.9",
        "longitude": "-87.6", "posted_speed_limit_mph": "30",
        "police_notified_timestamp_utc": "01/05/2021 08:10:00 AM"}


def rows(spark, *changes):
    out = []
    for i, change in enumerate(changes):
        row = {**GOOD, "source_record_id": str(i), "crash_id": f"chicago_us:{i}", **change}
        out.append(tuple(row.get(c) for c in CANONICAL_FIELDS))
    return spark.createDataFrame(out, STAGED_SCHEMA)


def check(spark, df, name, **kw):
    r = C.run_checks(df, dim_source(spark), **kw).where(F.col("check_name") == name).first()
    return r.status, r.rows_checked, r.rows_failed, r.details


def test_clean_batch_passes(spark):
    out = C.run_checks(rows(spark, {}, {}), dim_source(spark)).collect()
    assert len(out) == 8 and {r.status for r in out} == {"pass"}
    C.require_passed(C.run_checks(rows(spark, {}, {}), dim_source(spark)))


def test_schema(spark):
    s = check(spark, rows(spark, {}, {}).drop("severity"), "schema_check")
    assert s[:3] == ("fail", 2, 2) and "severity" in s[3]


def test_nulls_and_structural_gap(spark):
    assert check(spark, rows(spark, {}, {"country": None, "city": None}), "nullability_check")[:3] == ("fail", 2, 2)
    uk = {"source_id": "uk_stats19", "city": None, "crash_timestamp_utc": "14/02/2023 08:30"}
    assert check(spark, rows(spark, uk), "nullability_check")[:3] == ("pass", 1, 0)


def test_duplicates(spark):
    s = check(spark, rows(spark, {}, {"source_record_id": "0"}, {"source_record_id": "0", "crash_id": "chicago_us:0"}),
              "uniqueness_check")
    assert s[:3] == ("fail", 3, 3) and "source_record_id=2, by crash_id=1" in s[3]


def test_accepted_values_show_samples(spark):
    changes = [{"severity": f"bad{i}"} for i in range(7)] + [{"country": "FR"}, {"severity": None}]
    s = check(spark, rows(spark, *changes), "accepted_values_check")
    assert s[:3] == ("fail", 9, 8) and "bad0, bad1, bad2, bad3, bad4]" in s[3] and "country=1 [FR]" in s[3]


def test_speed_band_warns(spark):
    s = check(spark, rows(spark, *[{"posted_speed_limit_mph": v} for v in ("30", "5", "1", "100")]), "range_check")
    assert s[:3] == ("warn", 4, 2)


def test_range_and_box_fail(spark):
    assert check(spark, rows(spark, {"num_killed": "-1"}, {"posted_speed_limit_mph": "250"}), "range_check")[:3] == ("fail", 2, 2)
    assert check(spark, rows(spark, {"latitude": "12"}, {"latitude": None}, {"latitude": "12", "longitude": "0"}),
                 "range_check")[:3] == ("fail", 3, 3)


def test_date_logic_tolerance(spark):
    early = {"police_notified_timestamp_utc": "01/05/2021 07:00:00 AM"}
    assert check(spark, rows(spark, {}, early), "date_logic_check")[:3] == ("warn", 2, 1)
    assert check(spark, rows(spark, *[early] * 6), "date_logic_check")[:3] == ("fail", 6, 6)
    assert "Skipped" in check(spark, rows(spark, {"source_id": "nyc_us"}), "date_logic_check")[3]


def test_unknown_source(spark):
    assert check(spark, rows(spark, {"source_id": "paris_fr"}), "referential_check")[:3] == ("fail", 1, 1)


def test_row_count(spark):
    totals = spark.createDataFrame([("chicago_us", "b1", 1)], "source_id string, batch_id string, total_records_or_files long")
    assert check(spark, rows(spark, {}, {}), "row_count_check", totals=totals)[0] == "warn"
    batches = spark.createDataFrame([("chicago_us", "b2")], "source_id string, batch_id string")
    assert check(spark, rows(spark, {}), "row_count_check", batches=batches)[:3] == ("fail", 0, 0)


def test_failure_raises_with_every_check(spark):
    with pytest.raises(RuntimeError, match="2 check.s. failed"):
        C.require_passed(C.run_checks(rows(spark, {"country": None}, {"severity": "x", }), dim_source(spark)))


def test_hot_key_and_null_keys_count_as_copies(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.when(F.col("id") < 400, "hot").when(F.col("id") > 899, None)
                                  .otherwise(F.col("id").cast("string")).alias("k"))
    assert C.duplicate_counts(df, ["g"], {"d": ["k"]}).first().d == 399 + 99


def log(spark, *entries):
    base = ("b1", "chicago_us", "range_check", "pass", 10, 0, "fine", "2026-01-05 07:00:00")
    names = DQ_LOG_SCHEMA.fieldNames()
    data = [tuple({**dict(zip(names, base)), **e}[n] for n in names) for e in entries]
    schema = ", ".join(f"{n} {'long' if n.startswith('rows') else 'string'}" for n in names)
    return spark.createDataFrame(data, schema).withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp"))


def test_log_is_appended_and_cut(spark, tmp_path):
    root = str(tmp_path / "log")
    results = log(spark, {"details": "x" * 3000}).drop("run_timestamp")
    C.append_log(results, root)
    C.append_log(results, root)
    out = spark.read.parquet(root).collect()
    assert len(out) == 2 and len(out[0].details) == 1000


def test_report(spark, tmp_path):
    df = log(spark, {"source_id": None, "status": "fail", "details": "a|b\nc" + "x" * 300}, {},
             {"run_timestamp": "2025-01-01 00:00:00"})
    since = F.lit("2026-01-01").cast("timestamp")
    cells = R.report_cells(df, since).collect()
    assert [c.source for c in cells] == ["chicago_us", "all sources"]
    assert cells[1].details.startswith("a\\|b c") and len(cells[1].details) == 200 and cells[1].status == "FAIL"
    counts = R.report_counts(df, since).first()
    assert (counts.checks_run, counts.passed, counts.failed, counts.sources) == (2, 1, 1, 1)
    R.write_markdown(df, since, str(tmp_path / "report"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "report")).collect())
    assert "**1 pass, 0 warn, 1 fail** across 1 source(s)" in text and "| all sources | b1 |" in text


@pytest.mark.parametrize("absent", CANONICAL_FIELDS)
def test_any_absent_column_leaves_eight_results(spark, absent):
    row = {"source_id": "uk_stats19", "batch_id": "u1", "source_record_id": "1", "crash_id": "uk_stats19:1", "severity": "minor"}
    rows = spark.createDataFrame([tuple(row.get(c) for c in CANONICAL_FIELDS)], STAGED_SCHEMA).drop(absent)
    got = C.run_checks(rows, dim_source(spark)).collect()
    assert [r.check_name for r in got] == list(C.CHECKS)
    assert {r.status for r in got if r.check_name == "schema_check"} == {"fail"}
