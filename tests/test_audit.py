import pytest
from pyspark.sql import functions as F

from wayfuse.operators import audit as AU
from wayfuse.operators import checks as C
from wayfuse.operators import publish as PB
from wayfuse.operators import snapshots as SN
from wayfuse.operators.curate import harmonize, typed_rows, write_partitioned, write_staged
from wayfuse.sources.datasets import data_files, read_curated
from wayfuse.spec import CANONICAL_FIELDS, STAGED_SCHEMA

def run_time():
    return F.lit("2026-06-01 00:00:00").cast("timestamp")


BATCHES = {"chicago_us": "c1", "nyc_us": "n1", "uk_stats19": "u1"}


def feed(spark, source, n, text, batch=None, **extra):
    rows = []
    for i in range(n):
        row = {"source_id": source, "source_record_id": str(i), "crash_id": f"{source}:{i}", "batch_id": batch or BATCHES[source],
               "crash_timestamp_utc": text(i), "severity": "minor", "country": "US", "has_valid_coordinates": "false",
               "hit_and_run": "false", "source_local_timezone": "UTC", "city": "x", "ingested_at_utc": "2026-01-01", **extra}
        rows.append(tuple(row.get(c) for c in CANONICAL_FIELDS))
    return spark.createDataFrame(rows, STAGED_SCHEMA)


def frames(spark):
    return {
        "chicago_us": feed(spark, "chicago_us", 120, lambda i: "11/03/2024 01:30:00 AM" if i == 0
                           else f"{i % 12 + 1:02d}/10/2024 03:00:00 PM"),
        "nyc_us": feed(spark, "nyc_us", 80, lambda i: "2026-04-01T00:00:00.000 6:00"),
        "uk_stats19": feed(spark, "uk_stats19", 100, lambda i: "14/02/2023 08:30"),
    }


@pytest.fixture(scope="module")
def candidate(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("curated")
    paths = {s: write_staged(df, str(root / s)) for s, df in frames(spark).items()}
    return harmonize(spark, paths, BATCHES, str(root / "candidate"))


def verdicts(df):
    return {(r.check_name, r.source_id): r.status for r in df.collect()}


def test_ambiguous_hour_is_excluded_and_counted(spark, candidate):
    got = {r.source_id: (r.staged_rows, r.curated_rows, r.excluded_rows) for r in candidate.summary(spark).collect()}
    assert got == {"chicago_us": (120, 119, 1), "nyc_us": (80, 80, 0), "uk_stats19": (100, 100, 0)}


def test_clean_candidate_passes(spark, candidate):
    out = AU.audit(spark, candidate, run_time())
    assert set(verdicts(out).values()) == {"pass"} and out.count() == 3 + 3 + 3 + 1 + 2
    C.require_passed(out)


def test_folders_are_unpadded_and_single_files(spark, candidate):
    files = data_files(spark, candidate.path).collect()
    assert any("/month=2/" in f.path for f in files) and len(files) == 12 + 1 + 1
    assert sum(f.num_rows for f in files) == 299


def test_pruned_read(spark, candidate):
    df = read_curated(spark, candidate.path, "uk_stats19", 2023, 2, ["crash_id", "year"])
    assert df.count() == 100
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_id" in plan and "ReadSchema: struct<crash_id:string>" in plan


def test_reported_file_count(spark, candidate):
    out = AU.partition_check(candidate.rows(spark), data_files(spark, candidate.path), 99)
    assert verdicts(out)[("curated_partition_check", None)] == "fail"


def test_batches_must_match_paths(spark):
    with pytest.raises(ValueError):
        harmonize(spark, {"a": "x"}, {"b": "1"}, "/nowhere")


def test_wrong_date_layout_fails_reconciliation(spark):
    bad = feed(spark, "uk_stats19", 100, lambda i: "02/14/2023 08:30" if i % 2 else "14/02/2023 08:30")
    expected = spark.createDataFrame([("uk_stats19", "u1", 100)], "source_id string, batch_id string, staged_rows long")
    r = AU.reconciliation_check(typed_rows(bad), expected).first()
    assert (r.status, r.rows_failed) == ("fail", 50)


def test_tolerance_has_a_floor(spark):
    rows = typed_rows(feed(spark, "uk_stats19", 76, lambda i: "14/02/2023 08:30"))
    exp = "source_id string, batch_id string, staged_rows long"
    ok = AU.reconciliation_check(rows, spark.createDataFrame([("uk_stats19", "u1", 101)], exp)).first()
    over = AU.reconciliation_check(rows, spark.createDataFrame([("uk_stats19", "u1", 102)], exp)).first()
    assert (ok.status, over.status, over.rows_failed) == ("pass", "fail", 26)


def test_other_batch_missing_and_unexpected_source(spark):
    rows = typed_rows(feed(spark, "uk_stats19", 5, lambda i: "14/02/2023 08:30", batch="old")).unionByName(
        typed_rows(feed(spark, "chicago_us", 4, lambda i: "01/10/2024 03:00:00 PM")))
    exp = spark.createDataFrame([("uk_stats19", "u1", 5), ("nyc_us", "n1", 3)], "source_id string, batch_id string, staged_rows long")
    got = {r.source_id: (r.status, r.rows_failed, r.details) for r in AU.reconciliation_check(rows, exp).collect()}
    assert got["uk_stats19"][0] == "fail" and "5 rows of a batch other than u1" in got["uk_stats19"][2]
    assert got["nyc_us"][0] == "fail" and "no row of this source" in got["nyc_us"][2]
    assert got[None][:2] == ("fail", 4)


def test_timestamps(spark, candidate):
    rows = candidate.rows(spark).where("source_id = 'uk_stats19'")
    late = AU.timestamp_check(rows, F.lit("2023-02-12 00:00:00").cast("timestamp")).first()
    assert (late.status, late.rows_failed) == ("fail", 100)
    off = AU.timestamp_check(rows.withColumn("crash_date_key", F.date_add("crash_date_key", 1)), run_time()).first()
    assert off.rows_failed == 100
    old = AU.timestamp_check(rows.withColumn("crash_timestamp_utc", F.lit("1999-01-01").cast("timestamp")), run_time()).first()
    assert old.status == "fail"
    naive = AU.timestamp_check(rows.withColumn("crash_timestamp_utc", F.col("crash_timestamp_utc").cast("timestamp_ntz")), run_time())
    assert naive.first().status == "fail"


def test_misplaced_rows(spark, candidate):
    rows = candidate.rows(spark).withColumn("month", F.when(F.col("source_id") == "nyc_us", 5).otherwise(F.col("month")))
    got = verdicts(AU.partition_check(rows, data_files(spark, candidate.path)))
    assert got[("curated_partition_check", "nyc_us")] == "fail" and got[("curated_partition_check", "uk_stats19")] == "pass"


def test_schema_and_ids(spark, candidate):
    rows = candidate.rows(spark)
    assert AU.schema_check(rows.drop("severity")).first().status == "fail"
    assert AU.schema_check(rows.withColumn("latitude", F.col("latitude").cast("string"))).first().status == "fail"
    r = AU.uniqueness_check(rows.unionByName(rows.limit(3)).withColumn(
        "crash_id", F.when(F.col("crash_id") == "nyc_us:0", "nyc:0").otherwise(F.col("crash_id")))).first()
    assert r.status == "fail" and r.rows_failed >= 7


def test_publish_swaps_and_keeps_live_on_missing_candidate(spark, tmp_path):
    live, cand = str(tmp_path / "live"), str(tmp_path / "cand")
    df = typed_rows(frames(spark)["nyc_us"])
    write_partitioned(df, cand)
    assert PB.publish(spark, cand, live) == 1 and spark.read.parquet(live).count() == 80
    write_partitioned(df.limit(7), cand)
    PB.publish(spark, cand, live)
    assert spark.read.parquet(live).count() == 7
    with pytest.raises(FileNotFoundError):
        PB.publish(spark, cand, live)
    assert spark.read.parquet(live).count() == 7


@pytest.mark.parametrize("absent", ["crash_id", "source_record_id", "crash_timestamp_utc", "crash_date_key", "batch_id", "severity"])
def test_an_absent_column_fails_its_checks_only(spark, candidate, absent):
    rows = candidate.rows(spark).drop(absent)
    expected = spark.createDataFrame([(s, b, 0) for s, b in BATCHES.items()], "source_id string, batch_id string, staged_rows long")
    got = AU.audit_rows(rows, data_files(spark, candidate.path), expected, "run", run_time()).collect()
    assert len({r.check_name for r in got}) == 5
    assert {r.status for r in got if r.check_name == "curated_schema_check"} == {"fail"}


def test_load(spark, candidate, tmp_path):
    fact, dates = str(tmp_path / "fact"), str(tmp_path / "dates")
    assert PB.load(spark, candidate.path, fact, dates, dry_run=True)["rows_written"] == 0
    first = PB.load(spark, candidate.path, fact, dates, "chicago_us")
    assert first == {"rows_read": 119, "rows_written": 119, "dim_date_inserted": 12}
    again = PB.load(spark, candidate.path, fact, dates)
    assert again == {"rows_read": 299, "rows_written": 299, "dim_date_inserted": 2}
    assert SN.read(spark, fact).count() == 299 and spark.read.parquet(dates).count() == 14
    with pytest.raises(KeyError):
        PB.fact_rows(SN.read(spark, fact).drop("severity"))
