import hashlib

import pytest
from pyspark.sql import functions as F

from wayfuse.operators import hotspots as H
from wayfuse.operators import profile as P
from wayfuse.session import setting


@pytest.mark.parametrize("most", [0, 1, 37, 500, 10_000])
def test_row_sample_is_exact_and_does_not_depend_on_partitions(spark, most):
    rows = [(f"k{i}", ["a", "b", None][i % 3] if i % 50 else "rare") for i in range(1500)]
    df = spark.createDataFrame(rows, "id string, g string")
    want = set()
    for g in {g for _, g in rows}:
        own = sorted((hashlib.md5(f"{k}/7".encode()).hexdigest(), k) for k, h in rows if h == g)
        want |= {(k, g) for _, k in own[:most]}
    for parts in (1, 7):
        got = H.sampled_rows(df.repartition(parts), "id", 7, most, ["g"]).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    whole = sorted((hashlib.md5(f"{k}/7".encode()).hexdigest(), k) for k, _ in rows)[:most]
    assert {r.id for r in H.sampled_rows(df, "id", 7, most).collect()} == {k for _, k in whole}


def test_row_sample_within_one_range(spark, monkeypatch):
    """All digests alike in their first digits: the rows of the range are put in order."""
    monkeypatch.setattr(H, "_sample_digest", lambda key, seed: F.concat(F.lit("00ff"), F.lpad(F.col(key), 8, "0")))
    df = spark.range(300).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("g"))
    got = H.sampled_rows(df, "id", 0, 20, ["g"]).collect()
    assert sorted(int(r.id) for r in got) == list(range(40))
    assert H.sampled_rows(df.where("id < '0'"), "id", 0, 20, ["g"]).count() == 0


def test_copies_by_digest_are_those_by_value(spark):
    rows = [("a", "b"), ("a", "b"), ("ab", ""), ("ab", None), ("", "ab"), (None, "ab"), (None, None), (None, None), ("1:a", "b"), ("1", "a,1:b")]
    df = spark.createDataFrame(rows, "x string, y string")
    got = {r.kind: r.extra_rows for r in P.extra_copies_by(df, {"row": ["x", "y"], "x": ["x"]}).collect()}
    assert got == {"row": 2, "x": 10 - len({x for x, _ in rows})}
    assert P.extra_copies(df.where("x = 'none'"), ["x", "y"]).first().extra_rows == 0


def test_copies_whose_digests_meet_by_chance(spark, monkeypatch):
    monkeypatch.setattr(P, "row_digest", lambda columns: F.lit(b"same"))
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert P.extra_copies(df, ["x"]).first().extra_rows == 1


def test_report_scans_the_table_five_times_at_most(spark, tmp_path):
    columns = ["CRASH_RECORD_ID", "CRASH_DATE", "DATE_POLICE_NOTIFIED", "LATITUDE", "LONGITUDE", "POSTED_SPEED_LIMIT", "BEAT_OF_OCCURRENCE",
               "MOST_SEVERE_INJURY", "INJURIES_TOTAL", "INJURIES_FATAL"]
    rows = [("1", "01/02/2020 03:04:05 PM", None, "41.8", "-87.6", "30", "0123", "FATAL", "1", "1"),
            ("1", "01/02/2020 03:04:05 PM", None, "41.8", "-87.6", "30", "0123", "FATAL", "1", "1"),
            ("2", "nonsense", None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).write.parquet(str(tmp_path / "t"))
    scans = []
    real = P.saved
    def counted(df, label):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return real(df, label)
    P.saved, kept = counted, P.saved
    try:
        report = P.build_report(spark.read.parquet(str(tmp_path / "t")))
    finally:
        P.saved = kept
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert sum(scans) + plan.count(f"{tmp_path}/t]") <= 5, plan
    got = {(r.section, r.entry, r.measure): (r.number, r.text, r.time) for r in report.collect()}
    assert got["duplicates", "full_row", "extra_rows"][0] == 1 and got["dates", "CRASH_DATE", "failed_to_parse"][0] == 1
    assert got["near_empty", "DATE_POLICE_NOTIFIED", "near_empty"][0] == 1 and ("near_empty", "LATITUDE", "near_empty") not in got
    assert got["district_summary", "all", "n_districts"][0] == 1 and got["injuries", "all", "rows_without_injury_data"][0] == 1
    P.write_report(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "out"), now=F.lit("2021-01-01").cast("timestamp"))
    assert P.read_report(spark, str(tmp_path / "out")).count() == report.count()


def test_row_sample_sends_no_rows_to_meet_the_last_ones(spark):
    """However large the estimate: one row per group meets the rows where they lie."""
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = H.sampled_rows(df, "id", 3, 40, ["g"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert sorted((r.g is None, r.g or 0, r["count"]) for r in out.groupBy("g").count().collect()) == [(False, 1, 40), (False, 2, 40), (True, 0, 40)]
