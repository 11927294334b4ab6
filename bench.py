"""Headline timings as one JSON line; scale and cores come from the environment."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import functions as F

from wayfuse import build_session
from wayfuse.operators import audit as AU
from wayfuse.operators import checks as C
from wayfuse.operators import hotspots as H
from wayfuse.operators import formats as FM
from wayfuse.operators.curate import harmonize
from wayfuse.operators.publish import dim_date_rows, dim_source, publish
from wayfuse.plans import analytics as A
from wayfuse.plans import landing as L
from wayfuse.plans.bindings import BATCHES
from wayfuse.plans.samples import at, raw_totals
from wayfuse.catalog.reports import _cluster_points
from wayfuse.session import scratch_path
from wayfuse.sources.datasets import read_staged

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = build_session("bench", cores=CPUS, **{
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn, runs=RUNS):
        fn()  # warm-up: code generation and file listing
        spent = []
        for _ in range(runs):
            start = time.perf_counter()
            fn()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent), 3)

    state = {}

    def stage():
        state["staged"] = L.stage_all(spark, SF_DIR)

    def curate():
        state["candidate"] = harmonize(spark, state["staged"], BATCHES, scratch_path(spark, "candidate"))

    timed("stage", stage)
    timed("validate", lambda: C.run_checks(read_staged(spark, state["staged"]), dim_source(spark),
                                           raw_totals(read_staged(spark, state["staged"]))).collect())
    timed("harmonize", curate)
    timed("audit", lambda: AU.audit(spark, state["candidate"], at("2026-01-05 07:00:00")).collect())
    live = scratch_path(spark, "live") + "/fact"
    publish(spark, state["candidate"].path, live)
    L.publish_as(spark, SF_DIR, live)

    fact = L.fact(spark, SF_DIR)
    dim = dim_source(spark)
    calendar_root = scratch_path(spark, "dim_date")
    dim_date_rows(fact).write.parquet(calendar_root)
    calendar = spark.read.parquet(calendar_root)
    sources = list(BATCHES)
    reports = {
        "load_verification": lambda: A.load_verification(fact),
        "natural_key_duplicates": lambda: A.duplicate_keys(fact, ["source_id", "source_record_id"]),
        "per_year_by_source": lambda: A.per_year_by_source(fact, calendar, sources),
        "local_hour_profile": lambda: A.local_hours(fact, dim),
        "local_weekday_profile": lambda: A.local_weekdays(fact, dim),
        "severity_mix": lambda: A.severity_mix(fact),
        "fatal_share": lambda: A.fatal_share(fact, dim),
        "top_causes": lambda: A.top_causes(fact),
        "monthly_trend": lambda: A.monthly_trend(fact),
        "coordinate_coverage": lambda: A.coordinate_coverage(fact),
        "downtown_severity": lambda: A.downtown_severity(fact),
        "month_slice": lambda: A.month_slice(fact, "chicago_us", "2024-03-01", "2024-04-01").agg(F.count("*")),
        "injury_rates": lambda: A.injury_rates(spark, fact, dim),
        "per_source_year": lambda: A.per_source_year(fact),
        "fatal_rate_mappable": lambda: A.fatal_rate_mappable(fact),
    }
    for name, build in reports.items():
        timed(name, lambda build=build: build().collect())

    # half a year, over 10,000 rows at sf0.1: as many as the published figures of the formats
    month = A.month_slice(fact, "chicago_us", "2023-12-01", "2024-06-01").drop("source_id", "year", "month")
    root = scratch_path(spark, "formats")
    for fmt in FM.FORMATS:
        timed(f"write_{fmt}", lambda fmt=fmt: FM.write_as(month, fmt, f"{root}/{fmt}"))
        timed(f"read_{fmt}", lambda fmt=fmt: FM.read_as(spark, fmt, f"{root}/{fmt}", month.schema)
              .write.format("noop").mode("overwrite").save())

    def hotspots():
        points, frames = _cluster_points(spark, SF_DIR)
        clustered = H.cluster_in_frames(H.frame_points(spark, points, frames))
        H.concentration(spark, clustered, frames).collect()

    timed("hotspots", hotspots)
    print(json.dumps({"metric": "total of median warm query times", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                      "cores": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
