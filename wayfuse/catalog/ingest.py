"""Queries of the sources, file operators, sinks and incremental batches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from wayfuse.catalog.registry import query
from wayfuse.operators import formats as FM
from wayfuse.operators import profile as P
from wayfuse.operators import publish as PB
from wayfuse.operators import report as R
from wayfuse.operators import snapshots as SN
from wayfuse.operators.checks import append_log
from wayfuse.operators.curate import harmonize, write_partitioned, write_staged
from wayfuse.operators.merging import NATURAL_KEY
from wayfuse.plans import landing as L
from wayfuse.plans.analytics import month_slice
from wayfuse.plans.bindings import curated, raw_events, raw_lineitem, raw_orders, staged, table
from wayfuse.plans.samples import FIRST_RUN, SECOND_RUN, at, check_log, check_results, freshness_results
from wayfuse.session import saved, scratch_path
from wayfuse.sources import datasets as DS
from wayfuse.sources import files as FL
from wayfuse.sources import text as TX
from wayfuse.spec import EXPECTED_YEARS, FACT_COLUMNS, INJURY_SEVERITIES, RESIDENTS, UK
from wayfuse.streaming.incremental import amended_window, apply_amendments


# -- sources ---------------------------------------------------------------------

@query("src01_csv_text_scan", "SELECT * FROM raw_a")
def src01(spark, sf):
    rows = raw_orders(spark, sf)
    root = L.land_csv(rows, scratch_path(spark, "export"))
    return TX.read_csv_text(spark, root, rows.columns)


_NOTED = """
CASE WHEN CAST(CRASH_RECORD_ID AS BIGINT) % 7 = 0 THEN 'said "' || PRIM_CONTRIBUTORY_CAUSE || '",' || chr(10) || 'then left'
  ELSE PRIM_CONTRIBUTORY_CAUSE END"""


def _noted(spark, sf):
    """The export with quotes, commas and line ends inside a cell of every seventh row."""
    rows = raw_orders(spark, sf)
    note = F.concat(F.lit('said "'), "PRIM_CONTRIBUTORY_CAUSE", F.lit('",\nthen left'))
    return rows.withColumn("PRIM_CONTRIBUTORY_CAUSE", F.when(F.col("CRASH_RECORD_ID").cast("long") % 7 == 0, note)
                           .otherwise(F.col("PRIM_CONTRIBUTORY_CAUSE")))


@query("src01_quoted_line_ends", f"SELECT r.* REPLACE ({_NOTED} AS PRIM_CONTRIBUTORY_CAUSE) FROM raw_a r")
def src01b(spark, sf):
    rows = _noted(spark, sf)
    return TX.read_csv_text(spark, L.land_csv(rows, scratch_path(spark, "quoted")), rows.columns, multi_line=True)


@query("src03_quoted_union", f"""
SELECT r.* REPLACE ({_NOTED} AS PRIM_CONTRIBUTORY_CAUSE, CASE WHEN HIT_AND_RUN_I = 'Y' THEN NULL ELSE BEAT_OF_OCCURRENCE END AS BEAT_OF_OCCURRENCE)
FROM raw_a r""")
def src03b(spark, sf):
    rows = _noted(spark, sf)
    flagged = F.coalesce(F.col("HIT_AND_RUN_I") == "Y", F.lit(False))
    first = L.land_csv(rows.where(flagged).drop("BEAT_OF_OCCURRENCE"), scratch_path(spark, "quoted-one"))
    second = L.land_csv(rows.where(~flagged), scratch_path(spark, "quoted-two"))
    return TX.read_csv_union(spark, [first, second], multi_line=True).select(*rows.columns)


@query("src02_json_page_scan", "SELECT * FROM raw_b")
def src02(spark, sf):
    rows = raw_events(spark, sf)
    root = L.land_pages(rows, F.col("collision_id").cast("long"), scratch_path(spark, "pages"))
    return TX.read_json_pages(spark, root, rows.columns)


@query("src03_multi_file_union", """
SELECT r.* REPLACE (CASE WHEN HIT_AND_RUN_I = 'Y' THEN NULL ELSE BEAT_OF_OCCURRENCE END AS BEAT_OF_OCCURRENCE) FROM raw_a r""")
def src03(spark, sf):
    rows = raw_orders(spark, sf)
    flagged = F.coalesce(F.col("HIT_AND_RUN_I") == "Y", F.lit(False))
    first = L.land_csv(rows.where(flagged).drop("BEAT_OF_OCCURRENCE"), scratch_path(spark, "part-one"))
    second = L.land_csv(rows.where(~flagged), scratch_path(spark, "part-two"))
    return TX.read_csv_union(spark, [first, second]).select(*rows.columns)


@query("src04_parquet_scan", "SELECT crash_id, source_id, severity, crash_timestamp_utc, batch_id FROM staged")
def src04(spark, sf):
    return DS.read_staged(spark, L.stage_all(spark, sf)).select(
        "crash_id", "source_id", "severity", "crash_timestamp_utc", "batch_id")


@query("src05_partition_pruned_scan", """
SELECT crash_id, source_id, year, month, severity FROM curated WHERE source_id = 'chicago_us' AND year = 2020 AND month = 3""")
def src05(spark, sf):
    return DS.read_curated(spark, L.published(spark, sf), "chicago_us", 2020, 3).select(
        "crash_id", F.col("source_id").cast("string").alias("source_id"), "year", "month", "severity")


@query("src06_column_projected_scan", "SELECT crash_id, batch_id, crash_timestamp_utc, crash_date_key FROM curated")
def src06(spark, sf):
    return DS.read_curated(spark, L.published(spark, sf),
                           columns=["crash_id", "batch_id", "crash_timestamp_utc", "crash_date_key"])


@query("src07_predicate_pushdown_scan", """
SELECT crash_id, latitude, longitude FROM curated WHERE has_valid_coordinates AND severity IN ('fatal', 'serious', 'minor')""")
def src07(spark, sf):
    return DS.read_comparable(spark, L.published(spark, sf), INJURY_SEVERITIES).select("crash_id", "latitude", "longitude")


@query("src08_file_inventory", """
SELECT source_id, year, month, count(*) AS num_rows FROM curated GROUP BY ALL""")
def src08(spark, sf):
    return DS.data_files(spark, L.published(spark, sf)).groupBy("source_id", "year", "month").agg(
        F.sum("num_rows").alias("num_rows"))


@query("src09_csv_sanity_scan", """
SELECT 'dft-road-casualty-statistics-collision-' || date[7:10] || '.csv' AS name, true AS utf8, 12 AS header_columns,
  count(*) AS row_count, 'ok' AS status FROM raw_c GROUP BY ALL""")
def src09(spark, sf):
    return FL.csv_sanity(spark, L.land_annual(spark, sf))


def _tree_sql(name: str) -> str:
    """Hashes of files of whole lines: of the content, or of the hashes of its chunks (up to as many as a node holds)."""
    return f"""
SELECT name, any_value(size_bytes) AS size_bytes,
  CASE WHEN count(*) = 1 THEN any_value(leaf) ELSE sha256(string_agg(leaf, '' ORDER BY n)) END AS sha256
FROM (SELECT name, strlen(content) AS size_bytes, n, sha256(substr(content, n * {FL.CHUNK} + 1, {FL.CHUNK})) AS leaf
      FROM (SELECT name, content, unnest(range((strlen(content) - 1) // {FL.CHUNK} + 1)) AS n
            FROM (SELECT {name} AS name, string_agg(concat_ws(',', collision_index, date, time, number_of_vehicles) || chr(10), ''
                    ORDER BY collision_index) AS content FROM raw_c GROUP BY 1))) GROUP BY name"""


def _landed_lines(spark, sf, name):
    rows = raw_lineitem(spark, sf)
    line = F.concat_ws(",", "collision_index", "date", "time", "number_of_vehicles")
    return L.land_lines(rows.select(name.alias("file"), line.alias("line"), "collision_index"), scratch_path(spark, "lines"), "collision_index")


@query("src10_file_fingerprint", _tree_sql("'annual-' || date[7:10] || '.csv'"))
def src10(spark, sf):
    name = F.concat(F.lit("annual-"), F.substring("date", 7, 4), F.lit(".csv"))
    return FL.fingerprints(spark, _landed_lines(spark, sf, name)).select("name", "size_bytes", "sha256")


@query("src10_large_file_fingerprint", _tree_sql("'all-years.csv'"))
def src10c(spark, sf):
    """The whole feed as one named file of many parts and many chunks."""
    return FL.fingerprints(spark, _landed_lines(spark, sf, F.lit("all-years.csv"))).select("name", "size_bytes", "sha256")


@query("src09_quoted_sanity_scan", """
SELECT 'export-' || (CAST(CRASH_RECORD_ID AS BIGINT) % 3) || '.csv' AS name, true AS utf8, count(*) AS row_count, 'ok' AS status,
  (SELECT count(*) FROM (DESCRIBE raw_a))::INTEGER AS header_columns FROM raw_a GROUP BY 1""")
def src09b(spark, sf):
    name = F.concat(F.lit("export-"), F.col("CRASH_RECORD_ID").cast("long") % 3, F.lit(".csv"))
    return FL.csv_sanity(spark, L.land_csv(_noted(spark, sf), scratch_path(spark, "quoted"), name), multi_line=True)


@query("src10_content_fingerprint", "SELECT doc_id, sha256(text) AS sha256, strlen(text) AS size_bytes FROM documents")
def src10b(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select("doc_id", F.sha2(text, 256).alias("sha256"),
                                                F.octet_length(text).cast("long").alias("size_bytes"))


@query("src11_newest_file_pick", """
SELECT 'Traffic_Crashes_-_Crashes_' || max(strftime(strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p'), '%Y')) || '1231.csv' AS name, 'ok' AS status FROM raw_a""")
def src11(spark, sf):
    rows = raw_orders(spark, sf)
    name = F.concat(F.lit("Traffic_Crashes_-_Crashes_"), F.substring("CRASH_DATE", 7, 4), F.lit("1231.csv"))
    root = L.land_csv(rows, scratch_path(spark, "incoming"), name)
    return FL.newest_file(FL.listed(spark, root), "Traffic_Crashes_-_Crashes_*.csv").select("name", "status")


@query("src12_expected_files_resolve", """
SELECT CAST(y AS INTEGER) AS year, CASE WHEN count(date) > 0 THEN 'ok' ELSE 'missing' END AS status
FROM range(2021, 2026) r(y) LEFT JOIN raw_c ON CAST(date[7:10] AS INTEGER) = y GROUP BY y""")
def src12(spark, sf):
    files = FL.listed(spark, L.land_annual(spark, sf))
    return FL.expected_files(spark, files, EXPECTED_YEARS, UK.refresh["incoming_pattern"]).select("year", "status")


def _annual_manifest(spark, root, batch="uk_stats19_b1"):
    return FL.manifest_entries(FL.fingerprints(spark, root), FL.csv_sanity(spark, root), "uk_stats19", batch,
                               retrieved_at=at(FIRST_RUN))


@query("src13_raw_manifest", """
SELECT 'uk_stats19' AS source_id, 'uk_stats19_b1' AS batch_id, count(DISTINCT date[7:10]) AS file_count,
  count(*) AS total_records_or_files, TIMESTAMP '2026-01-05 07:00:00' AS retrieved_at_utc FROM raw_c""")
def src13(spark, sf):
    root = scratch_path(spark, "manifest")
    FL.append_manifest(_annual_manifest(spark, L.land_annual(spark, sf)), root)
    return FL.batch_totals(spark.read.parquet(root))


@query("src14_change_detect", """
SELECT 'chicago_us' AS source_id, 'chicago_us_b1' AS previous_batch_id, false AS content_changed
UNION ALL SELECT 'uk_stats19', 'uk_stats19_b1', true""")
def src14(spark, sf):
    annual = L.land_annual(spark, sf)
    export = L.land_csv(raw_orders(spark, sf), scratch_path(spark, "export"), F.lit("export.csv"))
    prints = FL.fingerprints(spark, export)
    manifest = _annual_manifest(spark, annual).unionByName(
        FL.manifest_entries(prints, None, "chicago_us", "chicago_us_b1", retrieved_at=at(FIRST_RUN)))
    # The annual files come again, with every severity of the newest year revised.
    rows = raw_lineitem(spark, sf)
    newest = rows.agg(F.max(F.substring("date", 7, 4)).alias("_y"))
    revised = (rows.join(F.broadcast(newest)).where(F.substring("date", 7, 4) == F.col("_y")).drop("_y")
               .withColumn("collision_severity", F.lit("3")))
    again = FL.fingerprints(spark, L.land_csv(revised, scratch_path(spark, "annual"), L.annual_name()))
    kept = FL.fingerprints(spark, annual).join(again.select("name"), "name", "left_anti")
    incoming = kept.unionByName(again).select(F.lit("uk_stats19").alias("source_id"),
                                              F.col("name").alias("file_name"), "sha256").unionByName(
        prints.select(F.lit("chicago_us").alias("source_id"), F.col("name").alias("file_name"), "sha256"))
    present = FL.listed(spark, annual).unionByName(FL.listed(spark, export)).select(F.col("path").alias("raw_path"))
    return FL.detect_change(manifest, incoming, present)


@query("src15_trailing_window_pull", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
WHERE CAST(l_shipdate AS DATE) >= (SELECT max(CAST(l_shipdate AS DATE)) - 90 FROM lineitem)""")
def src15(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                               F.to_date(F.col("l_shipdate").cast("timestamp")).alias("ship_date"))
    return TX.trailing_window(rows, "ship_date", 90)


@query("src16_page_overlap_dedup", """
SELECT record, date, time, number_of_vehicles, collision_index FROM (
  SELECT *, regexp_replace(collision_index, '-.*-', '-') AS record, row_number() OVER (PARTITION BY regexp_replace(collision_index, '-.*-', '-')
    ORDER BY strptime(date, '%d/%m/%Y') DESC, collision_index DESC) AS r FROM raw_c) WHERE r = 1""")
def src16(spark, sf):
    rows = raw_lineitem(spark, sf).select(
        F.regexp_replace("collision_index", "-.*-", "-").alias("record"), "date", "time",
        "number_of_vehicles", "collision_index", F.to_date("date", "dd/MM/yyyy").alias("_day"))
    return TX.drop_page_overlap(rows, "record", "_day", "collision_index").drop("_day")


@query("src17_literal_rows", """
SELECT city_area AS city, residents::BIGINT AS residents, count(crash_id) AS crashes FROM city_facts LEFT JOIN curated ON city = city_area GROUP BY ALL""")
def src17(spark, sf):
    people = spark.createDataFrame(list(RESIDENTS.items()), "city string, residents long")
    counted = curated(spark, sf).groupBy("city").agg(F.count("*").alias("crashes"))
    return people.join(counted, "city", "left").na.fill(0, ["crashes"])


@query("src18_newest_batch_per_source", """
SELECT source_id, CASE source_id WHEN 'chicago_us' THEN 'chicago_us_b2' ELSE source_id || '_b1' END AS batch_id, count(*) AS staged_rows
FROM staged GROUP BY ALL""")
def src18(spark, sf):
    root = scratch_path(spark, "staging")
    rows = staged(spark, sf)
    again = staged(spark, sf, "chicago_us").withColumn("batch_id", F.lit("chicago_us_b2"))
    rows.unionByName(again).write.partitionBy("source_id", "batch_id").parquet(root)
    found = spark.read.parquet(root)
    listed = found.select("source_id", "batch_id").distinct()
    return (found.join(F.broadcast(FL.latest_batches(listed)), ["source_id", "batch_id"])
            .groupBy("source_id", "batch_id").agg(F.count("*").alias("staged_rows")))


# -- sinks -----------------------------------------------------------------------

@query("snk01_staged_write", "SELECT * FROM staged_c")
def snk01(spark, sf):
    return spark.read.parquet(write_staged(staged(spark, sf, "uk_stats19"), scratch_path(spark, "staged")))


@query("snk02_partitioned_write", """
SELECT source_id, year, month, count(*) AS n, sum(num_injured_total)::BIGINT AS injured, min(crash_timestamp_utc) AS first FROM curated GROUP BY ALL""")
def snk02(spark, sf):
    root = write_partitioned(curated(spark, sf), scratch_path(spark, "curated"), repeatable=True)
    return spark.read.parquet(root).groupBy(F.col("source_id").cast("string").alias("source_id"), "year", "month").agg(
        F.count("*").alias("n"), F.sum("num_injured_total").alias("injured"), F.min("crash_timestamp_utc").alias("first"))


@query("snk03_candidate_summary", """
SELECT source_id, source_id || '_b1' AS batch_id, count(*) AS staged_rows, count(crash_timestamp_utc) AS curated_rows,
  count(*) - count(crash_timestamp_utc) AS excluded_rows FROM timed GROUP BY source_id""")
def snk03(spark, sf):
    return L.candidate(spark, sf).summary(spark).select("source_id", "batch_id", "staged_rows", "curated_rows", "excluded_rows")


@query("snk04_publish_swap", "SELECT source_id, severity, count(*) AS n FROM curated GROUP BY ALL")
def snk04(spark, sf):
    live = scratch_path(spark, "live") + "/fact"
    write_partitioned(curated(spark, sf, "nyc_us"), live)
    PB.publish(spark, write_partitioned(curated(spark, sf), scratch_path(spark, "candidate"), repeatable=True), live)
    return spark.read.parquet(live).groupBy(F.col("source_id").cast("string").alias("source_id"), "severity").agg(
        F.count("*").alias("n"))


def _revised(rows):
    """The same records in a later batch, their severities revised."""
    return rows.withColumns({"severity": F.lit("unknown"), "batch_id": F.concat("source_id", F.lit("_b2"))})


def _amended(rows):
    """A later batch: each source's trailing window again."""
    return _revised(amended_window(rows, "crash_date_key", by=["source_id"]))


def _before(rows, days):
    """Rows without each source's newest days."""
    newest = rows.groupBy("source_id").agg(F.max("crash_date_key").alias("_m"))  # one row per source
    return (rows.join(F.broadcast(newest), "source_id").where(F.col("crash_date_key") <= F.date_sub("_m", days))
            .select(*rows.columns))


_UPSERTED = """
SELECT crash_id, CASE WHEN crash_date_key >= m - 90 THEN 'unknown' ELSE severity END AS severity,
  CASE WHEN crash_date_key >= m - 90 THEN source_id || '_b2' ELSE batch_id END AS batch_id,
  CASE WHEN crash_date_key >= m - 90 THEN TIMESTAMP '2026-01-12 07:00:00' ELSE ingested_at_utc END AS ingested_at_utc
FROM curated JOIN (SELECT source_id, max(crash_date_key) AS m FROM curated GROUP BY 1) USING (source_id)"""


@query("snk04_publish_snapshot", """
SELECT 'before' AS state, source_id, count(*) AS n FROM curated WHERE source_id = 'nyc_us' GROUP BY ALL
UNION ALL SELECT 'now', source_id, count(*) FROM curated GROUP BY ALL""")
def snk04b(spark, sf):
    """A reader that resolved the table before the candidate was published, and one after."""
    root = scratch_path(spark, "table")
    old = SN.replace(spark, root, curated(spark, sf, "nyc_us"))
    before = SN.read(spark, old)
    SN.publish(spark, write_partitioned(curated(spark, sf), scratch_path(spark, "candidate"), repeatable=True), root)
    both = before.select(F.lit("before").alias("state"), F.col("source_id").cast("string")).unionByName(
        SN.read(spark, root).select(F.lit("now").alias("state"), F.col("source_id").cast("string")))
    return both.groupBy("state", "source_id").agg(F.count("*").alias("n"))


@query("snk05_upsert_fact", _UPSERTED)
def snk05(spark, sf):
    rows, root = curated(spark, sf), scratch_path(spark, "fact")
    SN.replace(spark, root, _before(rows, 45))
    SN.merge(spark, root, _amended(rows), at(SECOND_RUN))
    return SN.read(spark, root).select("crash_id", "severity", "batch_id", "ingested_at_utc")


@query("snk06_dim_date_fill", """
SELECT date_key, year, month, day, day_of_week, is_weekend FROM dim_date
WHERE date_key NOT IN (SELECT crash_date_key FROM curated WHERE source_id = 'chicago_us')""")
def snk06(spark, sf):
    have = PB.dim_date_rows(curated(spark, sf, "chicago_us"))
    return PB.missing_dates(curated(spark, sf), have)


@query("snk07_dim_source_seed", """
SELECT s.source_id, s.source_local_timezone, s.city, s.country, count(c.crash_id) AS crashes FROM dim_source s LEFT JOIN curated c USING (source_id) GROUP BY ALL""")
def snk07(spark, sf):
    counted = curated(spark, sf).groupBy("source_id").agg(F.count("*").alias("crashes"))
    return (PB.dim_source(spark).select("source_id", "source_local_timezone", "city", "country")
            .join(counted, "source_id", "left").na.fill(0, ["crashes"]))


@query("snk08_load_scoped", f"SELECT {', '.join(FACT_COLUMNS)} FROM curated WHERE source_id = 'nyc_us'")
def snk08(spark, sf):
    root, dates = scratch_path(spark, "fact"), scratch_path(spark, "dim_date")
    PB.load(spark, L.published(spark, sf), root, dates, "nyc_us")
    return SN.read(spark, root).withColumn("source_id", F.col("source_id").cast("string")).select(*FACT_COLUMNS)


@query("snk09_dq_log_append", "SELECT * FROM dq_log WHERE check_name <> 'source_freshness'")
def snk09(spark, sf):
    root = scratch_path(spark, "dq_run_log")
    results = check_results(spark, sf)
    append_log(results, root, at(FIRST_RUN))
    append_log(results.where("source_id <> 'nyc_us'"), root, at(SECOND_RUN))
    return spark.read.parquet(root)


@query("snk10_quality_report", """
SELECT coalesce(source_id, 'all sources') AS source, batch_id, check_name, upper(status) AS status, rows_checked, rows_failed,
  left(replace(replace(details, '|', '\\|'), chr(10), ' '), 200) AS details, run_timestamp
FROM dq_log WHERE run_timestamp >= TIMESTAMP '2026-01-05 07:00:00'""")
def snk10(spark, sf):
    return R.report_cells(check_log(spark, sf), at(FIRST_RUN))


@query("snk10_quality_counts", """
SELECT count(*) AS checks_run, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'warn') AS warned,
  count(*) FILTER (WHERE status = 'fail') AS failed, count(DISTINCT source_id) AS sources FROM dq_log""")
def snk10b(spark, sf):
    return R.report_counts(check_log(spark, sf), at("2026-01-01 00:00:00"))


@query("snk11_multi_format_roundtrip", " UNION ALL ".join(
    f"SELECT '{f}' AS format, crash_id, crash_timestamp_utc, latitude, severity, num_injured_total, hit_and_run FROM curated WHERE source_id = 'chicago_us' "
    "AND crash_date_key >= DATE '2024-03-01' AND crash_date_key < DATE '2024-04-01'" for f in FM.FORMATS))
def snk11(spark, sf):
    part = month_slice(spark.read.parquet(L.published(spark, sf)), "chicago_us", "2024-03-01", "2024-04-01").drop("source_id", "year", "month")
    out = None
    for name, rows in FM.round_trip(part, scratch_path(spark, "formats")).items():
        rows = rows.select(F.lit(name).alias("format"), "crash_id", "crash_timestamp_utc", "latitude", "severity",
                           "num_injured_total", "hit_and_run")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("snk12_profile_json", """
SELECT CAST(year(strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p')) AS INTEGER) AS year, count(*) AS n_rows FROM raw_a GROUP BY 1""")
def snk12(spark, sf):
    root, out = scratch_path(spark, "profiled"), scratch_path(spark, "profile")
    raw_orders(spark, sf).write.parquet(root)
    P.write_report(spark.read.parquet(root), out)
    rows = P.read_report(spark, out).where("section = 'yearly_coverage'")
    return rows.select(F.col("entry").cast("int").alias("year"), F.col("number").cast("long").alias("n_rows"))


@query("snk13_harmonize", """
SELECT crash_id, source_id, crash_timestamp_utc, police_notified_timestamp_utc, latitude, longitude, has_valid_coordinates, severity,
  num_injured_total, posted_speed_limit_mph, hit_and_run, crash_date_key, year, month FROM curated""")
def snk13(spark, sf):
    return L.candidate(spark, sf).rows(spark).withColumn("source_id", F.col("source_id").cast("string")).select(
        "crash_id", "source_id", "crash_timestamp_utc", "police_notified_timestamp_utc", "latitude", "longitude",
        "has_valid_coordinates", "severity", "num_injured_total", "posted_speed_limit_mph", "hit_and_run",
        "crash_date_key", "year", "month")


@query("snk13_fourth_source", """
SELECT source_record_id, crash_timestamp_utc - INTERVAL 330 MINUTE AS crash_timestamp_utc FROM parsed
WHERE source_id = 'uk_stats19' AND crash_timestamp_utc IS NOT NULL""")
def snk13b(spark, sf):
    """A source the library does not ship: its adapter is an argument."""
    adapter = replace(UK, source_id="roads_in", timezone="Asia/Kolkata")
    path = write_staged(staged(spark, sf, "uk_stats19").withColumn("source_id", F.lit("roads_in")), scratch_path(spark, "staged-in"))
    made = harmonize(spark, {"roads_in": path}, {"roads_in": "roads_in_b1"}, scratch_path(spark, "candidate-in"), {"roads_in": adapter})
    return made.rows(spark).select("source_record_id", "crash_timestamp_utc")


@query("snk05_upsert_all_sources", """
SELECT crash_id, CASE WHEN crash_date_key >= m - 90 THEN 'unknown' ELSE severity END AS severity
FROM curated JOIN (SELECT source_id, max(crash_date_key) AS m FROM curated GROUP BY 1) USING (source_id)""")
def snk05b(spark, sf):
    """A merge for each of the three sources, into a table that lacks their newest 45 days."""
    rows, root = curated(spark, sf), scratch_path(spark, "fact")
    SN.replace(spark, root, _before(rows, 45))
    for source in L.BATCHES:
        SN.merge(spark, root, _amended(curated(spark, sf, source)), at(SECOND_RUN))
    return SN.read(spark, root).select("crash_id", "severity")


@query("snk08_load_again", f"SELECT {', '.join(FACT_COLUMNS)} FROM curated")
def snk08b(spark, sf):
    """All sources into a fact table that already holds one of them."""
    root, dates = scratch_path(spark, "fact"), scratch_path(spark, "dim_date")
    for source in ("nyc_us", None):
        PB.load(spark, L.published(spark, sf), root, dates, source)
    return SN.read(spark, root).withColumn("source_id", F.col("source_id").cast("string")).select(*FACT_COLUMNS)


# -- joins of the merge, incremental batches -----------------------------------------

@query("joi12_upsert_match", """
SELECT source_id, count(*) AS matched FROM curated JOIN (SELECT source_id, max(crash_date_key) AS m FROM curated GROUP BY 1) USING (source_id)
WHERE crash_date_key BETWEEN m - 90 AND m - 45 GROUP BY 1""")
def joi12(spark, sf):
    rows = curated(spark, sf)
    return (_before(rows, 45).select(*NATURAL_KEY).join(_amended(rows).select(*NATURAL_KEY), NATURAL_KEY, "left_semi")
            .groupBy("source_id").agg(F.count("*").alias("matched")))


@query("inc01_trailing_amendments", _UPSERTED)
def inc01(spark, sf):
    rows = curated(spark, sf)
    return apply_amendments(_before(rows, 45), _revised(rows), "crash_date_key", at(SECOND_RUN), by=["source_id"]).select(
        "crash_id", "severity", "batch_id", "ingested_at_utc")


@query("inc02_idempotent_rerun", _UPSERTED)
def inc02(spark, sf):
    rows, root = curated(spark, sf), scratch_path(spark, "fact")
    SN.replace(spark, root, _before(rows, 45))
    pulled = saved(_amended(rows), "pulled")
    for _ in range(2):
        SN.merge(spark, root, pulled, at(SECOND_RUN))
    return SN.read(spark, root).select("crash_id", "severity", "batch_id", "ingested_at_utc")


@query("inc03_freshness", "SELECT source_id, status, details FROM freshness")
def inc03(spark, sf):
    return freshness_results(spark, sf).select("source_id", "status", "details")
