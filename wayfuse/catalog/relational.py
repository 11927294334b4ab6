"""Queries of the filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.catalog.registry import query
from wayfuse.catalog.sql_base import pct
from wayfuse.functions.scalars import count_if, percent
from wayfuse.operators import frames as FR
from wayfuse.operators import profile as P
from wayfuse.operators.checks import duplicate_counts
from wayfuse.operators.curate import exclusion_counts
from wayfuse.operators.hotspots import sampled, sampled_rows
from wayfuse.operators.publish import dim_date_rows, dim_source
from wayfuse.plans import analytics as A
from wayfuse.plans.bindings import raw_events, raw_lineitem, raw_orders, staged, table
from wayfuse.plans.landing import fact
from wayfuse.sources.text import latest_per_key


def D(text):
    return F.lit(text).cast("date")


# -- filters -------------------------------------------------------------------

@query("flt01_equality_in", """
SELECT crash_id, severity, city FROM curated WHERE source_id = 'chicago_us' AND severity IN ('fatal', 'serious')""")
def flt01(spark, sf):
    return fact(spark, sf).where((F.col("source_id") == "chicago_us")
                                    & F.col("severity").isin("fatal", "serious")).select("crash_id", "severity", "city")


@query("flt02_bounding_box", """
SELECT crash_id, latitude, longitude FROM curated WHERE has_valid_coordinates
  AND latitude BETWEEN 41.870 AND 41.890 AND longitude BETWEEN -87.640 AND -87.620""")
def flt02(spark, sf):
    return fact(spark, sf).where(A.in_box(A.DOWNTOWN)).select("crash_id", "latitude", "longitude")


@query("flt03_local_date_between", """
SELECT crash_id, local_date FROM localised WHERE local_date BETWEEN DATE '2021-01-01' AND DATE '2021-03-31'""")
def flt03(spark, sf):
    return FR.add_local_time(fact(spark, sf)).where(
        F.col("local_date").between(D("2021-01-01"), D("2021-03-31"))).select("crash_id", "local_date")


@query("flt04_half_open_range", """
SELECT crash_id, crash_date_key FROM curated WHERE crash_date_key >= DATE '2020-03-01' AND crash_date_key < DATE '2020-04-01'""")
def flt04(spark, sf):
    return fact(spark, sf).where((F.col("crash_date_key") >= D("2020-03-01"))
                                    & (F.col("crash_date_key") < D("2020-04-01"))).select("crash_id", "crash_date_key")


@query("flt05_having", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def flt05(spark, sf):
    return A.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("flt06_null_safe_mask", """
SELECT CRASH_RECORD_ID, MOST_SEVERE_INJURY FROM raw_a
WHERE MOST_SEVERE_INJURY IS NOT NULL AND MOST_SEVERE_INJURY NOT IN ('FATAL', 'NO INDICATION OF INJURY')""")
def flt06(spark, sf):
    c = F.col("MOST_SEVERE_INJURY")
    return raw_orders(spark, sf).where(c.isNotNull() & ~c.isin("FATAL", "NO INDICATION OF INJURY")) \
        .select("CRASH_RECORD_ID", c)


@query("flt07_comparable_rows", "SELECT crash_id, city_area, severity, local_date FROM comparable")
def flt07(spark, sf):
    return FR.comparable(fact(spark, sf)).select("crash_id", "city_area", "severity", "local_date")


@query("flt08_in_frame", "SELECT frame, crash_id, city_area, local_date FROM in_frames")
def flt08(spark, sf):
    rows = FR.comparable(fact(spark, sf))
    return FR.in_frames(spark, rows, FR.build_frames(spark, rows)).select("frame", "crash_id", "city_area", "local_date")


@query("flt09_filtered_aggregate", """
SELECT source_id, count(*) FILTER (WHERE severity = 'fatal') AS fatal, count(*) FILTER (WHERE hit_and_run) AS hit_and_run,
  count(*) AS n FROM curated GROUP BY source_id""")
def flt09(spark, sf):
    return fact(spark, sf).groupBy("source_id").agg(
        count_if(F.col("severity") == "fatal").alias("fatal"), count_if(F.col("hit_and_run")).alias("hit_and_run"),
        F.count("*").alias("n"))


@query("flt10_recency", """
SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""")
def flt10(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    newest = rows.agg(F.max("ts").alias("newest"))
    return rows.join(F.broadcast(newest)).where(
        F.col("ts") >= F.col("newest") - F.expr("INTERVAL 24 HOURS")).drop("newest")


# -- joins ---------------------------------------------------------------------

@query("joi01_fact_dim_date", """
SELECT d.year, d.is_weekend, count(*) AS crashes FROM curated f JOIN dim_date d ON d.date_key = f.crash_date_key GROUP BY ALL""")
def joi01(spark, sf):
    rows = fact(spark, sf)
    by_day = rows.groupBy(F.col("crash_date_key").alias("date_key")).agg(F.count("*").alias("n"))
    return (by_day.join(dim_date_rows(rows), "date_key").groupBy("year", "is_weekend")
            .agg(F.sum("n").alias("crashes")))


@query("joi02_fact_dim_source", """
SELECT f.crash_id, s.source_local_timezone, s.country FROM curated f JOIN dim_source s USING (source_id)""")
def joi02(spark, sf):
    dim = dim_source(spark).select("source_id", "source_local_timezone", "country")
    return (fact(spark, sf).select("crash_id", "source_id").join(F.broadcast(dim), "source_id")
            .drop("source_id"))


@query("joi03_values_table", """
SELECT f.city, p.residents, count(*) AS crashes FROM curated f
JOIN (VALUES ('Chicago', 2746388), ('London', 8799800)) p(city, residents) USING (city) GROUP BY ALL""")
def joi03(spark, sf):
    p = spark.createDataFrame([("Chicago", 2746388), ("London", 8799800)], "city string, residents int")
    counted = fact(spark, sf).groupBy("city").agg(F.count("*").alias("crashes"))
    return counted.join(F.broadcast(p), "city")


@query("joi04_one_row_scalar", f"""
SELECT source_id, n, {pct('n', 'total', 2)} AS pct FROM (SELECT source_id, count(*) AS n FROM curated GROUP BY ALL)
CROSS JOIN (SELECT count(*) AS total FROM curated)""")
def joi04(spark, sf):
    counted = fact(spark, sf).groupBy("source_id").agg(F.count("*").alias("n"))
    return A.share_of_all(counted, "n", "pct")


@query("joi05_left_outer", """
SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def joi05(spark, sf):
    per = (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.count("*").alias("orders")))
    return (table(spark, sf, "customer").select("c_custkey").join(per, "c_custkey", "left")
            .na.fill(0, ["orders"]))


@query("joi06_anti", """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def joi06(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").join(
        table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("joi07_key_difference", """
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def joi07(spark, sf):
    return (table(spark, sf, "lineitem").select("l_orderkey")
            .join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti")
            .distinct())


@query("joi08_interval_intersection", """
SELECT max(first) AS "start", min(last) AS "end" FROM
 (SELECT source_id, min(crash_date_key) AS first, max(crash_date_key) AS last FROM curated
  WHERE source_id IN ('chicago_us', 'uk_stats19') GROUP BY ALL) HAVING count(*) = 2 AND max(first) <= min(last)""")
def joi08(spark, sf):
    spans = fact(spark, sf, "chicago_us", "uk_stats19").groupBy("source_id").agg(
        F.min("crash_date_key").alias("first"), F.max("crash_date_key").alias("last"))
    return (spans.agg(F.max("first").alias("start"), F.min("last").alias("end"), F.count("*").alias("n"))
            .where((F.col("n") == 2) & (F.col("start") <= F.col("end"))).drop("n"))


@query("joi09_range_join", """
SELECT frame, city_area, count(*) AS n, min(local_date) AS first, max(local_date) AS last FROM in_frames GROUP BY ALL""")
def joi09(spark, sf):
    rows = FR.comparable(fact(spark, sf))
    return (FR.in_frames(spark, rows, FR.build_frames(spark, rows)).groupBy("frame", "city_area")
            .agg(F.count("*").alias("n"), F.min("local_date").alias("first"), F.max("local_date").alias("last")))


@query("joi11_map_join", """
SELECT c.crash_id, c.city_area, f.residents, f.area_km2 FROM comparable c JOIN city_facts f USING (city_area)""")
def joi11(spark, sf):
    rows = FR.comparable(fact(spark, sf)).select("crash_id", "city_area")
    return rows.join(F.broadcast(FR.city_facts(spark)), "city_area")


# -- aggregations ----------------------------------------------------------------

@query("agg01_count_distinct_min_max", """
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_orderdate) AS first, max(o_orderdate) AS last
FROM orders GROUP BY o_orderstatus""")
def agg01(spark, sf):
    # Distinct pairs first: a status holding a third of all rows is counted by many tasks.
    pairs = table(spark, sf, "orders").groupBy("o_orderstatus", "o_custkey").agg(
        F.count("*").alias("n"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return pairs.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n"), F.count("o_custkey").alias("customers"),
        F.min("first").cast("timestamp").alias("first"), F.max("last").cast("timestamp").alias("last"))


@query("agg02_duplicate_groups", """
SELECT source_id, source_record_id, count(*) AS copies FROM curated GROUP BY ALL HAVING count(*) > 1""")
def agg02(spark, sf):
    return A.duplicate_keys(fact(spark, sf), ["source_id", "source_record_id"])


@query("agg03_pivot_counts", """
SELECT year, count(*) FILTER (WHERE source_id = 'chicago_us') AS chicago_us, count(*) FILTER (WHERE source_id = 'nyc_us') AS nyc_us,
  count(*) FILTER (WHERE source_id = 'uk_stats19') AS uk_stats19 FROM curated GROUP BY year""")
def agg03(spark, sf):
    return (fact(spark, sf).groupBy("year").pivot("source_id", ["chicago_us", "nyc_us", "uk_stats19"])
            .agg(F.count(F.lit(1))).na.fill(0))


@query("agg04_group_by_expression", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) AS INTEGER) AS isodow, count(*) AS n FROM events GROUP BY ALL""")
def agg04(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return (table(spark, sf, "events").groupBy(F.hour(ts).alias("hour"), (F.weekday(ts) + 1).alias("isodow"))
            .agg(F.count("*").alias("n")))


@query("agg05_share_of_group", f"""
SELECT l_returnflag, l_linestatus, n, {pct('n', 'total', 2)} AS pct
FROM (SELECT *, sum(n) OVER (PARTITION BY l_returnflag) AS total
      FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL))""")
def agg05(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return A.share_of(counted, ["l_returnflag"], "n", "pct")


@query("agg06_boolean_mean", f"""
SELECT source_id, {pct('count(*) FILTER (WHERE hit_and_run)', 'count(*)', 2)} AS pct FROM curated GROUP BY source_id""")
def agg06(spark, sf):
    return (fact(spark, sf).groupBy("source_id").agg(count_if(F.col("hit_and_run")).alias("_y"), F.count("*").alias("_n"))
            .select("source_id", percent(F.col("_y"), F.col("_n"), 2).alias("pct")))


@query("agg07_conditional_ratio", f"""
SELECT event_type, count(*) AS n, {pct('count(*) FILTER (WHERE value > 10)', 'count(*)', 3)} AS pct_large FROM events GROUP BY event_type""")
def agg07(spark, sf):
    return (table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), count_if(F.col("value") > 10).alias("_b"))
            .select("event_type", "n", percent(F.col("_b"), F.col("n"), 3).alias("pct_large")))


_RATES = """
SELECT frame, city_area, CAST("start" AS VARCHAR) || ' to ' || CAST("end" AS VARCHAR) || ' (' || days || ' days)' AS "window",
  injury_crashes, fatal_crashes, residents,
  round(injury_crashes / (days / 365.25::DOUBLE) / residents * 100000, 3) AS injury_per_100k_per_year,
  round(fatal_crashes / (days / 365.25::DOUBLE) / residents * 100000, 3) AS fatal_per_100k_per_year,
  CASE WHEN injury_crashes > 0 THEN round(fatal_crashes * 100.0::DOUBLE / injury_crashes, 3) END AS fatal_share_of_injury_pct
FROM (SELECT f.frame, fc.city_area, f."start", f."end", f.days, cf.residents::BIGINT AS residents,
        count(r.crash_id) AS injury_crashes, count(r.crash_id) FILTER (WHERE r.severity = 'fatal') AS fatal_crashes
      FROM frames f JOIN frame_cities fc USING (frame) JOIN city_facts cf USING (city_area)
      LEFT JOIN in_frames r ON r.frame = f.frame AND r.city_area = fc.city_area
      WHERE f.days > 0 GROUP BY ALL)"""


@query("agg08_rates_per_100k", _RATES)
def agg08(spark, sf):
    rows = FR.comparable(fact(spark, sf))
    return FR.rates(spark, rows, FR.build_frames(spark, rows))


@query("agg09_crosstab_by_column", f"""
SELECT hour, {', '.join(f"coalesce({pct(f'sum(n) FILTER (WHERE event_type = {chr(39)}{t}{chr(39)})', f'max(t_{t})', 4)}, 0.0) AS {t}"
                        for t in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM (SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL)
CROSS JOIN (SELECT {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS t_{t}"
                              for t in ('click', 'error', 'purchase', 'signup', 'view'))} FROM events)
GROUP BY hour""")
def agg09(spark, sf):
    kinds = ["click", "error", "purchase", "signup", "view"]
    hour = F.hour(F.col("ts").cast("timestamp"))
    counted = (table(spark, sf, "events").groupBy(hour.alias("hour")).pivot("event_type", kinds)
               .agg(F.count(F.lit(1))).na.fill(0))
    totals = counted.agg(*[F.sum(k).alias(f"_t_{k}") for k in kinds])
    return counted.join(F.broadcast(totals)).select("hour", *[
        F.coalesce(percent(F.col(k), F.col(f"_t_{k}"), 4), F.lit(0.0)).alias(k) for k in kinds])


@query("agg10_crosstab_by_row", f"""
SELECT o_orderpriority, {', '.join(f"{pct(f'count(*) FILTER (WHERE o_orderstatus = {chr(39)}{s}{chr(39)})', 'count(*)', 2)} AS {s}" for s in 'FOP')}
FROM orders GROUP BY o_orderpriority""")
def agg10(spark, sf):
    counted = (table(spark, sf, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", list("FOP"))
               .agg(F.count(F.lit(1))).na.fill(0))
    n = F.col("F") + F.col("O") + F.col("P")
    return counted.select("o_orderpriority", *[percent(F.col(s), n, 2).alias(s) for s in "FOP"])


@query("agg11_coverage", """
SELECT city_area, min(local_date) AS first, max(local_date) AS last, count(*) AS injury_crashes FROM comparable GROUP BY city_area""")
def agg11(spark, sf):
    return FR.coverage(FR.comparable(fact(spark, sf)))


@query("agg12_weekend_share", f"""
SELECT city_area, {pct('count(*) FILTER (WHERE is_weekend)', 'count(*)', 1)} AS pct_weekend FROM comparable GROUP BY city_area""")
def agg12(spark, sf):
    return (FR.comparable(fact(spark, sf)).groupBy("city_area")
            .agg(count_if(F.col("is_weekend")).alias("_w"), F.count("*").alias("_n"))
            .select("city_area", percent(F.col("_w"), F.col("_n"), 1).alias("pct_weekend")))


@query("agg13_funnel_counts", """
SELECT event_type, count(*) AS all_rows, count(*) FILTER (WHERE value > 5) AS over_5, count(*) FILTER (WHERE value > 5 AND user_id % 2 = 0) AS over_5_even
FROM events GROUP BY event_type""")
def agg13(spark, sf):
    big = F.col("value") > 5
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("all_rows"), count_if(big).alias("over_5"),
        count_if(big & (F.col("user_id") % 2 == 0)).alias("over_5_even"))


@query("agg14_mode", """
SELECT event_type, hour AS peak_hour FROM (
  SELECT event_type, hour, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, hour) AS r
  FROM (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY ALL)) WHERE r = 1""")
def agg14(spark, sf):
    hour = F.hour(F.col("ts").cast("timestamp"))
    counted = table(spark, sf, "events").groupBy("event_type", hour.alias("hour")).agg(F.count("*").alias("n"))
    return counted.groupBy("event_type").agg(
        F.max_by("hour", F.struct("n", -F.col("hour"))).alias("peak_hour"))


@query("agg15_centroids", f"""
SELECT primary_cause, count(*) AS size, round(avg(latitude), 5) AS centroid_lat, round(avg(longitude), 5) AS centroid_lon,
  {pct("count(*) FILTER (WHERE severity = 'fatal')", "count(*)", 2)} AS pct_fatal
FROM curated WHERE source_id = 'chicago_us' AND has_valid_coordinates GROUP BY primary_cause""")
def agg15(spark, sf):
    return (fact(spark, sf, "chicago_us").where("has_valid_coordinates").groupBy("primary_cause")
            .agg(F.count("*").alias("size"), F.round(F.avg("latitude"), 5).alias("centroid_lat"),
                 F.round(F.avg("longitude"), 5).alias("centroid_lon"),
                 count_if(F.col("severity") == "fatal").alias("_f"))
            .withColumn("pct_fatal", percent(F.col("_f"), F.col("size"), 2)).drop("_f"))


@query("agg16_top_n_share", f"""
SELECT {pct('sum(n) FILTER (WHERE r <= 10)', 'sum(n)', 1)} AS pct_in_top10
FROM (SELECT n, row_number() OVER (ORDER BY n DESC, o_custkey) AS r FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL))""")
def agg16(spark, sf):
    sizes = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "o_custkey").limit(10).agg(F.sum("n").alias("top"))
    whole = sizes.agg(F.sum("n").alias("total"))
    return whole.join(F.broadcast(top)).select(percent(F.col("top"), F.col("total"), 1).alias("pct_in_top10"))


_A_COLUMNS = ["CRASH_RECORD_ID", "CRASH_DATE", "DATE_POLICE_NOTIFIED", "MOST_SEVERE_INJURY", "INJURIES_TOTAL",
              "INJURIES_FATAL", "NUM_UNITS", "LATITUDE", "LONGITUDE", "POSTED_SPEED_LIMIT", "FIRST_CRASH_TYPE",
              "PRIM_CONTRIBUTORY_CAUSE", "WEATHER_CONDITION", "LIGHTING_CONDITION", "HIT_AND_RUN_I", "BEAT_OF_OCCURRENCE"]
NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'yes_only_flag' if c in P.YES_ONLY else 'ordinary'}' AS kind, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)', 2)} AS pct_null FROM raw_a"
    for c in _A_COLUMNS)


@query("agg17_null_percent", NULLS_SQL)
def agg17(spark, sf):
    return P.missingness_report(raw_orders(spark, sf))


@query("agg18_extra_duplicates", """
SELECT (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))::BIGINT AS dup_key,
  (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber))::BIGINT AS dup_full""")
def agg18(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("_all", F.lit(1))
    return duplicate_counts(rows, ["_all"], {
        "dup_key": ["l_orderkey", "l_linenumber"],
        "dup_full": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]}).drop("_all")


@query("agg19_full_row_duplicates", """
SELECT coalesce(sum(n - 1), 0)::BIGINT AS extra_rows FROM (SELECT count(*) AS n FROM
  (SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events) GROUP BY user_id, event_type, day)""")
def agg19(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", F.to_date(F.col("ts").cast("timestamp")).alias("day"))
    return P.extra_copies(rows, rows.columns)


@query("agg20_value_counts", """
SELECT vehicle_type_code2 AS value, count(*) AS n FROM raw_b GROUP BY ALL""")
def agg20(spark, sf):
    return (raw_events(spark, sf).groupBy(F.col("vehicle_type_code2").alias("value")).agg(F.count("*").alias("n")))


@query("agg21_sum_prefixed", """
SELECT 'INJURIES_TOTAL' AS measure, sum(CAST(INJURIES_TOTAL AS DOUBLE)) AS value FROM raw_a
UNION ALL SELECT 'INJURIES_FATAL', sum(CAST(INJURIES_FATAL AS DOUBLE)) FROM raw_a""")
def agg21(spark, sf):
    return P.injury_report(raw_orders(spark, sf)).where(F.col("measure").startswith("INJURIES_"))


_DISTRICTS = """
SELECT CAST(CAST(BEAT_OF_OCCURRENCE AS INTEGER) // 100 AS INTEGER) AS district, min(t) AS first_date,
  min(t) < TIMESTAMP '{cutoff}' AS before_cutoff
FROM (SELECT *, strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p') AS t FROM raw_a) GROUP BY 1"""


@query("agg22_first_date_per_group", _DISTRICTS.format(cutoff="2018-01-02 00:00:00"))
def agg22(spark, sf):
    return P.district_coverage(raw_orders(spark, sf), "2018-01-02")


@query("agg23_min_max_gap", """
SELECT min(TRY_CAST(LATITUDE AS DOUBLE)) FILTER (WHERE LATITUDE <> '0') AS min_lat, max(TRY_CAST(LATITUDE AS DOUBLE)) FILTER (WHERE LATITUDE <> '0') AS max_lat,
  max(epoch_us(strptime(DATE_POLICE_NOTIFIED, '%m/%d/%Y %I:%M:%S %p')) - epoch_us(strptime(CRASH_DATE, '%m/%d/%Y %I:%M:%S %p'))) / 86400000000.0::DOUBLE AS max_gap_days
FROM raw_a""")
def agg23(spark, sf):
    rows = raw_orders(spark, sf)
    valid = P.coordinate_report(rows).select("min_lat", "max_lat")
    return valid.join(F.broadcast(P.date_logic(rows).select("max_gap_days")))


@query("agg24_reconciliation", """
SELECT source_id, s.n AS staged_rows, c.n AS curated_rows FROM (SELECT source_id, count(*) AS n FROM staged GROUP BY ALL) s
LEFT JOIN (SELECT source_id, count(*) AS n FROM curated GROUP BY ALL) c USING (source_id)""")
def agg24(spark, sf):
    return exclusion_counts(staged(spark, sf)).drop("excluded_rows")


# -- windows, sorts, top-k, sets ---------------------------------------------------

@query("win01_share_of_partition", f"""
SELECT event_type, user_id, n, {pct('n', 'total', 2)} AS pct FROM (SELECT *, sum(n) OVER (PARTITION BY event_type) AS total
  FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL))""")
def win01(spark, sf):
    counted = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    # The total comes from its own aggregation: a type may hold a third of all users.
    total = counted.groupBy("event_type").agg(F.sum("n").alias("_total"))
    return (counted.join(total, "event_type")
            .select("event_type", "user_id", "n", percent(F.col("n"), F.col("_total"), 2).alias("pct")))


@query("win02_share_of_grand_total", f"""
SELECT p_brand, n, {pct('n', 'total', 2)} AS pct FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY ALL)
CROSS JOIN (SELECT count(*) AS total FROM part)""")
def win02(spark, sf):
    return A.share_of_all(table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n")), "n", "pct")


@query("win03_rolling_mean", """
SELECT month, n, round(avg(n) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling_mean
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY ALL)""")
def win03(spark, sf):
    monthly = (table(spark, sf, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("timestamp"), "month").alias("month"))
               .agg(F.count("*").alias("n")))
    w = W.orderBy("month").rowsBetween(-2, 0)  # one row per month
    return monthly.withColumn("rolling_mean", F.round(F.avg("n").over(w), 4))


@query("win04_latest_per_key", """
SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1""")
def win04(spark, sf):
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return latest_per_key(rows, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]) \
        .select("user_id", "event_type", "event_id", "ts")


@query("win05_duplicate_ordinal", """
SELECT l_linenumber, count(*) - count(DISTINCT l_orderkey) AS repeated FROM lineitem GROUP BY l_linenumber""")
def win05(spark, sf):
    keys = table(spark, sf, "lineitem").groupBy("l_linenumber", "l_orderkey").agg(F.count("*").alias("n"))
    return keys.groupBy("l_linenumber").agg(F.sum(F.col("n") - 1).alias("repeated"))


@query("srt01_order_nulls_last", """
SELECT city, severity, count(*) AS n FROM curated GROUP BY ALL ORDER BY city NULLS LAST, n DESC""")
def srt01(spark, sf):
    return (fact(spark, sf).groupBy("city", "severity").agg(F.count("*").alias("n"))
            .orderBy(F.col("city").asc_nulls_last(), F.desc("n")))


@query("srt02_custom_order", """
SELECT severity, list_position(['fatal', 'serious', 'minor', 'none', 'unknown'], severity)::BIGINT AS position, count(*) AS n
FROM curated GROUP BY ALL ORDER BY position""")
def srt02(spark, sf):
    return (fact(spark, sf).groupBy("severity", A.severity_rank().cast("long").alias("position"))
            .agg(F.count("*").alias("n")).orderBy("position"))


@query("top01_order_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top01(spark, sf):
    return (table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25))


@query("top02_first_rows", """
SELECT crash_id, crash_timestamp_utc FROM curated WHERE source_id = 'chicago_us' ORDER BY crash_timestamp_utc, crash_id LIMIT 100""")
def top02(spark, sf):
    return (fact(spark, sf, "chicago_us").select("crash_id", "crash_timestamp_utc")
            .orderBy("crash_timestamp_utc", "crash_id").limit(100))


@query("top03_ingest_cap", """
SELECT collision_index, date FROM raw_c ORDER BY collision_index, date LIMIT 500""")
def top03(spark, sf):
    return raw_lineitem(spark, sf).select("collision_index", "date").orderBy("collision_index", "date").limit(500)


@query("smp01_hash_sample", """
SELECT crash_id, severity FROM curated WHERE CAST('0x' || substr(md5(crash_id || '/0'), 1, 8) AS BIGINT) < CAST(floor(0.8 * 4294967296) AS BIGINT)""")
def smp01(spark, sf):
    return sampled(fact(spark, sf), "crash_id", 0).select("crash_id", "severity")


@query("smp01_row_sample", """
SELECT source_id, crash_id, severity FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY md5(crash_id || '/1'), crash_id) AS r FROM curated)
WHERE r <= 6000""")
def smp01b(spark, sf):
    return sampled_rows(fact(spark, sf), "crash_id", 1, 6000, ["source_id"]).select("source_id", "crash_id", "severity")


@query("smp01_row_sample_of_all", """
SELECT crash_id, severity FROM curated ORDER BY md5(crash_id || '/2'), crash_id LIMIT 9000""")
def smp01c(spark, sf):
    return sampled_rows(fact(spark, sf), "crash_id", 2, 9000).select("crash_id", "severity")


@query("set01_union_all", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""")
def set01(spark, sf):
    def of(kind, p):
        return table(spark, sf, kind).select(F.lit(kind).alias("kind"), F.col(f"{p}key").alias("id"),
                                             F.col(f"{p[0]}_name").alias("name"), F.col(f"{p[0]}_acctbal").alias("balance"))
    return of("customer", "c_cust").unionByName(of("supplier", "s_supp"))


@query("set02_difference", """
SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier""")
def set02(spark, sf):
    return (table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")).distinct()
            .join(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey")), "nationkey", "left_anti"))


@query("set03_distinct", "SELECT DISTINCT crash_date_key FROM curated")
def set03(spark, sf):
    return fact(spark, sf).select("crash_date_key").distinct()


@query("set04_set_equality", """
SELECT count(*) FILTER (WHERE a.m IS NULL) AS only_right, count(*) FILTER (WHERE b.m IS NULL) AS only_left, count(*) AS months
FROM (SELECT DISTINCT year * 100 + month AS m FROM curated WHERE source_id = 'chicago_us') a
FULL JOIN (SELECT DISTINCT year * 100 + month AS m FROM curated WHERE source_id = 'uk_stats19') b ON a.m = b.m""")
def set04(spark, sf):
    def months(source):
        return fact(spark, sf, source).select((F.col("year") * 100 + F.col("month")).alias("m")).distinct()
    a = months("chicago_us").withColumn("l", F.lit(1))
    b = months("uk_stats19").withColumn("r", F.lit(1))
    return a.join(b, "m", "full").agg(count_if(F.col("l").isNull()).alias("only_right"),
                                      count_if(F.col("r").isNull()).alias("only_left"), F.count("*").alias("months"))
