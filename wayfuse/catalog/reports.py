"""Query set, exploration tables, frames, hotspots and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfuse.catalog.registry import query
from wayfuse.catalog.relational import _A_COLUMNS, _DISTRICTS, _RATES, NULLS_SQL
from wayfuse.catalog.sql_base import US_LAYOUT, pct
from wayfuse.operators import frames as FR
from wayfuse.operators import hotspots as H
from wayfuse.operators import profile as P
from wayfuse.operators.publish import dim_date_rows, dim_source
from wayfuse.plans import analytics as A
from wayfuse.plans import exploration as E
from wayfuse.plans.bindings import raw_orders
from wayfuse.plans.landing import fact, published
from wayfuse.plans.samples import check_log
from wayfuse.session import scratch_path
from wayfuse.spec import STABILITY_SEEDS

SOURCES = ["chicago_us", "nyc_us", "uk_stats19"]


# -- query set -------------------------------------------------------------------

@query("sql01_load_verification", """
SELECT source_id, count(*) AS crashes, count(DISTINCT batch_id) AS batches_loaded, min(crash_timestamp_utc) AS earliest_crash_utc,
  max(crash_timestamp_utc) AS latest_crash_utc FROM curated GROUP BY source_id""")
def sql01(spark, sf):
    return A.load_verification(fact(spark, sf))


@query("sql02_natural_key_duplicates", """
SELECT source_id, source_record_id, count(*) AS copies FROM curated GROUP BY ALL HAVING count(*) > 1""")
def sql02(spark, sf):
    return A.duplicate_keys(fact(spark, sf), ["source_id", "source_record_id"])


@query("sql03_per_year_by_source", """
SELECT d.year, count(*) FILTER (WHERE source_id = 'chicago_us') AS chicago_us, count(*) FILTER (WHERE source_id = 'nyc_us') AS nyc_us,
  count(*) FILTER (WHERE source_id = 'uk_stats19') AS uk_stats19 FROM curated f JOIN dim_date d ON d.date_key = f.crash_date_key GROUP BY d.year""")
def sql03(spark, sf):
    rows = fact(spark, sf)
    return A.per_year_by_source(rows, dim_date_rows(rows), SOURCES)


@query("sql04_local_hour_profile", f"""
SELECT source_id, local_hour, n AS crashes, {pct('n', 'total', 2)} AS pct_of_source
FROM (SELECT *, sum(n) OVER (PARTITION BY source_id) AS total FROM (SELECT source_id, local_hour, count(*) AS n FROM localised GROUP BY ALL))""")
def sql04(spark, sf):
    return A.local_hours(fact(spark, sf), dim_source(spark))


@query("sql05_local_weekday_profile", f"""
SELECT source_id, local_dow + 1 AS local_isodow, {pct('n', 'total', 2)} AS pct_of_source
FROM (SELECT *, sum(n) OVER (PARTITION BY source_id) AS total FROM (SELECT source_id, local_dow, count(*) AS n FROM localised GROUP BY ALL))""")
def sql05(spark, sf):
    return A.local_weekdays(fact(spark, sf), dim_source(spark))


@query("sql06_severity_mix", f"""
SELECT source_id, severity, n AS crashes, {pct('n', 'total', 2)} AS pct_of_source
FROM (SELECT *, sum(n) OVER (PARTITION BY source_id) AS total FROM (SELECT source_id, severity, count(*) AS n FROM curated GROUP BY ALL))""")
def sql06(spark, sf):
    return A.severity_mix(fact(spark, sf))


@query("sql07_fatal_share", f"""
SELECT city, count(*) AS injury_crashes, count(*) FILTER (WHERE severity = 'fatal') AS fatal_crashes,
  {pct("count(*) FILTER (WHERE severity = 'fatal')", "count(*)", 3)} AS pct_fatal FROM localised
WHERE severity IN ('fatal', 'serious', 'minor') AND city IN ('Chicago', 'London')
  AND local_date BETWEEN DATE '2021-01-01' AND DATE '2025-12-31' GROUP BY city""")
def sql07(spark, sf):
    return A.fatal_share(fact(spark, sf), dim_source(spark))


@query("sql08_top_causes", f"""
SELECT primary_cause, n AS fatal_or_serious_crashes, {pct('n', 'total', 2)} AS pct
FROM (SELECT primary_cause, n, sum(n) OVER () AS total FROM (SELECT primary_cause, count(*) AS n FROM curated
  WHERE source_id = 'chicago_us' AND severity IN ('fatal', 'serious') GROUP BY ALL))
ORDER BY n DESC, primary_cause LIMIT 10""")
def sql08(spark, sf):
    return A.top_causes(fact(spark, sf, "chicago_us"))


@query("sql09_monthly_trend", """
SELECT month, crashes, CAST((2 * s + c) // (2 * c) AS DOUBLE) AS rolling_3_month_avg
FROM (SELECT month, crashes, sum(crashes) OVER w AS s, count(*) OVER w AS c
  FROM (SELECT CAST(date_trunc('month', crash_date_key) AS DATE) AS month, count(*) AS crashes FROM curated
        WHERE source_id = 'chicago_us' AND crash_date_key >= DATE '2018-01-01' GROUP BY 1)
  WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""")
def sql09(spark, sf):
    return A.monthly_trend(fact(spark, sf, "chicago_us"))


@query("sql10a_coordinate_coverage", f"""
SELECT source_id, {pct('count(*) FILTER (WHERE has_valid_coordinates)', 'count(*)', 2)} AS pct_valid_coordinates FROM curated GROUP BY source_id""")
def sql10a(spark, sf):
    return A.coordinate_coverage(fact(spark, sf))


@query("sql10b_downtown_severity", """
SELECT severity, count(*) AS crashes FROM curated WHERE source_id = 'chicago_us' AND has_valid_coordinates
  AND latitude BETWEEN 41.870 AND 41.890 AND longitude BETWEEN -87.640 AND -87.620 GROUP BY severity""")
def sql10b(spark, sf):
    return A.downtown_severity(fact(spark, sf))


@query("sql11_month_slice", """
SELECT count(*) AS crashes FROM curated WHERE source_id = 'chicago_us' AND crash_date_key >= DATE '2024-03-01' AND crash_date_key < DATE '2024-04-01'""")
def sql11(spark, sf):
    return A.month_slice(spark.read.parquet(published(spark, sf)), "chicago_us", "2024-03-01", "2024-04-01").agg(
        F.count("*").alias("crashes"))


@query("sql12_trace_record", """
SELECT t.crash_id, t.source_record_id, t.crash_timestamp_utc, t.severity, t.batch_id,
  'data/raw/' || t.source_id || '/' || t.batch_id || '/manifest.json' AS raw_manifest_path, q.check_name, q.status, q.rows_failed
FROM (SELECT * FROM curated WHERE source_id = 'chicago_us' ORDER BY crash_id LIMIT 1) t LEFT JOIN dq_log q ON q.batch_id = t.batch_id""")
def sql12(spark, sf):
    return A.trace_record(fact(spark, sf), check_log(spark, sf))


@query("sql13_latest_check_results", """
SELECT source_id, check_name, status, rows_checked, rows_failed, CASE WHEN status <> 'pass' THEN left(details, 120) END AS details, run_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY source_id, check_name ORDER BY run_timestamp DESC) AS r FROM dq_log) WHERE r = 1""")
def sql13(spark, sf):
    return A.latest_check_results(check_log(spark, sf))


@query("sql14_injury_rates", """
SELECT city, n AS injury_crashes, round(n / (1826 / 365.25::DOUBLE) / residents * 100000, 1) AS injury_per_100k_per_year,
  round(f / (1826 / 365.25::DOUBLE) / residents * 100000, 2) AS fatal_per_100k_per_year
FROM (SELECT city, count(*) AS n, count(*) FILTER (WHERE severity = 'fatal') AS f FROM localised
  WHERE severity IN ('fatal', 'serious', 'minor') AND local_date BETWEEN DATE '2021-01-01' AND DATE '2025-12-31' GROUP BY city)
JOIN (VALUES ('Chicago', 2746388), ('London', 8799800)) p(city, residents) USING (city)""")
def sql14(spark, sf):
    return A.injury_rates(spark, fact(spark, sf), dim_source(spark))


@query("sql15_latest_freshness", """
SELECT source_id, status, TIMESTAMP '2026-01-05 06:30:00' AS run_timestamp, left(details, 160) AS details FROM freshness""")
def sql15(spark, sf):
    return A.latest_freshness(check_log(spark, sf))


@query("sql16_per_source_year", """
SELECT source_id, CAST(year(crash_date_key) AS INTEGER) AS year, count(*) AS crashes FROM curated GROUP BY ALL""")
def sql16(spark, sf):
    return A.per_source_year(fact(spark, sf))


@query("sql17_fatal_rate_mappable", f"""
SELECT source_id, count(*) FILTER (WHERE severity = 'fatal') AS fatal_count, count(*) AS total_count,
  {pct("count(*) FILTER (WHERE severity = 'fatal')", "count(*)", 3)} AS fatal_pct FROM curated WHERE has_valid_coordinates GROUP BY source_id""")
def sql17(spark, sf):
    return A.fatal_rate_mappable(fact(spark, sf))


@query("sql18_recent_failures", """
SELECT batch_id, source_id, check_name, rows_failed, run_timestamp FROM dq_log WHERE status = 'fail' ORDER BY run_timestamp DESC, source_id, check_name LIMIT 50""")
def sql18(spark, sf):
    return A.recent_failures(check_log(spark, sf))


@query("sql19_clusterable", """
SELECT crash_id, latitude, longitude, severity FROM curated WHERE source_id = 'chicago_us' AND has_valid_coordinates
  AND crash_date_key BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'""")
def sql19(spark, sf):
    return A.clusterable(fact(spark, sf), "chicago_us", 2024)


# -- exploration -------------------------------------------------------------------

def _comparable(spark, sf):
    rows = FR.comparable(fact(spark, sf))
    return rows, FR.build_frames(spark, rows)


@query("eda01_volume", """
SELECT local_year, count(*) FILTER (WHERE source_id = 'chicago_us') AS chicago_us, count(*) FILTER (WHERE source_id = 'nyc_us') AS nyc_us,
  count(*) FILTER (WHERE source_id = 'uk_stats19') AS uk_stats19 FROM localised GROUP BY local_year""")
def eda01(spark, sf):
    return E.volume(fact(spark, sf), SOURCES)


@query("eda02_funnel", """
SELECT source_id, count(*) AS all_rows, count(*) FILTER (WHERE ok) AS in_city_geography,
  count(*) FILTER (WHERE ok AND severity IN ('fatal', 'serious', 'minor')) AS injury_crashes_in_city
FROM (SELECT *, coalesce(city = CASE source_id WHEN 'chicago_us' THEN 'Chicago' WHEN 'nyc_us' THEN 'New York City' ELSE 'London' END, false) AS ok
      FROM curated) GROUP BY source_id""")
def eda02(spark, sf):
    return E.funnel(fact(spark, sf))


@query("eda03_coverage", """
SELECT city_area, min(local_date) AS first, max(local_date) AS last, count(*) AS injury_crashes FROM comparable GROUP BY city_area""")
def eda03(spark, sf):
    return FR.coverage(FR.comparable(fact(spark, sf)))


@query("eda04_frame_table", 'SELECT frame, cities, "start", "end", days FROM frames')
def eda04(spark, sf):
    return _comparable(spark, sf)[1].drop("frame_no")


@query("eda05_rate_table", _RATES)
def eda05(spark, sf):
    return FR.rates(spark, *_comparable(spark, sf))


def _shares(part, name, digits):
    return f"""SELECT frame, city_area, {name}, n AS crashes, {pct('n', 'total', digits)} AS pct
FROM (SELECT *, sum(n) OVER (PARTITION BY frame, city_area) AS total
      FROM (SELECT frame, city_area, {part} AS {name}, count(*) AS n FROM in_frames GROUP BY ALL))"""


@query("eda06_hour_shares", _shares("local_hour", "local_hour", 4))
def eda06(spark, sf):
    return E.hour_shares(spark, *_comparable(spark, sf))


@query("eda07_weekday_shares", _shares("['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][local_dow + 1]", "weekday", 1))
def eda07(spark, sf):
    return E.weekday_shares(spark, *_comparable(spark, sf))


@query("eda08_weekend_share", f"""
SELECT frame, city_area, {pct('count(*) FILTER (WHERE is_weekend)', 'count(*)', 1)} AS pct_weekend FROM in_frames GROUP BY ALL""")
def eda08(spark, sf):
    return E.weekend_share(spark, *_comparable(spark, sf))


def _one(severity):
    part = f"count(*) FILTER (WHERE severity = '{severity}')"
    return f"{pct(part, 'count(*)', 2)} AS {severity}"


@query("eda09_severity_shares", f"""
SELECT frame, city_area, {', '.join(_one(s) for s in ('fatal', 'serious', 'minor'))} FROM in_frames GROUP BY ALL""")
def eda09(spark, sf):
    return E.severity_shares(spark, *_comparable(spark, sf))


@query("eda10_valid_coordinates", f"""
SELECT source_id, {pct('count(*) FILTER (WHERE has_valid_coordinates)', 'count(*)', 2)} AS pct_valid_coordinates FROM curated GROUP BY source_id""")
def eda10(spark, sf):
    return E.coordinate_coverage(fact(spark, sf))


@query("eda11_latest_log", """
SELECT source_id, check_name, status, rows_checked, rows_failed, run_timestamp FROM dq_log
ORDER BY run_timestamp DESC, source_id, check_name LIMIT 40""")
def eda11(spark, sf):
    return E.latest_log(check_log(spark, sf))


# -- frames and hotspots -------------------------------------------------------------

@query("frm01_build_frames", 'SELECT frame, frame_no, cities, "start", "end", days FROM frames')
def frm01(spark, sf):
    return _comparable(spark, sf)[1]


_CLUSTER_FRAMES = """
cover AS (SELECT city_area, min(local_date) AS first, max(local_date) AS last FROM comparable WHERE has_valid_coordinates GROUP BY ALL),
spans AS (SELECT frame, frame_no, string_agg(city_area, ', ' ORDER BY city_area) AS cities, max(first) AS s, min(last) AS e
  FROM frame_cities LEFT JOIN cover USING (city_area) GROUP BY ALL HAVING count(*) = count(first) AND max(first) <= min(last)),
cframes AS (
  SELECT frame || ', ' || y AS frame, frame_no, cities, greatest(s, make_date(y, 1, 1)) AS "start", least(e, make_date(y, 12, 31)) AS "end"
  FROM (SELECT *, CASE WHEN strftime(e, '%m-%d') = '12-31' THEN year(e) ELSE year(e) - 1 END AS y FROM spans WHERE frame_no = 1) WHERE y >= year(s)
  UNION ALL SELECT frame || ', NYC window', frame_no, cities, s, e FROM spans WHERE frame_no = 2)"""


def _cluster_points(spark, sf):
    points = FR.comparable(fact(spark, sf)).where("has_valid_coordinates")
    return points, FR.cluster_frames(FR.build_frames(spark, points))


@query("frm02_cluster_frames", f"""
WITH {_CLUSTER_FRAMES} SELECT frame, frame_no, cities, "start", "end", CAST(date_diff('day', "start", "end") + 1 AS INTEGER) AS days FROM cframes""")
def frm02(spark, sf):
    return _cluster_points(spark, sf)[1]


_FRAME_POINTS = f"""{_CLUSTER_FRAMES},
points AS (SELECT f.frame, c.* FROM comparable c JOIN frame_cities fc USING (city_area) JOIN cframes f ON f.frame_no = fc.frame_no
  WHERE c.has_valid_coordinates AND c.local_date BETWEEN f."start" AND f."end")"""


@query("frm03_frame_points", f"WITH {_FRAME_POINTS} SELECT frame, city_area, crash_id, latitude, longitude FROM points")
def frm03(spark, sf):
    points, frames = _cluster_points(spark, sf)
    return H.frame_points(spark, points, frames).select("frame", "city_area", "crash_id", "latitude", "longitude")


_MOST_POINTS = 60_000  # rows of a frame and city, where a cap is wanted


@query("frm03_capped_points", f"""
WITH {_FRAME_POINTS} SELECT frame, city_area, crash_id, latitude, longitude FROM (
  SELECT *, row_number() OVER (PARTITION BY frame, city_area ORDER BY md5(crash_id || '/0'), crash_id) AS r FROM points) WHERE r <= {_MOST_POINTS}""")
def frm03b(spark, sf):
    points, frames = _cluster_points(spark, sf)
    return H.frame_points(spark, points, frames, most=_MOST_POINTS).select("frame", "city_area", "crash_id", "latitude", "longitude")


@query("hot01_density_threshold", f"""
WITH {_FRAME_POINTS} SELECT frame, city_area, count(*) AS injury_crashes,
  CAST(greatest(5, ceil(10.0::DOUBLE * (count(*) / max(area_km2)::DOUBLE * (pi() * 0.0225)))) AS INTEGER) AS min_samples
FROM points JOIN city_facts USING (city_area) GROUP BY ALL""")
def hot01(spark, sf):
    points, frames = _cluster_points(spark, sf)
    inside = H.frame_points(spark, points, frames)
    return H.with_min_samples(inside, ["frame", "city_area"]).groupBy("frame", "city_area").agg(
        F.count("*").alias("injury_crashes"), F.max("min_samples").alias("min_samples"))


def _dbscan(points: str) -> str:
    """CTEs from ``points`` (frame, city_area, crash_id, coordinates, severity, local_hour) to ``clustered``:
    sites, core sites, the closure of their links, numbers by first core point, lowest number for the rim."""
    return f"""
need AS (SELECT frame, city_area, CAST(greatest(5, ceil(10.0::DOUBLE * (count(*) / max(area_km2)::DOUBLE * (pi() * 0.0225)))) AS INTEGER) AS min_samples
  FROM {points} JOIN city_facts USING (city_area) GROUP BY ALL),
sites AS (SELECT frame, city_area, latitude, longitude, radians(latitude) AS la, radians(longitude) AS lo, floor(latitude / 0.0025) AS cy,
  floor(longitude / 0.005) AS cx, count(*) AS w, min(crash_id) AS first_id FROM {points} GROUP BY ALL),
around AS (SELECT dy, dx FROM range(-1, 2) a(dy), range(-1, 2) b(dx)),
near AS (SELECT p.frame, p.city_area, p.first_id AS a, q.first_id AS b, q.w FROM (SELECT * FROM sites, around) p
  JOIN sites q ON q.frame = p.frame AND q.city_area = p.city_area AND q.cy = p.cy + dy AND q.cx = p.cx + dx
  AND pow(sin((p.la - q.la) / 2), 2) + cos(p.la) * cos(q.la) * pow(sin((p.lo - q.lo) / 2), 2) <= pow(sin(150.0 / 6371000 / 2), 2)),
core AS (SELECT frame, city_area, a FROM near JOIN need USING (frame, city_area) GROUP BY frame, city_area, a, min_samples HAVING sum(w) >= min_samples),
linked AS (SELECT n.frame, n.city_area, n.a, n.b FROM near n JOIN core x ON (x.frame, x.city_area, x.a) = (n.frame, n.city_area, n.a)
  JOIN core y ON (y.frame, y.city_area, y.a) = (n.frame, n.city_area, n.b)),
reach AS (SELECT frame, city_area, a, a AS b FROM core UNION
  SELECT r.frame, r.city_area, r.a, l.b FROM reach r JOIN linked l ON (l.frame, l.city_area, l.a) = (r.frame, r.city_area, r.b)),
labels AS (SELECT frame, city_area, a, min(b) AS label FROM reach GROUP BY ALL),
numbers AS (SELECT frame, city_area, a, CAST(dense_rank() OVER (PARTITION BY frame, city_area ORDER BY label) - 1 AS INTEGER) AS cluster_id FROM labels),
owned AS (SELECT s.frame, s.city_area, s.latitude, s.longitude, coalesce(own.cluster_id, min(other.cluster_id), -1) AS cluster_id
  FROM sites s LEFT JOIN numbers own ON (own.frame, own.city_area, own.a) = (s.frame, s.city_area, s.first_id)
  LEFT JOIN near n ON (n.frame, n.city_area, n.a) = (s.frame, s.city_area, s.first_id)
  LEFT JOIN numbers other ON (other.frame, other.city_area, other.a) = (n.frame, n.city_area, n.b)
  GROUP BY s.frame, s.city_area, s.latitude, s.longitude, own.cluster_id),
clustered AS (SELECT p.*, min_samples, cluster_id FROM {points} p JOIN need USING (frame, city_area) JOIN owned USING (frame, city_area, latitude, longitude))"""


_CLUSTERED = f"WITH RECURSIVE {_FRAME_POINTS}, {_dbscan('points')}"


def _clustered(spark, sf):
    points, frames = _cluster_points(spark, sf)
    return H.cluster_in_frames(H.frame_points(spark, points, frames)), frames


@query("hot02_dbscan", f"{_CLUSTERED} SELECT frame, city_area, crash_id, min_samples, cluster_id FROM clustered")
def hot02(spark, sf):
    return _clustered(spark, sf)[0].select("frame", "city_area", "crash_id", "min_samples", "cluster_id")


@query("hot03_concentration", f"""
{_CLUSTERED}, sizes AS (SELECT *, row_number() OVER (PARTITION BY frame, city_area ORDER BY n DESC, cluster_id) AS k FROM
  (SELECT frame, city_area, cluster_id, count(*) AS n FROM clustered WHERE cluster_id >= 0 GROUP BY ALL)),
top AS (SELECT frame, city_area, count(*) AS hotspots, sum(n) FILTER (WHERE k <= 10) AS t FROM sizes GROUP BY ALL),
counted AS (SELECT frame, city_area, count(*) AS n, max(min_samples) AS min_samples, count(*) FILTER (WHERE cluster_id >= 0) AS h,
  count(*) FILTER (WHERE cluster_id >= 0 AND severity = 'fatal') AS hf, count(*) FILTER (WHERE cluster_id < 0 AND severity = 'fatal') AS cf FROM clustered GROUP BY ALL),
wanted AS (SELECT f.frame, fc.city_area FROM cframes f JOIN frame_cities fc ON f.frame_no = fc.frame_no)
SELECT frame, city_area, coalesce(n, 0) AS injury_crashes, coalesce(min_samples, 5) AS min_samples, coalesce(hotspots, 0) AS hotspots,
  {pct('coalesce(h, 0)', 'coalesce(n, 0)', 1)} AS pct_in_hotspots, coalesce({pct('coalesce(t, 0)', 'coalesce(n, 0)', 1)}, 0.0) AS pct_in_top10_hotspots,
  {pct('coalesce(hf, 0)', 'coalesce(h, 0)', 2)} AS pct_fatal_in_hotspots, {pct('coalesce(cf, 0)', '(coalesce(n, 0) - coalesce(h, 0))', 2)} AS pct_fatal_elsewhere
FROM wanted LEFT JOIN counted USING (frame, city_area) LEFT JOIN top USING (frame, city_area)""")
def hot03(spark, sf):
    return H.concentration(spark, *_clustered(spark, sf))


@query("hot04_cluster_summary", f"""
{_CLUSTERED}, hours AS (SELECT frame, city_area, cluster_id, local_hour, count(*) AS n FROM clustered WHERE cluster_id >= 0 GROUP BY ALL),
peak AS (SELECT frame, city_area, cluster_id, local_hour AS peak_local_hour FROM hours
  QUALIFY row_number() OVER (PARTITION BY frame, city_area, cluster_id ORDER BY n DESC, local_hour) = 1)
SELECT frame, city_area, cluster_id, size, CAST(round(CAST(la AS DECIMAL(38,12)), 5) AS DOUBLE) AS centroid_lat,
  CAST(round(CAST(lo AS DECIMAL(38,12)), 5) AS DOUBLE) AS centroid_lon, {pct('f', 'size', 2)} AS pct_fatal, {pct('s', 'size', 2)} AS pct_serious,
  {pct('m', 'size', 2)} AS pct_minor, peak_local_hour
FROM (SELECT frame, city_area, cluster_id, count(*) AS size, avg(latitude) AS la, avg(longitude) AS lo, count(*) FILTER (WHERE severity = 'fatal') AS f,
  count(*) FILTER (WHERE severity = 'serious') AS s, count(*) FILTER (WHERE severity = 'minor') AS m FROM clustered WHERE cluster_id >= 0 GROUP BY ALL)
JOIN peak USING (frame, city_area, cluster_id)""")
def hot04(spark, sf):
    return H.summarize_clusters(_clustered(spark, sf)[0], ["frame", "city_area"])


_SEEDS = ", ".join(f"({s})" for s in STABILITY_SEEDS)


@query("hot05_stability", f"""
WITH RECURSIVE {_FRAME_POINTS}, seeded AS (SELECT p.* REPLACE (p.frame || '#' || seed AS frame) FROM points p, (VALUES {_SEEDS}) v(seed)
  WHERE CAST('0x' || substr(md5(crash_id || '/' || seed), 1, 8) AS BIGINT) < CAST(floor(0.8 * 4294967296) AS BIGINT)),
{_dbscan('seeded')}, per_seed AS (SELECT left(frame, length(frame) - 2) AS frame, right(frame, 1) AS seed, city_area,
  count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS h, {pct('count(*) FILTER (WHERE cluster_id >= 0)', 'count(*)', 1)} AS p
  FROM clustered GROUP BY ALL)
SELECT frame, city_area, """ + ", ".join(
    f"""max(h) FILTER (WHERE seed = '{s}') AS "{s}_hotspots", max(p) FILTER (WHERE seed = '{s}') AS "{s}_pct_in_hotspots\"""" for s in STABILITY_SEEDS)
    + " FROM per_seed GROUP BY ALL")
def hot05(spark, sf):
    points, frames = _cluster_points(spark, sf)
    return H.stability(H.frame_points(spark, points, frames))


@query("joi10_distance_join", """
WITH p AS (SELECT city_area, crash_id, radians(latitude) AS la, radians(longitude) AS lo, floor(latitude / 0.0025) AS cy,
  floor(longitude / 0.005) AS cx FROM comparable WHERE has_valid_coordinates),
around AS (SELECT dy, dx FROM range(-1, 2) a(dy), range(-1, 2) b(dx))
SELECT p.city_area, p.crash_id, count(q.crash_id) > 0 AS has_neighbours FROM p CROSS JOIN around
LEFT JOIN p q ON q.city_area = p.city_area AND q.cy = p.cy + dy AND q.cx = p.cx + dx AND q.crash_id <> p.crash_id
  AND pow(sin((p.la - q.la) / 2), 2) + cos(p.la) * cos(q.la) * pow(sin((p.lo - q.lo) / 2), 2) <= pow(sin(150.0 / 6371000 / 2), 2)
GROUP BY ALL""")
def joi10(spark, sf):
    """Points with another crash within 150 m: the neighbour test of the hotspots alone."""
    points = FR.comparable(fact(spark, sf)).where("has_valid_coordinates")
    return H.neighbour_counts(points, ["city_area"], 2).select("city_area", "crash_id", "has_neighbours")


# -- profiling -------------------------------------------------------------------------

_T = f"strptime(CRASH_DATE, '{US_LAYOUT}')"
_P = f"strptime(DATE_POLICE_NOTIFIED, '{US_LAYOUT}')"


@query("prf01_schema_drift", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {chr(39) + 'string' + chr(39) if c in _A_COLUMNS else 'NULL'} AS data_type, "
    f"'{'ok' if c in _A_COLUMNS else 'missing'}' AS status, (SELECT count(*) FROM raw_a) AS n_rows, CAST(16 AS BIGINT) AS n_columns"
    for c in P.EXPECTED))
def prf01(spark, sf):
    return P.schema_report(raw_orders(spark, sf))


@query("prf02_missingness", NULLS_SQL)
def prf02(spark, sf):
    return P.missingness_report(raw_orders(spark, sf))


@query("prf03_duplicates", """
SELECT 'full_row' AS kind, (SELECT count(*) FROM raw_a) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_a)) AS extra_rows
UNION ALL SELECT 'CRASH_RECORD_ID', (SELECT count(*) - count(DISTINCT CRASH_RECORD_ID) FROM raw_a)""")
def prf03(spark, sf):
    return P.duplicate_report(raw_orders(spark, sf))


@query("prf04_dates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({t}) AS min_value, max({t}) AS max_value, count(*) AS with_ampm, CAST(0 AS BIGINT) AS without_ampm, "
    f"CAST(0 AS BIGINT) AS failed_to_parse, count(*) FILTER (WHERE {t} > TIMESTAMP '2024-01-01') AS future_rows FROM raw_a"
    for c, t in (("CRASH_DATE", _T), ("DATE_POLICE_NOTIFIED", _P))))
def prf04(spark, sf):
    return P.date_report(raw_orders(spark, sf), F.lit("2024-01-01").cast("timestamp"))


@query("prf05_yearly_coverage", f"SELECT CAST(year({_T}) AS INTEGER) AS year, count(*) AS n_rows FROM raw_a GROUP BY 1")
def prf05(spark, sf):
    return P.yearly_coverage(raw_orders(spark, sf))


@query("prf06_group_coverage", f"""
SELECT (SELECT count(*) FILTER (WHERE BEAT_OF_OCCURRENCE IS NULL) FROM raw_a) AS rows_missing_beat, count(*) AS n_districts,
  count(*) FILTER (WHERE before_cutoff) AS n_before_cutoff, min(first_date) AS earliest
FROM ({_DISTRICTS.format(cutoff='2018-01-02 00:00:00')})""")
def prf06(spark, sf):
    return P.district_summary(raw_orders(spark, sf), "2018-01-02")


@query("prf07_date_logic", f"""
SELECT count(*) FILTER (WHERE {_P} < {_T}) AS rows_notified_before_crash,
  max(epoch_us({_P}) - epoch_us({_T})) / 86400000000.0::DOUBLE AS max_gap_days FROM raw_a""")
def prf07(spark, sf):
    return P.date_logic(raw_orders(spark, sf))


@query("prf08_coordinates", f"""
SELECT count(*) FILTER (WHERE lat IS NULL OR lon IS NULL) AS rows_missing, count(*) FILTER (WHERE lat = 0 OR lon = 0) AS rows_zero,
  count(*) FILTER (WHERE lat <> 0 AND lon <> 0 AND NOT (lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -87.95 AND -87.50)) AS rows_outside_box,
  min(lat) FILTER (WHERE lat <> 0) AS min_lat, max(lat) FILTER (WHERE lat <> 0) AS max_lat,
  min(lon) FILTER (WHERE lon <> 0) AS min_lon, max(lon) FILTER (WHERE lon <> 0) AS max_lon,
  {pct('count(*) FILTER (WHERE lat IS NULL OR lon IS NULL)', 'count(*)', 2)} AS pct_missing
FROM (SELECT TRY_CAST(LATITUDE AS DOUBLE) AS lat, TRY_CAST(LONGITUDE AS DOUBLE) AS lon FROM raw_a)""")
def prf08(spark, sf):
    return P.coordinate_report(raw_orders(spark, sf))


@query("prf09_speed", """
SELECT CAST(POSTED_SPEED_LIMIT AS DOUBLE) AS speed, count(*) AS n_rows, min(lo) AS min_speed, max(hi) AS max_speed, max(bad) AS rows_outside_band
FROM raw_a, (SELECT min(CAST(POSTED_SPEED_LIMIT AS DOUBLE)) AS lo, max(CAST(POSTED_SPEED_LIMIT AS DOUBLE)) AS hi,
  count(*) FILTER (WHERE CAST(POSTED_SPEED_LIMIT AS DOUBLE) NOT BETWEEN 5 AND 70) AS bad FROM raw_a) GROUP BY 1""")
def prf09(spark, sf):
    rows = raw_orders(spark, sf)
    return P.speed_histogram(rows).join(F.broadcast(P.speed_report(rows)))


@query("prf10_categories", "SELECT column_name, value, n_rows FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value NULLS LAST) AS r FROM ("
       + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows FROM raw_a GROUP BY 2"
                            for c in P.CATEGORIES if c in _A_COLUMNS) + ")) WHERE r <= 15")
def prf10(spark, sf):
    return P.category_report(raw_orders(spark, sf))


@query("prf11_injuries", """
SELECT 'INJURIES_TOTAL' AS measure, sum(CAST(INJURIES_TOTAL AS DOUBLE)) AS value FROM raw_a
UNION ALL SELECT 'INJURIES_FATAL', sum(CAST(INJURIES_FATAL AS DOUBLE)) FROM raw_a
UNION ALL SELECT 'fatal_rows', count(*) FILTER (WHERE INJURIES_FATAL = '1') FROM raw_a
UNION ALL SELECT 'rows_without_injury_data', count(*) FILTER (WHERE INJURIES_TOTAL IS NULL AND MOST_SEVERE_INJURY IS NULL) FROM raw_a""")
def prf11(spark, sf):
    return P.injury_report(raw_orders(spark, sf))


@query("prf12_near_empty", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name FROM raw_a HAVING count(*) FILTER (WHERE {c} IS NULL) * 100 >= 50 * count(*)" for c in _A_COLUMNS))
def prf12(spark, sf):
    return P.near_empty_columns(raw_orders(spark, sf), 50.0)


def _cells_sql(section, entry, measure, number="NULL", text="NULL", time="NULL", source=""):
    return (f"SELECT '{section}' AS section, {entry} AS entry, '{measure}' AS measure, CAST({number} AS DOUBLE) AS number, "
            f"CAST({text} AS VARCHAR) AS text, CAST({time} AS TIMESTAMP) AS time {source}")


def _report_sql(now, cutoff, threshold):
    """Every cell of the profile report, section by section."""
    q = chr(39)
    one = "FROM raw_a"
    cells = [_cells_sql("schema", "'table'", "n_rows", "count(*)", source=one),
             _cells_sql("schema", "'table'", "n_columns", str(len(_A_COLUMNS)))]
    for c in sorted(set(P.EXPECTED) | set(_A_COLUMNS)):
        has = c in _A_COLUMNS
        status = "missing" if not has else "ok" if c in P.EXPECTED else "extra"
        cells += [_cells_sql("schema", f"'{c}'", "data_type", text="'string'" if has else "NULL"),
                  _cells_sql("schema", f"'{c}'", "status", text=f"'{status}'")]
    for c in _A_COLUMNS:
        empty = f"count(*) FILTER (WHERE {c} IS NULL)"
        kind = "yes_only_flag" if c in P.YES_ONLY else "ordinary"
        cells += [_cells_sql("missingness", f"'{c}'", "kind", text=f"'{kind}'"),
                  _cells_sql("missingness", f"'{c}'", "null_count", empty, source=one),
                  _cells_sql("missingness", f"'{c}'", "pct_null", pct(empty, "count(*)", 2), source=one),
                  _cells_sql("near_empty", f"'{c}'", "near_empty", "1", source=f"{one} HAVING {empty} * 100 >= {threshold} * count(*)")]
    for c, t in (("CRASH_DATE", _T), ("DATE_POLICE_NOTIFIED", _P)):
        cells += [_cells_sql("dates", f"'{c}'", "min_value", time=f"min({t})", source=one),
                  _cells_sql("dates", f"'{c}'", "max_value", time=f"max({t})", source=one),
                  _cells_sql("dates", f"'{c}'", "with_ampm", f"count({c})", source=one),
                  _cells_sql("dates", f"'{c}'", "without_ampm", "0"), _cells_sql("dates", f"'{c}'", "failed_to_parse", "0"),
                  _cells_sql("dates", f"'{c}'", "future_rows", f"count(*) FILTER (WHERE {t} > TIMESTAMP '{now}')", source=one)]
    cells += [_cells_sql("date_logic", "'all'", "rows_notified_before_crash", f"count(*) FILTER (WHERE {_P} < {_T})", source=one),
              _cells_sql("date_logic", "'all'", "max_gap_days", f"max(epoch_us({_P}) - epoch_us({_T})) / 86400000000.0::DOUBLE", source=one)]
    at = "FROM (SELECT TRY_CAST(LATITUDE AS DOUBLE) AS lat, TRY_CAST(LONGITUDE AS DOUBLE) AS lon FROM raw_a)"
    bad = "NOT (lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -87.95 AND -87.50)"
    for measure, number in {
            "rows_missing": "count(*) FILTER (WHERE lat IS NULL OR lon IS NULL)", "rows_zero": "count(*) FILTER (WHERE lat = 0 OR lon = 0)",
            "rows_outside_box": f"count(*) FILTER (WHERE lat <> 0 AND lon <> 0 AND {bad})",
            **{f"{how}_{x}": f"{how}({x}) FILTER (WHERE lat <> 0 AND lon <> 0)" for x in ("lat", "lon") for how in ("min", "max")},
            "pct_missing": pct("count(*) FILTER (WHERE lat IS NULL OR lon IS NULL)", "count(*)", 2)}.items():
        cells.append(_cells_sql("coordinates", "'all'", measure, number, source=at))
    v = "CAST(POSTED_SPEED_LIMIT AS DOUBLE)"
    cells += [_cells_sql("speed_limit", "'all'", "min_speed", f"min({v})", source=one),
              _cells_sql("speed_limit", "'all'", "max_speed", f"max({v})", source=one),
              _cells_sql("speed_limit", "'all'", "rows_outside_band", f"count(*) FILTER (WHERE {v} NOT BETWEEN 5 AND 70)", source=one)]
    cells += [_cells_sql("injuries", "'all'", c, f"sum(CAST({c} AS DOUBLE))", source=one) for c in ("INJURIES_TOTAL", "INJURIES_FATAL")]
    cells += [_cells_sql("injuries", "'all'", "fatal_rows", "count(*) FILTER (WHERE INJURIES_FATAL = '1')", source=one),
              _cells_sql("injuries", "'all'", "rows_without_injury_data",
                         "count(*) FILTER (WHERE INJURIES_TOTAL IS NULL AND MOST_SEVERE_INJURY IS NULL)", source=one)]
    cells += [_cells_sql("yearly_coverage", f"CAST(year({_T}) AS VARCHAR)", "n_rows", "count(*)", source=f"{one} GROUP BY year({_T})"),
              _cells_sql("speed_histogram", f"CAST({v} AS VARCHAR)", "n_rows", "count(*)", source=f"{one} WHERE {v} IS NOT NULL GROUP BY {v}")]
    beats = (f"FROM (SELECT CAST(BEAT_OF_OCCURRENCE AS INTEGER) // 100 AS d, min({_T}) AS first FROM raw_a WHERE BEAT_OF_OCCURRENCE IS NOT NULL GROUP BY 1)")
    early = f"first < TIMESTAMP '{cutoff}'"
    cells += [_cells_sql("district_coverage", "CAST(d AS VARCHAR)", "first_date", time="first", source=beats),
              _cells_sql("district_coverage", "CAST(d AS VARCHAR)", "before_cutoff", f"CASE WHEN {early} THEN 1 ELSE 0 END", source=beats),
              _cells_sql("district_summary", "'all'", "n_districts", "count(*)", source=beats),
              _cells_sql("district_summary", "'all'", "n_before_cutoff", f"count(*) FILTER (WHERE {early})", source=beats),
              _cells_sql("district_summary", "'all'", "earliest", time="min(first)", source=beats),
              _cells_sql("district_summary", "'all'", "rows_missing_beat", "count(*) FILTER (WHERE BEAT_OF_OCCURRENCE IS NULL)", source=one)]
    for c in (c for c in P.CATEGORIES if c in _A_COLUMNS):
        cells.append(_cells_sql("top_categories", q + c + q, "n_rows", "n", "v", source=(
            f"FROM (SELECT {c} AS v, count(*) AS n FROM raw_a GROUP BY 1 ORDER BY n DESC, v NULLS LAST LIMIT 15)")))
    cells += [_cells_sql("duplicates", "'full_row'", "extra_rows",
                         "(SELECT count(*) FROM raw_a) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_a))"),
              _cells_sql("duplicates", "'CRASH_RECORD_ID'", "extra_rows", "count(*) - count(DISTINCT CRASH_RECORD_ID)", source=one)]
    return " UNION ALL ".join(f"({c})" for c in cells)


_REPORT = _report_sql("2024-01-01", "2018-01-02", 50)


def _report_args():
    return {"now": F.lit("2024-01-01").cast("timestamp"), "cutoff": "2018-01-02", "threshold": 50.0}


@query("prf13_build_report", _REPORT)
def prf13(spark, sf):
    root = scratch_path(spark, "profiled")
    raw_orders(spark, sf).write.parquet(root)
    return P.build_report(spark.read.parquet(root), **_report_args())


@query("snk12_profile_report", _REPORT)
def snk12(spark, sf):
    """The whole report written as JSON and read back."""
    root, out = scratch_path(spark, "profiled"), scratch_path(spark, "profile")
    raw_orders(spark, sf).write.parquet(root)
    P.write_report(spark.read.parquet(root), out, **_report_args())
    return P.read_report(spark, out)
