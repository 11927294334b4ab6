import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfuse.operators import formats as FM
from wayfuse.plans.landing import land_csv, land_pages
from wayfuse.sources import files as FL
from wayfuse.sources import text as TX
from wayfuse.streaming.incremental import freshness

CSV = "col1,col2\na,1\nb,2\nc,3\n"


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def test_only_blank_is_null(spark, tmp_path):
    root = put(tmp_path, a__csv='x,y\nNA,null\n,"line one\nline two"\n"say ""hi""",\n')
    rows = {tuple(r) for r in TX.read_csv_text(spark, root, ["x", "y"], multi_line=True).collect()}
    assert rows == {("NA", "null"), (None, "line one\nline two"), ('say "hi"', None)}


def test_union_aligns_by_name(spark, tmp_path):
    one, two = put(tmp_path / "1", a__csv="x,y\n1,2\n"), put(tmp_path / "2", b__csv="y,z\n3,4\n")
    df = TX.read_csv_union(spark, [one, two])
    assert df.columns == ["x", "y", "z"]
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "2", None), (None, "3", "4")]
    with pytest.raises(FileNotFoundError):
        TX.read_csv_union(spark, [])


def test_missing_listed_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        TX.read_csv_union(spark, [str(tmp_path / "absent.csv")])


def test_json_pages(spark, tmp_path):
    df = spark.range(1001).select(F.col("id").cast("string").alias("collision_id"), F.lit("x").alias("v"))
    root = land_pages(df, F.col("collision_id").cast("long"), str(tmp_path / "pages"), 1000)
    back = TX.read_json_pages(spark, root, ["collision_id", "v", "absent"])
    assert back.count() == 1001 and back.where("absent IS NULL").count() == 1001
    put(tmp_path / "own", p__json='[{"a": 1, "b": null}, {"a": "2"}]')
    assert [tuple(r) for r in TX.read_json_pages(spark, str(tmp_path / "own"), ["a", "b"]).collect()] == [("1", None), ("2", None)]


def test_page_overlap_keeps_the_newest(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("j", 2, "only")], "id string, page int, v string")
    assert sorted(map(tuple, TX.drop_page_overlap(df, "id", "page").collect())) == [("j", 2, "only"), ("k", 3, "new")]


def test_trailing_window(spark):
    df = spark.sql("SELECT date_add(DATE '2026-01-01', CAST(id AS INT)) AS d FROM range(0, 200)")
    out = TX.trailing_window(df, "d", 90).agg(F.min("d"), F.max("d"), F.count("*")).first()
    assert (out[1] - out[0]).days == 90 and out[2] == 91
    back = TX.trailing_window(df, "d", 90, "2026-01-01", "2026-01-10")
    assert back.count() == 10
    capped = TX.trailing_window(df, "d", 90, max_rows=5, order=["d"])
    assert capped.count() == 5
    with pytest.raises(RuntimeError, match="0 rows"):
        TX.require_rows(TX.trailing_window(df, "d", 90, "2030-01-01", "2030-02-01"), "pull")


def test_sanity_scan(spark, tmp_path):
    root = put(tmp_path, good__csv=CSV, one__csv="col1\na\n", bad__csv=b"col1,col2\n\xff\xfe,1\n")
    got = {r.name: (r.status, r.row_count) for r in FL.csv_sanity(spark, root).collect()}
    assert got["good.csv"] == ("ok", 3) and got["one.csv"][0] == "no header" and got["bad.csv"][0] == "not utf-8"


def test_newest_by_name(spark, tmp_path):
    root = put(tmp_path, Crashes_20260101__csv=CSV, Crashes_20260923__csv=CSV, other__csv=CSV)
    got = FL.newest_file(FL.listed(spark, root), "Crashes_*.csv").first()
    assert got.name == "Crashes_20260923.csv" and got.status == "ok"
    assert FL.newest_file(FL.listed(spark, root), "Nothing_*.csv").first().status == "missing"


def test_expected_years(spark, tmp_path):
    root = put(tmp_path, f_2021__csv=CSV, renamed_2022_v2__csv=CSV, a_2023__csv=CSV, b_2023__csv=CSV)
    found = FL.expected_files(spark, FL.listed(spark, root), [2021, 2022, 2023, 2024], "f_{year}.csv")
    assert {r.year: r.status for r in found.collect()} == {2021: "ok", 2022: "ok", 2023: "ambiguous", 2024: "missing"}
    with pytest.raises(FileNotFoundError, match="2023: ambiguous, 2024: missing"):
        FL.require_all(found)
    assert len(FL.require_all(found.where("year < 2023"))) == 2


def test_fingerprint_of_one_part_is_the_content_hash(spark, tmp_path):
    import hashlib
    root = put(tmp_path, a__csv=CSV)
    row = FL.fingerprints(spark, root).first()
    assert row.sha256 == hashlib.sha256(CSV.encode()).hexdigest() and row.size_bytes == len(CSV)


def incoming(spark, root, source="uk"):
    return FL.fingerprints(spark, root).select(F.lit(source).alias("source_id"), F.col("name").alias("file_name"), "sha256")


def entries(spark, root, batch="uk_1", **kw):
    return FL.manifest_entries(FL.fingerprints(spark, root), FL.csv_sanity(spark, root), "uk", batch, **kw)


def test_change_detection(spark, tmp_path):
    root = put(tmp_path / "a", y1__csv=CSV, y2__csv=CSV)
    manifest = entries(spark, root)
    same = FL.detect_change(manifest, incoming(spark, root)).first()
    assert (same.previous_batch_id, same.content_changed) == ("uk_1", False)
    other = put(tmp_path / "b", y1__csv=CSV, y2__csv=CSV + "d,4\n")
    assert FL.detect_change(manifest, incoming(spark, other)).first().content_changed
    more = put(tmp_path / "c", y1__csv=CSV, y2__csv=CSV, y3__csv=CSV)
    assert FL.detect_change(manifest, incoming(spark, more)).first().content_changed
    gone = FL.listed(spark, root).where("name = 'y1.csv'").select(F.col("path").alias("raw_path"))
    assert FL.detect_change(manifest, incoming(spark, root), gone).first().content_changed
    pages = entries(spark, root, kind="json_pages")
    assert FL.detect_change(pages, incoming(spark, root)).first().content_changed


def test_newest_batch_decides(spark, tmp_path):
    old, new = put(tmp_path / "a", y__csv=CSV), put(tmp_path / "b", y__csv=CSV + "d,4\n")
    manifest = entries(spark, old, "uk_1").unionByName(entries(spark, new, "uk_2"))
    assert FL.detect_change(manifest, incoming(spark, old)).first().content_changed
    assert not FL.detect_change(manifest, incoming(spark, new)).first().content_changed


def test_manifest_totals(spark, tmp_path):
    root, store = put(tmp_path / "a", y1__csv=CSV, y2__csv=CSV), str(tmp_path / "m")
    FL.append_manifest(entries(spark, root), store)
    FL.append_manifest(FL.manifest_entries(FL.fingerprints(spark, root), None, "uk", "uk_2"), store)
    got = {r.batch_id: (r.file_count, r.total_records_or_files) for r in FL.batch_totals(spark.read.parquet(store)).collect()}
    assert got == {"uk_1": (2, 6), "uk_2": (2, 2)}


def extract(spark, **values):
    base = {"source_id": "chicago_us", "batch_id": "b2", "content_changed": True, "previous_batch_id": "b1",
            "first_ingested_at": dt.datetime(2026, 1, 1), "latest_published_date": dt.date(2026, 1, 1),
            "window_since": dt.date(2025, 10, 3), "window_until": dt.date(2026, 1, 1), "source_files": "f.csv", "row_count": 5}
    base.update(values)
    schema = ("source_id string, batch_id string, content_changed boolean, previous_batch_id string, first_ingested_at timestamp, "
              "latest_published_date date, window_since date, window_until date, source_files string, row_count long")
    return spark.createDataFrame([tuple(base.values())], schema)


@pytest.mark.parametrize("values,now,status,words", [
    ({}, "2026-06-01", "pass", "NEW content in f.csv, after batch b1"),
    ({"content_changed": False}, "2026-01-15", "pass", "first seen 14 days back"),
    ({"content_changed": False}, "2026-01-16", "warn", "14-day limit"),
    ({"content_changed": False, "source_id": "uk_stats19"}, "2027-01-01", "pass", "UNCHANGED"),
    ({"source_id": "nyc_us"}, "2026-06-30", "pass", "180 days old"),
    ({"source_id": "nyc_us"}, "2026-07-01", "warn", "over the limit of 180"),
    ({"source_id": "nyc_us", "latest_published_date": None}, "2026-07-01", "pass", "None"),
])
def test_freshness(spark, values, now, status, words):
    row = freshness(extract(spark, **values), F.lit(now).cast("timestamp")).first()
    assert row.status == status and words in row.details and row.check_name == "source_freshness"


def test_named_files_of_a_partitioned_landing(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "x string, y string")
    root = land_csv(df, str(tmp_path / "l"), F.concat("x", F.lit(".csv")))
    assert {r.name for r in FL.listed(spark, root).collect()} == {"a.csv", "b.csv"}


def test_formats_round_trip(spark, tmp_path):
    df = spark.sql("SELECT id, CASE WHEN id % 2 = 0 THEN '' WHEN id % 3 = 0 THEN NULL ELSE concat('v,\"', id) END AS s, "
                   "id / 7 AS d, timestamp_micros(id * 1000000) AS t FROM range(50)")
    want = sorted(map(tuple, df.collect()))
    for name, rows in FM.round_trip(df, str(tmp_path)).items():
        assert sorted(map(tuple, rows.collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0]), name
    sizes = {r.format: r for r in FM.sizes(spark, str(tmp_path)).collect()}
    assert sizes["parquet"].relative_to_parquet == 1.0 and sizes["json"].size_bytes > sizes["csv"].size_bytes
    with pytest.raises(RuntimeError):
        FM.round_trip(df.where("id < 0"), str(tmp_path / "empty"))


def test_parts_that_change_places_change_the_hash(spark, tmp_path):
    def file(folder, first, second):
        put(tmp_path / folder / "file=a.csv", **{"part-0__csv": first, "part-1__csv": second})
        return FL.fingerprints(spark, str(tmp_path / folder)).first().sha256
    assert file("one", CSV, CSV + "d,4\n") != file("two", CSV + "d,4\n", CSV)
    assert file("three", CSV, CSV + "d,4\n") == file("four", CSV, CSV + "d,4\n")


def test_header_with_commas_in_quotes(spark, tmp_path):
    root = put(tmp_path, one__csv='"just, one"\n1\n', two__csv='"x, y",z\n1,2\n')
    got = {r.name: (r.status, r.header_columns) for r in FL.csv_sanity(spark, root).collect()}
    assert got == {"one.csv": ("no header", 1), "two.csv": ("ok", 2)}
