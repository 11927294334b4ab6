"""What keeps the work of a task bounded on large tables: narrow splits, folders written without a sort."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import wayfuse.session as S
from wayfuse.catalog.registry import QUERIES, query
from wayfuse.functions.scalars import to_whole
from wayfuse.operators import checks as C
from wayfuse.operators import publish as PB
from wayfuse.operators import snapshots as SN
from wayfuse.operators.curate import drop_without, write_partitioned, write_staged
from wayfuse.session import prepare, setting

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SPLIT = "spark.sql.files.maxPartitionBytes"


def _rows(spark, n=6000, folders=60):
    k = F.col("id") % folders
    return spark.range(0, n, 1, 1).select(
        "id", F.lit("s").alias("source_id"), (2000 + F.floor(k / 12)).cast("int").alias("year"),
        (k % 12 + 1).cast("int").alias("month"))


def test_folders_are_written_side_by_side_not_sorted(spark, tmp_path, monkeypatch):
    """More folders than files kept open at once: each still is one file of its task, and no row is lost."""
    seen, before = [], spark.conf.get(WRITERS)
    put = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(WRITERS)), put(self, *a, **k))[1])
    root = write_partitioned(_rows(spark), str(tmp_path / "plain"))
    SN.replace(spark, str(tmp_path / "table"), _rows(spark))
    assert len(seen) == 2 and all(int(n) > 0 for n in seen) and spark.conf.get(WRITERS) == before
    for rows in (spark.read.parquet(root), SN.read(spark, str(tmp_path / "table"))):
        counted = rows.withColumn("file", F.input_file_name()).groupBy("year", "month").agg(
            F.countDistinct("id").alias("n"), F.countDistinct("file").alias("files")).collect()
        assert len(counted) == 60 and {(r.n, r.files) for r in counted} == {(100, 1)}


def test_a_merge_derives_its_batch_once(spark, tmp_path):
    root, made = str(tmp_path / "table"), spark.sparkContext.accumulator(0)

    def key(n):
        made.add(1)
        return f"r{n}"

    rows = _rows(spark, 60).withColumn("source_record_id", F.concat(F.lit("r"), "id")).withColumn("ingested_at_utc", F.lit("2026-01-01").cast("timestamp"))
    SN.replace(spark, root, rows)
    SN.merge(spark, root, rows.where("id < 5").withColumn("source_record_id", F.udf(key)("id")))
    assert made.value == 5 and SN.read(spark, root).count() == 60


def test_only_unlisted_values_are_gathered(spark, tmp_path):
    path = str(tmp_path / "staged")
    spark.sql("SELECT 's' AS source_id, 'b' AS batch_id, explode(array('fatal', 'awful', null)) AS severity, 'US' AS country").write.parquet(path)
    out = C.accepted_samples(spark.read.parquet(path))
    assert "Not(In(severity" in out._jdf.queryExecution().executedPlan().toString()
    assert [r.asDict() for r in out.collect()] == [{"source_id": "s", "batch_id": "b", "sample_severity": "awful", "sample_country": ""}]


def test_crash_times_without_a_police_time_are_not_parsed(spark):
    rows = spark.sql("""SELECT 'chicago_us' AS source_id, 'b' AS batch_id, c AS crash_timestamp_utc, p AS police_notified_timestamp_utc FROM VALUES
      ('1/2/2024 3:04:05 PM', '1/2/2024 3:04:04 PM'), ('1/2/2024 3:04:05 PM', null), ('x', '1/2/2024 3:04:04 PM'), ('1/2/2024 3:04:05 PM', 'x') AS t(c, p)""")
    out = C.batch_counters(rows, ("date_logic_check",))
    assert "CASE WHEN isnotnull(police" in out._jdf.queryExecution().analyzed().toString()
    assert out.select("n", "dates_both", "dates_inverted").collect() == [(4, 1, 1)]


def test_a_setting_is_put_back_after_an_error(spark):
    before = spark.conf.get(WRITERS)
    try:
        with setting(spark, WRITERS, "7"):
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(WRITERS) == before


def test_feeds_are_read_in_narrow_splits(spark, tmp_path):
    """One file of some 30 MB is several tasks even where few are asked for; other queries keep the usual splits."""
    root = str(tmp_path / "wide")
    spark.range(0, 4_000_000, 1, 1).select(F.xxhash64("id").alias("h")).write.option("parquet.block.size", 1 << 20).parquet(root)
    usual, size = spark.conf.get(SPLIT), sum(os.path.getsize(f"{root}/{f}") for f in os.listdir(root))
    query("test_splits")(lambda s, sf: s.read.parquet(sf))
    try:
        with setting(spark, "spark.sql.files.minPartitionNum", "1"):
            assert QUERIES["test_splits"](spark, root).rdd.getNumPartitions() >= size >> 23
            assert size >> 23 > 2
    finally:
        del QUERIES["test_splits"]
        prepare(spark)
    assert spark.conf.get(SPLIT) == usual


def test_rows_without_time_are_dropped_in_generated_code(spark):
    rows = spark.range(4).select("id", F.when(F.col("id") % 2 == 0, F.col("id").cast("timestamp")).alias("t"))
    out = drop_without(rows, "t")
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.id, r.t is None) for r in out.orderBy("id").collect()] == [(0, False), (2, False)] and out.columns == ["id", "t"]


def test_whole_numbers_are_read_as_such_and_the_rest_as_before(spark):
    cells = ["5", " 5 ", "+5", "-0", "007", "2.0", "2.5", "5.", "1e3", "1d", "3000000000", "2147483648", "-2147483648", "", " ", "x", "NaN", "Infinity", None]
    got = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").select("i", to_whole(F.col("c")).alias("v"))
    d = F.trim("c").try_cast("double")
    want = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").select(
        "i", F.when(d == F.floor(d), d.try_cast("int")).alias("v"))
    assert "coalesce(try_cast(trim(c" in got._jdf.queryExecution().analyzed().toString().lower()
    assert got.orderBy("i").collect() == want.orderBy("i").collect()
    assert [r.v for r in got.orderBy("i").collect()][:8] == [5, 5, 5, 0, 7, 2, None, 5]


def test_keys_that_never_repeat_get_no_dictionary(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = _rows(spark, 100, 1).withColumns({c: F.col("id").cast("string") for c in ("crash_id", "source_record_id")}).withColumn("city", F.lit("c"))
    plain = {"crash_id": False, "source_record_id": False, "city": True}
    for root in (write_partitioned(rows, str(tmp_path / "folders")), write_staged(rows, str(tmp_path / "staged"))):
        file = next(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))
        group = pq.ParquetFile(file).metadata.row_group(0)
        found = {group.column(i).path_in_schema: any("DICTIONARY" in e for e in group.column(i).encodings) for i in range(group.num_columns)}
        assert {c: found[c] for c in plain} == plain
        assert spark.read.parquet(root).select("crash_id").distinct().count() == 100


@pytest.fixture
def large(monkeypatch):
    """Tables of a few kilobytes count as large."""
    monkeypatch.setattr(S, "_ROUND_BYTES", 100)


def _stored(spark, path, rows):
    rows.write.parquet(path)
    return spark.read.parquet(path)


def _files(root):
    return [f"{d}/{f}" for d, _, names in os.walk(root) for f in names if f.startswith("part-")]


def test_a_large_dataset_is_written_in_rounds_that_leave_no_shuffle(spark, tmp_path, monkeypatch, large):
    rows = _stored(spark, str(tmp_path / "rows"), _rows(spark).withColumn("source_record_id", F.when(F.col("id") % 7 > 0, F.col("id") % 1000)))
    seen, put = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        seen.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")), put(self, *a, **k))[1])
    root = write_partitioned(rows, str(tmp_path / "out"), repeatable=True)
    assert seen == ["true"] * S._MOST_ROUNDS and os.path.exists(f"{root}/_SUCCESS")
    columns = ["id", "source_record_id", "source_id", "year", "month"]
    assert sorted(map(str, spark.read.parquet(root).select(*columns).collect())) == sorted(map(str, rows.select(*columns).collect()))
    write_partitioned(rows, root)  # rows that may differ each time are derived once
    assert len(seen) == S._MOST_ROUNDS + 1 and spark.read.parquet(root).count() == 6000


def test_a_write_that_ends_between_rounds_is_not_marked_as_complete(spark, tmp_path, monkeypatch, large):
    rows = _stored(spark, str(tmp_path / "rows"), _rows(spark, 600).withColumn("source_record_id", F.col("id")))
    put = DataFrameWriter.parquet

    def lost(self, path, *a, **k):
        if _files(path):
            raise OSError("lost")
        return put(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", lost)
    with pytest.raises(OSError):
        write_partitioned(rows, str(tmp_path / "out"), repeatable=True)
    assert _files(tmp_path / "out") and not os.path.exists(tmp_path / "out" / "_SUCCESS")


def test_small_tables_and_frames_without_files_take_one_round(spark, tmp_path):
    assert S.rounds_for(_stored(spark, str(tmp_path / "rows"), _rows(spark))) == 1
    assert S.rounds_for(spark.createDataFrame([(1,)], "n int"), spark.range(5)) == 1


def test_copies_of_a_large_table_are_counted_in_rounds(spark, tmp_path, large):
    rows = _stored(spark, str(tmp_path / "keys"), spark.sql("""
      SELECT IF(id % 2 = 0, 'a', null) AS g, IF(id % 50 = 0, null, id % 300) AS k, CAST(id AS STRING) AS u FROM range(1000)"""))
    got = {r.g: (r.dup, r.none) for r in C.duplicate_counts(rows, ["g"], {"dup": ["k"], "none": ["u"]}).collect()}
    want = {g: 500 - rows.where(F.col("g").eqNullSafe(g)).select("k").distinct().count() for g in ("a", None)}
    assert got == {g: (n, 0) for g, n in want.items()}


def test_a_load_in_rounds_puts_down_its_rows_once(spark, tmp_path, monkeypatch, large):
    """The second load replaces the first source and adds the other; its rows lie in files and are not written as a batch before."""
    rows = spark.range(400).select(
        *[F.lit(None).cast(t).alias(c) for c, t in (("police_notified_timestamp_utc", "timestamp"), ("latitude", "double"), ("num_killed", "int"))],
        F.concat(F.lit("c"), "id").alias("crash_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source_id"),
        F.concat(F.lit("r"), F.floor(F.col("id") / 2)).alias("source_record_id"),
        F.make_date(F.lit(2024), (F.col("id") % 12 + 1).cast("int"), F.lit(1)).alias("crash_date_key"))
    for c in PB.FACT_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit("x"))
    rows = rows.withColumns({"year": F.year("crash_date_key"), "month": F.month("crash_date_key")})
    curated, fact, dates = str(tmp_path / "curated"), str(tmp_path / "fact"), str(tmp_path / "dates")
    write_partitioned(rows, curated)
    monkeypatch.setattr(SN, "saved", lambda *a: pytest.fail("the batch was written once more"))
    assert PB.load(spark, curated, fact, dates, "a")["rows_written"] == 200
    assert PB.load(spark, curated, fact, dates)["rows_written"] == 400
    loaded = SN.read(spark, fact)
    assert sorted(r.crash_id for r in loaded.collect()) == sorted(r.crash_id for r in rows.collect())
    assert loaded.select("ingested_at_utc").distinct().count() == 1  # one time for all rounds
    again = spark.read.parquet(curated)
    with pytest.raises(ValueError):
        SN.merge(spark, fact, again.unionByName(again.where("crash_id = 'c7'")), stored=True)
    assert SN.current(spark, fact).number == 2
