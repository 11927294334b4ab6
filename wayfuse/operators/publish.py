"""Publishing a candidate, the warehouse tables and their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.operators import snapshots as SN
from wayfuse.sources.datasets import read_curated
from wayfuse.spec import DIM_SOURCE, FACT_COLUMNS


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(spark: SparkSession, candidate: str, live: str) -> int:
    """Put an audited candidate in place of the live dataset; returns its file count.

    Two renames in the file system, no data is read or written. The old dataset
    is dropped last; if the second rename fails it is put back.
    """
    fs, new = _path(spark, candidate)
    _, current = _path(spark, live)
    _, previous = _path(spark, live.rstrip("/") + "_previous")
    if not fs.exists(new):
        raise FileNotFoundError(f"no candidate at {candidate}")
    fs.delete(previous, True)
    had_live = fs.exists(current)
    if had_live and not fs.rename(current, previous):
        raise RuntimeError(f"could not set {live} aside")
    if not had_live:
        fs.mkdirs(current.getParent())
    if not fs.rename(new, current):
        if had_live:
            fs.rename(previous, current)
        raise RuntimeError(f"could not move {candidate} to {live}")
    fs.delete(previous, True)
    spark.catalog.refreshByPath(live)
    return _file_count(spark, live)


def _file_count(spark: SparkSession, root: str) -> int:
    """Data files below ``root``, from the listing alone."""
    fs, p = _path(spark, root)
    found, n = fs.listFiles(p, True), 0
    while found.hasNext():
        n += found.next().getPath().getName().startswith("part-")
    return n


def dim_source(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DIM_SOURCE, "source_id string, provider string, dataset_url string, city string, "
                    "country string, source_local_timezone string, license string")


def dim_date_rows(dates: DataFrame, column: str = "crash_date_key") -> DataFrame:
    """Calendar row of every distinct date; 0 is Monday."""
    d = F.col("date_key")
    return (dates.select(F.col(column).alias("date_key")).where(d.isNotNull()).distinct()
            .select("date_key", F.year(d).alias("year"), F.month(d).alias("month"),
                    F.day(d).alias("day"), F.weekday(d).alias("day_of_week"),
                    (F.weekday(d) >= 5).alias("is_weekend")))


def missing_dates(dates: DataFrame, dim_date: DataFrame, column: str = "crash_date_key") -> DataFrame:
    """Calendar rows the dimension does not have yet."""
    return dim_date_rows(dates, column).join(dim_date.select("date_key"), "date_key", "left_anti")


def fact_rows(curated: DataFrame) -> DataFrame:
    """Exactly the fact columns, in load order; a missing one is an error."""
    missing = [c for c in FACT_COLUMNS if c not in curated.columns]
    if missing:
        raise KeyError(f"curated data lacks {missing}")
    return curated.select(*FACT_COLUMNS)


def load(spark: SparkSession, curated_root: str, fact_root: str, dim_date_root: str,
         source_id: str | None = None, dry_run: bool = False) -> dict:
    """Curated rows of one source, or all, into the warehouse tables; the facts are a table of snapshots."""
    rows = read_curated(spark, curated_root, source_id)
    fact = fact_rows(rows)
    read = rows.count()
    if dry_run:
        return {"rows_read": read, "rows_written": 0, "dim_date_inserted": 0}
    have = _read_or_empty(spark, dim_date_root, dim_date_rows(rows))
    fresh = missing_dates(rows, have)
    inserted = fresh.count()
    if inserted:
        fresh.repartition(1).write.mode("append").parquet(dim_date_root)
    keyed = fact.withColumns({"year": F.year("crash_date_key"), "month": F.month("crash_date_key"),
                              "source_id": F.col("source_id").cast("string")})
    SN.merge(spark, fact_root, keyed.withColumn("ingested_at_utc", F.current_timestamp()), stored=True)
    return {"rows_read": read, "rows_written": read, "dim_date_inserted": inserted}


def _read_or_empty(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    fs, p = _path(spark, root)
    return spark.read.parquet(root) if fs.exists(p) else spark.createDataFrame([], like.schema)
