"""The feeds put down as files, the way the sources deliver them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.operators.curate import Candidate, harmonize, write_partitioned, write_staged
from wayfuse.plans.bindings import BATCHES, curated, raw_lineitem, staged
from wayfuse.session import scratch_path
from wayfuse.sources.datasets import read_staged

PAGE_ROWS = 5000
_WRITTEN: dict[tuple, object] = {}


def _inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of the given tables: a table that has changed is another input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def once(spark: SparkSession, sf_dir: str, what: str, write):
    """Result of ``write()``, called once per application and state of the dataset."""
    key = (spark.sparkContext.applicationId, sf_dir, _inputs(spark, sf_dir), what)
    if key not in _WRITTEN:
        _WRITTEN[key] = write()
    return _WRITTEN[key]


def land_csv(df: DataFrame, root: str, name: Column | None = None) -> str:
    """Rows as CSV with a header; with ``name``, one named file per value, of as many parts as tasks wrote it."""
    if name is not None:
        df = df.withColumn("file", name)
    writer = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    (writer if name is None else writer.partitionBy("file")).csv(root)
    return root


def land_lines(lines: DataFrame, root: str, *order: str) -> str:
    """Rows (file, line, ...) as one named text file per value of ``file``, its lines in the given order.

    A file has as many parts as tasks wrote it; in the order of their paths they hold the lines in order.
    """
    dealt = lines.repartitionByRange("file", *order).sortWithinPartitions("file", *order)
    dealt.select("file", "line").write.mode("overwrite").partitionBy("file").text(root)
    return root


def land_pages(df: DataFrame, row_no: Column, root: str, page_rows: int = PAGE_ROWS) -> str:
    """Rows as files that each hold one JSON array of at most ``page_rows`` records.

    The page is a range of a dense row number, so its size is bounded.
    """
    record = F.struct(*df.columns)
    pages = (df.groupBy(F.floor(row_no / page_rows).alias("page"))
             .agg(F.to_json(F.collect_list(record)).alias("value")))
    pages.write.mode("overwrite").partitionBy("page").text(root)
    return root


def annual_name() -> Column:
    return F.concat(F.lit("dft-road-casualty-statistics-collision-"), F.substring("date", 7, 4), F.lit(".csv"))


def land_annual(spark: SparkSession, sf_dir: str) -> str:
    """The day-first feed as one named file per year."""
    return land_csv(raw_lineitem(spark, sf_dir), scratch_path(spark, "annual"), annual_name())


def stage_all(spark: SparkSession, sf_dir: str) -> dict:
    return {s: write_staged(staged(spark, sf_dir, s), scratch_path(spark, f"staged-{s}")) for s in BATCHES}


def candidate(spark: SparkSession, sf_dir: str) -> Candidate:
    return harmonize(spark, stage_all(spark, sf_dir), BATCHES, scratch_path(spark, "candidate"))


def staged_paths(spark: SparkSession, sf_dir: str) -> dict:
    """Staged datasets of the three feeds, written once per application."""
    return once(spark, sf_dir, "staged", lambda: stage_all(spark, sf_dir))


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_staged(spark, staged_paths(spark, sf_dir))


def publish_as(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Let the queries of this application read the curated dataset at ``path``."""
    _WRITTEN[spark.sparkContext.applicationId, sf_dir, _inputs(spark, sf_dir), "curated"] = path


def published(spark: SparkSession, sf_dir: str) -> str:
    """The partitioned curated dataset of the feeds, written once per application."""
    return once(spark, sf_dir, "curated", lambda: write_partitioned(
        curated(spark, sf_dir), scratch_path(spark, "curated"), repeatable=True))


def fact(spark: SparkSession, sf_dir: str, *sources: str) -> DataFrame:
    """Curated rows read back from the published dataset, of the named sources or all."""
    rows = spark.read.parquet(published(spark, sf_dir))
    rows = rows.withColumn("source_id", F.col("source_id").cast("string"))
    return rows.where(F.col("source_id").isin(*sources)) if sources else rows
