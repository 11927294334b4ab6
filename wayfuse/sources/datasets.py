"""Parquet reads of the staged and curated layers, and their file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_staged(spark: SparkSession, paths: dict) -> DataFrame:
    """One staged dataset per source, read together."""
    return spark.read.parquet(*[paths[s] for s in sorted(paths)])


def read_curated(spark: SparkSession, root: str, source_id: str | None = None,
                 year: int | None = None, month: int | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """Curated rows; source, year and month prune folders, columns prune the scan."""
    df = spark.read.parquet(root)
    for name, value in (("source_id", source_id), ("year", year), ("month", month)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df if columns is None else df.select(*columns)


def read_comparable(spark: SparkSession, root: str, severities: list[str]) -> DataFrame:
    """Rows usable for spatial work: the predicates reach the Parquet scan."""
    return spark.read.parquet(root).where(
        F.col("has_valid_coordinates") & F.col("severity").isin(*severities))


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, length and modification time of every file below ``root``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root)
            .select("path", "length", "modificationTime"))


def folder_value(path, key: str):
    """Value of a ``key=value`` folder in a path."""
    return F.nullif(F.regexp_extract(path, f"/{key}=([^/]*)/", 1), F.lit(""))


def file_key(path):
    """Path without scheme and with escapes undone, so that listings agree."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(path, r"^file:/+", "/"), r"\+", "%2B"))


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet file: folder values and row count, empty files kept."""
    counts = (spark.read.option("recursiveFileLookup", "true").parquet(root)
              .groupBy(file_key(F.col("_metadata.file_path")).alias("path"))
              .agg(F.count("*").alias("num_rows")))
    files = listing(spark, root, "*.parquet").select(file_key(F.col("path")).alias("path"))
    return (files.join(counts, "path", "left")
            .select("path", folder_value(F.col("path"), "source_id").alias("source_id"),
                    folder_value(F.col("path"), "year").try_cast("int").alias("year"),
                    folder_value(F.col("path"), "month").try_cast("int").alias("month"),
                    F.coalesce("num_rows", F.lit(0)).cast("long").alias("num_rows")))
