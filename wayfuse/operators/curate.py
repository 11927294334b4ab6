"""Staged text to typed curated rows, the partitioned write and its summary."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.functions.scalars import to_bool, to_double, to_whole
from wayfuse.functions.timeparse import with_utc
from wayfuse.session import in_rounds, rounds_for, setting, unshuffled
from wayfuse.spec import ADAPTERS, CANONICAL, PARTITION_KEYS
from wayfuse.sources.datasets import data_files, read_staged


# No value of these comes twice: a dictionary of them is built, hashed row by row, and thrown away.
_PLAIN = {f"parquet.enable.dictionary#{c}": "false" for c in ("crash_id", "source_record_id")}
# In place of Spark's own snappy: a third less on disk for the same time.
_FILES = _PLAIN | {"compression": "zstd"}
TIME_COLUMNS = ["crash_timestamp_utc", "police_notified_timestamp_utc"]


def _typed(name: str, kind: str) -> Column:
    c = F.col(name)
    if name in TIME_COLUMNS:
        return c
    if kind == "timestamp":
        return c.try_cast("timestamp")
    if kind == "integer":
        return to_whole(c)
    if kind == "float":
        return to_double(c)
    if kind == "boolean":
        return to_bool(c)
    return c.cast("string")


def cast_canonical(staged: DataFrame, adapters: dict = ADAPTERS) -> DataFrame:
    """All canonical columns in their types; text that does not fit gives null."""
    return (with_utc(staged, TIME_COLUMNS, list(adapters.values()))
            .select([_typed(n, t).alias(n) for n, t, _ in CANONICAL]))


def drop_without(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is not null.

    Exploding a one-element array, or none, does what a null filter does, but the
    value is computed once: a filter would be pushed below the projection that
    computes it, and the whole time conversion would run twice per row. A CASE has
    generated code; a lambda (``array_compact``) has none and costs two copies of the row.
    """
    order = df.columns
    value = F.explode(F.when(F.col(column).isNotNull(), F.array(column))).alias(column)
    return df.select(*[c for c in order if c != column], value).select(*order)


def with_keys(df: DataFrame) -> DataFrame:
    """UTC date key and the UTC year and month a row is stored under."""
    ts = F.col("crash_timestamp_utc")
    return df.withColumns({"crash_date_key": F.to_date(ts), "year": F.year(ts),
                           "month": F.month(ts)})


def typed_rows(staged: DataFrame, adapters: dict = ADAPTERS) -> DataFrame:
    """Typed rows, without those that have no valid UTC time."""
    return with_keys(drop_without(cast_canonical(staged, adapters), "crash_timestamp_utc"))


def exclusion_counts(staged: DataFrame, adapters: dict = ADAPTERS) -> DataFrame:
    """Staged, curated and excluded rows per source, in one pass."""
    timed = with_utc(staged.select("source_id", "crash_timestamp_utc"), ["crash_timestamp_utc"],
                     list(adapters.values()))
    return (timed.groupBy("source_id")
            .agg(F.count("*").alias("staged_rows"),
                 F.count("crash_timestamp_utc").alias("curated_rows"))
            .withColumn("excluded_rows", F.col("staged_rows") - F.col("curated_rows")))


def write_staged(staged: DataFrame, path: str) -> str:
    """Replace the staged dataset of one source and batch."""
    staged.write.mode("overwrite").options(**_FILES).parquet(path)
    return path


def write_folders(parts: list[DataFrame], path: str, mode: str = "error") -> str:
    """A dataset laid out by source, year and month, of parts written one after the other.

    The rebalance hint brings a folder's rows together, so a small folder is
    one file, and lets the runtime split a source or month that holds most of
    the data over many tasks. A task has few folders and keeps their files open
    side by side: its rows need no sort, which would spill; only those of
    folders past the limit are sorted. What a part shuffled is gone before the
    next begins. Only the last one marks the dataset as complete.
    """
    spark = parts[0].sparkSession
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "32"), unshuffled(spark):
        for i, part in enumerate(parts):
            writer = part.hint("rebalance", *PARTITION_KEYS).write.mode("append" if i else mode).options(**_FILES)
            if i + 1 < len(parts):
                writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
            writer.partitionBy(*PARTITION_KEYS).parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, repeatable: bool = False) -> str:
    """Replace ``path`` with a dataset laid out by source, year and month.

    ``repeatable`` says that ``df`` gives the same rows each time: a large one is then written in rounds.
    """
    return write_folders(in_rounds(df, "source_record_id", rounds_for(df)) if repeatable else [df], path, "overwrite")


@dataclass(frozen=True)
class Candidate:
    """A written but not yet audited curated dataset."""
    run_id: str
    path: str
    staged_paths: dict
    batches: dict

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def summary(self, spark: SparkSession) -> DataFrame:
        """Per source: batch, staged, curated and excluded rows, and file count."""
        expected = expected_batches(spark, self)
        counts = (self.rows(spark).groupBy(F.col("source_id").cast("string").alias("source_id"))
                  .agg(F.count("*").alias("curated_rows")))
        files = (data_files(spark, self.path).groupBy("source_id")
                 .agg(F.count("*").alias("partition_files")))
        return (expected.join(F.broadcast(counts), "source_id", "left")
                .join(F.broadcast(files), "source_id", "left")
                .na.fill(0, ["curated_rows", "partition_files"])
                .withColumn("excluded_rows", F.col("staged_rows") - F.col("curated_rows"))
                .withColumn("curated_run_id", F.lit(self.run_id)))


def expected_batches(spark: SparkSession, candidate: Candidate) -> DataFrame:
    """source_id, batch_id and staged rows, counted anew from the staged files."""
    listed = spark.createDataFrame(sorted(candidate.batches.items()),
                                   "source_id string, batch_id string")
    staged = (read_staged(spark, candidate.staged_paths)
              .groupBy("source_id").agg(F.count("*").alias("staged_rows")))
    return listed.join(F.broadcast(staged), "source_id", "left").na.fill(0, ["staged_rows"])


def harmonize(spark: SparkSession, staged_paths: dict, batches: dict, target: str,
              adapters: dict = ADAPTERS) -> Candidate:
    """Exactly the given staged batches, as one typed and partitioned dataset.

    ``adapters`` (by source) say in which layout and zone a source writes its times; a source
    without one is an error, not a source in UTC.

    The batches come from the caller, never from what happens to be newest on
    disk; the target is a candidate until the audit has passed.
    """
    if set(staged_paths) != set(batches) or not batches:
        raise ValueError("one staged path and one batch per source are needed")
    if unknown := sorted(set(batches) - set(adapters)):
        raise ValueError(f"no adapter for {', '.join(unknown)}")
    write_partitioned(typed_rows(read_staged(spark, staged_paths), adapters), target, repeatable=True)
    return Candidate("curated_" + uuid.uuid4().hex[:12], target, dict(staged_paths), dict(batches))
