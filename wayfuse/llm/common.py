"""Helpers the operators share: session settings, word counts, cut lineage, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.session import prepare, saved

__all__ = ["prepare", "saved", "documents", "table", "text_bytes", "n_words", "batches_by_bytes", "settings", "free_name", "apart"]

WORD = r"[^\x20\x09-\x0D]+"

# Python workers share an executor's memory with its heap: batches are kept small.
_ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def settings(spark: SparkSession) -> SparkSession:
    """The library's runtime settings plus the size of Arrow batches."""
    prepare(spark)
    for key, value in _ARROW.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_bytes(text: str | Column = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("binary"), F.lit(b""))


def n_words(text: str | Column = "text") -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def apart(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` of ``docs`` while all columns but those of documents have names no step uses; it gives the same columns."""
    own = ("doc_id", "text", "lang", "source", "n_chars")
    names = [c if c in own else f"_extra_column_{i}" for i, c in enumerate(docs.columns)]
    return step(docs.toDF(*names)).select(*names).toDF(*docs.columns)


def batches_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """Tables of consecutive batches whose ``column`` holds about ``most`` bytes or less.

    A batch is never dropped or cut below one row: a text above the limit makes a
    table of its own.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > most:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i
            size += n
        if len(lengths) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
