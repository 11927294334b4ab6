"""The same rows as CSV, JSON and Parquet: written, read back, sizes compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.sources.datasets import listing

FORMATS = ["csv", "json", "parquet"]


def write_as(df: DataFrame, fmt: str, path: str) -> str:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("quoteAll", True).option("escape", '"').option("nullValue", "\\N")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)
    return path


def read_as(spark: SparkSession, fmt: str, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "\\N").option("escape", '"')
    return reader.format(fmt).load(path)


def round_trip(df: DataFrame, root: str, max_rows: int | None = None,
               order: list[str] | None = None) -> dict[str, DataFrame]:
    """The slice read back from each format; fails when the slice is empty."""
    if max_rows is not None:
        df = df.orderBy(*(order or df.columns)).limit(max_rows)
    paths = {fmt: write_as(df, fmt, f"{root}/{fmt}") for fmt in FORMATS}
    out = {fmt: read_as(df.sparkSession, fmt, path, df.schema) for fmt, path in paths.items()}
    if out["parquet"].isEmpty():
        raise RuntimeError("the slice has no rows; pick a different partition")
    return out


def sizes(spark: SparkSession, root: str) -> DataFrame:
    """Bytes per format and their ratio to Parquet."""
    parts = None
    for fmt in FORMATS:
        one = listing(spark, f"{root}/{fmt}").agg(F.sum("length").alias("size_bytes")).select(
            F.lit(fmt).alias("format"), "size_bytes")
        parts = one if parts is None else parts.unionByName(one)
    base = parts.where("format = 'parquet'").select(F.col("size_bytes").alias("_p"))
    return parts.join(F.broadcast(base)).select(
        "format", "size_bytes", F.round(F.col("size_bytes") / F.col("_p"), 2).alias("relative_to_parquet"))
