"""Which row wins when records come again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfuse.session import unshuffled

NATURAL_KEY = ["source_id", "source_record_id"]


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail when a batch holds a key twice: which copy should win is not defined."""
    again = df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    with unshuffled(df.sparkSession):
        repeated = not again.isEmpty()
    if repeated:
        raise ValueError(f"the batch repeats a key of {keys}")
    return df


def upsert(existing: DataFrame, incoming: DataFrame, now: Column | None = None,
           keys: list[str] | None = None) -> DataFrame:
    """Existing rows, those with an incoming key replaced; nothing is deleted.

    The anti join has no hint: a small batch of amendments is broadcast by its
    measured size, a full reload is merged by key.
    """
    keys = keys or NATURAL_KEY
    stamped = incoming.withColumn("ingested_at_utc", F.current_timestamp() if now is None else now)
    kept = existing.join(incoming.select(*keys), keys, "left_anti").select(*existing.columns)
    return kept.unionByName(stamped.select(*existing.columns))
