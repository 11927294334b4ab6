"""Row numbers over a whole table without one task that holds all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.session import saved


def ranked(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``rows`` plus their place from 0 in ``order``.

    Rows are dealt out by ranges of the order, written, numbered inside each range, and moved
    up by the counts of the ranges before it: one number for each partition.
    """
    parts = saved(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (parts.join(F.broadcast(before), "_part")  # as many rows as partitions
            .withColumn(name, inside + F.col("_before")).drop("_part", "_before"))
