"""Sharding by sampled splitters: equal bytes, contiguous key ranges. DataFrame functions only.

1. Keys are sampled with a chance in proportion to their row's size.
2. Quantiles of the sample cut the key space into ranges.
3. Ranges are measured exactly; those holding too many rows are subdivided by
   splitters sampled inside them, again and again, until none is overfull. A key with
   very many rows gets a range of its own, which is subdivided by row number.
4. Prefix sums over ranges and inside them place every row: shard ``s`` takes the rows
   whose bytes before them, in key order, fall in the ``s``-th part of all bytes. A range
   crossing the edge of a shard is thereby split at the exact row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfuse.llm.common import saved

FAN = 1024
RANGE_ROWS = 250_000
SAMPLE_PER_RANGE = 24
_LOWEST = -(1 << 63)
_HIGHEST = (1 << 63) - 1


def _search(key: Column, splitters: Column, n: int) -> Column:
    """How many of the ``n`` ascending ``splitters`` are at most ``key``.

    Looks at every ``step``-th splitter first, then at one block of ``step``.
    """
    step = max(1, math.isqrt(n))
    coarse = F.filter(splitters, lambda s, i: (i % step == step - 1) & (s <= key))
    block = F.size(coarse) * step
    return block + F.size(F.filter(F.slice(splitters, block + 1, step), lambda s: s <= key))


def _sampled(rows: DataFrame, key: Column, rate: Column, seed: int) -> DataFrame:
    u = F.pmod(F.xxhash64("row_no", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(u < rate).select("range", key.alias("key"))


def _quantiles(n: int) -> list[float]:
    return [i / n for i in range(1, n)]


def _parting(ascending: Column) -> Column:
    """Distinct splitters of ascending quantiles: a key that is more than one of them gets a range of its own.

    The next key becomes a splitter too, so that the hot key's range holds nothing else. Not more than there were quantiles.
    """
    hot = F.filter(ascending, lambda s, i: (i > 0) & (s == F.get(ascending, i - 1)) & (s < _HIGHEST))
    return F.array_sort(F.array_union(ascending, F.transform(hot, lambda s: s + 1)))


def assign_shards(rows: DataFrame, shards: int, key: str = "doc_id", size: str = "size",
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` plus ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless).

    ``key``: a long column, null sorts first. ``size``: a positive long; null counts as
    0. Every row is placed once; shards hold equal bytes to within one row at each edge
    and follow each other in key order; with few rows some shards stay empty. Ties and
    repeated rows are ordered by their row number, which follows the order of the input
    files. Other columns pass through; ``row_no``, ``range``, ``shard`` and ``slot`` are
    replaced if present.
    """
    own = {"row_no", "range", "shard", "slot", "_key", "_size"}
    kept = [c for c in rows.columns if c not in own]
    slim = rows.select(*kept, F.coalesce(F.col(key), F.lit(_LOWEST)).alias("_key"),
                       F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size"))
    slim = saved(slim.withColumn("row_no", F.monotonically_increasing_id())
                 .withColumn("range", F.lit(0).cast("long")), "shard-rows")
    ranges, slim = _subdivided(slim, range_rows)

    order = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = ranges.select(
        "range", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"))
    total = ranges.agg(F.sum("bytes").alias("total"))
    before = before.crossJoin(F.broadcast(total))  # a single row
    inside = W.partitionBy("range").orderBy("_key", "row_no")
    placed = slim.join(before, "range").select(
        "*", (F.col("rows_before") + F.row_number().over(inside) - 1).alias("_at"),
        (F.col("bytes_before") + F.sum("_size").over(inside.rowsBetween(W.unboundedPreceding, 0))
         - F.col("_size")).alias("_from"))
    # decimal: bytes times shards may pass the range of a long
    shard = F.floor(F.col("_from").cast("decimal(38,0)") * shards
                    / F.greatest(F.col("total"), F.lit(1))).cast("int")
    placed = saved(placed.select(*kept, F.least(shard, F.lit(shards - 1)).alias("shard"), "_at"), "shard-placed")
    starts = placed.groupBy("shard").agg(F.min("_at").alias("_start"))
    return (placed.join(F.broadcast(starts), "shard")
            .select(*kept, "shard", (F.col("_at") - F.col("_start")).alias("slot")))


def _subdivided(rows: DataFrame, range_rows: int) -> tuple[DataFrame, DataFrame]:
    """The measured ranges, and ``rows`` with ``range`` set so that none is overfull."""
    level = 0
    while True:
        ranges = saved(rows.groupBy("range").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_size").alias("bytes"),
            (F.min("_key") == F.max("_key")).alias("one_key")), f"shard-ranges-{level}")
        top = ranges.agg(F.max("n"), F.sum("n")).first()
        # The first level always cuts, so that small inputs are spread over tasks too.
        if top[0] is None or (level and top[0] <= range_rows):
            return ranges, rows
        fan = FAN if level else min(FAN, max(64, 2 * math.ceil(top[1] / range_rows)))
        wanted = ranges if not level else ranges.where(F.col("n") > range_rows)
        # A row's chance of being drawn, from the mean number drawn of its range.
        wanted = wanted.select("range", "one_key", (F.lit(float(fan * SAMPLE_PER_RANGE)) /
                                                    F.greatest(F.col("bytes"), F.lit(1))).alias("per_byte"))
        there = rows.join(wanted, "range")
        key = F.when(F.col("one_key"), F.col("row_no")).otherwise(F.col("_key"))
        drawn = _sampled(there, key, F.col("per_byte") * F.col("_size"), level)
        splitters = drawn.groupBy("range").agg(F.percentile_approx("key", _quantiles(fan), 20 * fan).alias("all")).select(
            "range", _parting(F.col("all")).alias("splitters"))
        splitters = saved(wanted.join(splitters, "range", "left").select(
            "range", "one_key", F.coalesce("splitters", F.array().cast("array<bigint>")).alias("splitters")),
            f"shard-splitters-{level}")
        sub = F.coalesce(_search(key, F.col("splitters"), fan), F.lit(0))
        rows = saved(rows.join(splitters, "range", "left").withColumn(
            "range", F.col("range") * FAN + sub).drop("one_key", "splitters"), f"shard-rows-{level}")
        level += 1


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law ``bytes``, shard, slot, grown_shard (null) of every document.

    Size: UTF-8 bytes of the text (null: none) plus 16. Documents with equal texts are
    placed like any others, by their doc_id. A null doc_id sorts first. An empty table
    gives an empty result.
    """
    slim = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return assign_shards(slim, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> str:
    """All columns of ``docs`` as Parquet below ``path``, one folder per shard, in slot order."""
    sized = docs.withColumn("size_", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long"))
    placed = assign_shards(sized, shards, size="size_").drop("size_")
    spread = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
    return path
