"""Mixing sources to target weights by pivotal dependent rounding.

Every document may be taken a fractional number of times, its source's target over its
source's size. Pairs of documents of one source pass word mass to each other at random, in
the one direction or the other with chances that leave each expected number of copies as
it is, until one of the two has a whole number; the other goes on to the next pair. Blocks
of documents are rounded apart, what each block leaves over meets in a reduction tree. A
source's taken words so differ from its target by part of one document at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfuse.llm.common import apart, n_words, saved

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 8192
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target from rows (source, source_size), one for each source.

    Sources by code point, null last, weigh ``weights`` over and over and share all words.
    A target stops at ``most`` times its source's size; the excess is shared again by weight,
    round by round, until no target is above its limit. Ranks are counted in key ranges.
    """
    rank = _dense_rank(sizes, F.col("source").asc_nulls_last())
    picked = F.array(*[F.lit(float(w)) for w in weights])
    rows = saved(rank.select("source", "source_size", (F.lit(float(most)) * F.col("source_size")).alias("limit"),
                             F.get(picked, (F.col("rank") % len(weights)).cast("int")).alias("weight")), "mix-weights")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level of words per weight only rises, and with it the sources at their limit
        full = F.col("limit") <= F.col("weight") * level
        fixed, free = rows.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)),
                               F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (total - fixed) / free
        if new <= level * (1 + 1e-12):
            break
        level = new
    return rows.select("source", "source_size", F.least("limit", F.col("weight") * level).alias("target"))


def _dense_rank(rows: DataFrame, order: Column) -> DataFrame:
    """``rows`` with ``rank`` from 0 in ``order``, without one task for all of them."""
    parts = saved(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1
    return parts.join(F.broadcast(before), "_part").withColumn(  # as many rows as partitions
        "rank", inside + F.col("_before")).drop("_part", "_before")


def _uniform(ids: np.ndarray, level: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each id, the same on every run."""
    x = ids.astype(np.uint64) + np.uint64((seed * 1_000_003 + level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def _pivot(share: np.ndarray, size: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Whole numbers for all of ``share`` (0 to 1) but one; which one, or -1.

    Rows are met in the given order. In each meeting words pass from one row to the
    other until either share is 0 or 1; sum(share * size) stays the same.
    """
    out, left = np.round(share), -1
    open_ = np.flatnonzero((share > _EPS) & (share < 1 - _EPS))
    p, w, draw = share.tolist(), size.tolist(), u.tolist()
    for j in open_.tolist():
        if left < 0:
            left = j
            continue
        i = left
        up = min((1 - p[i]) * w[i], p[j] * w[j])  # words i can take from j
        down = min(p[i] * w[i], (1 - p[j]) * w[j])  # words j can take from i
        moved = up if draw[j] * (up + down) < down else -down
        p[i] += moved / w[i]
        p[j] -= moved / w[j]
        left = -1
        for k in (i, j):
            if _EPS < p[k] < 1 - _EPS:
                left = k
            else:
                out[k] = round(p[k])
    if left >= 0:
        out[left] = p[left]
    return out, left


def _rounded(level: int, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "draw"], ascending=[False, True], kind="stable")
        share, size = rows["share"].to_numpy(), rows["size"].to_numpy(np.float64)
        out, left = _pivot(share, size, _uniform(rows["draw"].to_numpy(), level, seed))
        open_ = np.zeros(len(out), bool)
        if left >= 0:
            open_[left] = True
        return rows.assign(share=out, open=open_)
    return run


_UNIT = "unit bigint, draw bigint, source string, size bigint, block bigint, share double"


def rounded_shares(units: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """(unit, share 0 or 1) of rows (unit, draw, source, size > 0, share in 0 to 1).

    A unit is a long that no two rows share; a draw is a hash of the row's content, so that
    reruns agree whatever number a row gets. Level 0 rounds blocks of about ``block``
    units; every further level meets what is left of ``block`` blocks, until each source
    has one unit left, which is rounded to the nearer whole number.
    """
    counts = saved(units.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    rows = units.join(counts, units.source.eqNullSafe(counts.source)).select(
        "unit", "draw", units.source, "size", F.pmod(F.xxhash64("draw", F.lit(seed)), F.ceil(F.col("n") / block)).alias("block"),
        "share")
    settled, level, blocks = None, 0, max(1, math.ceil(most / block))
    while True:
        got = saved(rows.groupBy("source", "block").applyInPandas(_rounded(level, seed), _UNIT + ", open boolean"),
                    f"mix-level-{level}")
        done = got.where("NOT open").select("unit", "share")
        settled = done if settled is None else settled.union(done)
        rows = got.where("open").select("unit", "draw", "source", "size", F.floor(F.col("block") / block).alias("block"), "share")
        if blocks == 1:
            break
        level, blocks = level + 1, math.ceil(blocks / block)
    return settled.union(rows.select("unit", F.when(F.col("share") >= 0.5, 1.0).otherwise(0.0).alias("share")))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 0) -> DataFrame:
    """Of every row: doc_id, source, size, digest (of the text), source_size, target, copies.

    Rows alike in doc_id, source and text are told apart by nothing; they share one
    decision, and their sizes count together. A null source is a source of its own, the last
    one; a null or wordless text has size 0 and is taken as often as its source's share
    rounds down to. Nothing is taken from an empty table.
    """
    slim = saved(docs.select("doc_id", "source", n_words().alias("size"),
                             F.xxhash64(F.lit(1), "text").alias("digest")), "mix-sizes")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    unit = slim.groupBy("doc_id", "source", "digest").agg(F.sum("size").alias("mass"))
    unit = unit.join(targets, unit.source.eqNullSafe(targets.source)).select(
        "doc_id", unit.source, "digest", "mass", "source_size", "target",
        F.least(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)), F.lit(float(most))).alias("times"))
    whole = F.floor(F.col("times") + _EPS)
    unit = saved(unit.select("*", F.monotonically_increasing_id().alias("unit"),
                             F.xxhash64("doc_id", "source", "digest").alias("draw"), whole.alias("whole"),
                             F.greatest(F.col("times") - whole, F.lit(0.0)).alias("part")), "mix-units")
    rest = rounded_shares(unit.where("mass > 0").select("unit", "draw", "source", F.col("mass").alias("size"),
                                                        F.col("part").alias("share")), seed)
    decided = unit.join(rest, "unit", "left").select(
        "doc_id", "source", "digest", "source_size", "target",
        (F.col("whole") + F.coalesce("share", F.lit(0.0))).cast("long").alias("copies"))
    decided = saved(decided, "mix-copies")
    same = (F.col("s.doc_id").eqNullSafe(F.col("d.doc_id")) & F.col("s.source").eqNullSafe(F.col("d.source"))
            & (F.col("s.digest") == F.col("d.digest")))
    return slim.alias("s").join(decided.alias("d"), same).select(
        "s.doc_id", "s.source", "s.size", "s.digest", "source_size", "target", "copies")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) of every document."""
    return copies(docs).select("doc_id", "size", "source_size", "target",
                               (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, its columns unchanged."""
    return apart(docs, _repeated)


def _repeated(docs: DataFrame) -> DataFrame:
    wanted = copies(docs).where("copies > 0").select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), "digest", "copies").distinct()
    keyed = docs.withColumn("_digest", F.xxhash64(F.lit(1), "text"))
    same = (F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("_digest") == wanted.digest))
    return (keyed.join(wanted, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
