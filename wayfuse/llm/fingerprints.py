"""One-permutation MinHash fingerprints with optimal densification. DataFrame functions only.

Every word shingle is hashed once; the top bits of the hash name its bin, a bin keeps its least
hash. An empty bin takes the value of another one, probed in an order that depends on the empty
bin's number alone: ``PROBES`` fixed hash functions first, then the filled bins by a hash of
both numbers, so every bin is filled in the end. Of each value the low byte is stored;
equal bytes by chance are taken off the likeness.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfuse.llm.sharding import _search

BIN_BITS = 8
BINS = 1 << BIN_BITS
SHINGLE = 5
PROBES = 8
RANGE_ROWS = 2000
MOST_RANGES = 4096
_VALUE_BITS = 64 - BIN_BITS
_MASK = (1 << _VALUE_BITS) - 1
_LOWEST = -(1 << 63)


def _constant(values: list, kind: str) -> Column:
    """A list as one literal: parsed while planning, not for each row."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _probe(i: int, r: int) -> int:
    x = (i * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03 + 1) & (1 << 64) - 1
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & (1 << 64) - 1
    return (x ^ x >> 31) % BINS


def _probed(value: Column, kept: Column, probes: Column) -> Column:
    return F.transform(value, lambda x, i: F.coalesce(x, F.get(kept, F.get(probes, i))))


def with_signature(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` plus ``out``: BINS signed bytes of the text's signature; null without a word.

    Shingles of five words; a shorter text is one shingle of all its words.
    """
    words, shingles, least, kept, filled = (f"_{x}_{out}" for x in ("words", "shingles", "least", "kept", "filled"))
    step = docs.withColumn(words, F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                                              lambda w: F.xxhash64(w)))
    shingle = F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(
        *[F.get(F.col(words), i + j) for j in range(SHINGLE)]))
    whole = F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(words)))
    step = step.withColumn(shingles, F.when(F.size(words) >= SHINGLE, shingle).otherwise(whole))
    # one more value in each bin, above all others, so that every bin has a first one
    top = _constant([(b << _VALUE_BITS) | _MASK for b in range(-BINS // 2, BINS // 2)], "bigint")
    step = step.withColumn(least, F.sort_array(F.concat(shingles, top)))
    bin_of = lambda x: F.shiftright(x, _VALUE_BITS)
    first = F.filter(F.col(least), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(least), i - 1))))
    step = step.withColumn(kept, F.transform(first, lambda x: F.when(x.bitwiseAND(F.lit(_MASK)) != F.lit(_MASK), x)))
    step = step.withColumn(filled, F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)),
                                            lambda b: F.get(F.col(kept), b).isNotNull()))
    value = F.col(kept)
    for r in range(PROBES):
        value = _probed(value, F.col(kept), _constant([_probe(i, r) for i in range(BINS)], "int"))
    donor = lambda i: F.array_min(F.transform(F.col(filled), lambda d: F.struct(
        F.xxhash64(i, d).alias("h"), F.get(F.col(kept), d).alias("v"))))["v"]
    low = lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("tinyint")
    signature = F.transform(value, lambda x, i: low(F.coalesce(x, donor(i))))
    return step.withColumn(out, F.when(F.size(filled) > 0, signature)).drop(words, shingles, least, kept, filled)


def as_text(signature: str | Column) -> Column:
    """The packed bytes as lowercase hex digits; zeros without a word."""
    signature = F.col(signature) if isinstance(signature, str) else signature
    digits = _constant([f"{b:02x}" for b in range(256)], "string")
    return F.coalesce(F.array_join(F.transform(signature, lambda x: F.get(digits, x.cast("int") + 128)), ""),
                      F.lit("00" * BINS))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard likeness of two texts' shingles, 0 to 1; two texts without a word are alike."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0),
                       lambda n, i: n + F.when(F.get(a, i) == F.get(b, i), 1).otherwise(0))
    chance = 1 / 256
    corrected = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)


def _with_next(docs: DataFrame, key: str, tie: str, *columns: str) -> DataFrame:
    """``docs`` plus ``next_<column>`` of the row after it in falling order of ``key``; the last is followed by the first.

    Keys are cut into ranges at quantiles. The first row of each range also goes, marked as a
    guest, to the range before it, where it follows the last row. Rows move once.
    """
    counted = docs.agg(F.count(F.lit(1)).alias("n")).first().n
    ranges = max(1, min(MOST_RANGES, math.ceil(counted / RANGE_ROWS)))
    cuts = docs.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)] or [0.5], 20 * ranges)).first()[0] or []
    cuts = sorted(set(cuts)) if ranges > 1 else []
    where = _search(F.col(key), _constant(cuts, "bigint"), len(cuts)) if cuts else F.lit(0)
    placed = docs.withColumn("_range", where.cast("int"))
    # at most MOST_RANGES rows: the first key of each range that is not empty
    heads = {r["_range"]: r.head for r in placed.groupBy("_range").agg(F.max(key).alias("head")).collect()}
    full = sorted(heads)
    host = dict(zip(full, full[1:] + full[:1]))  # the range before it in falling order; the lowest hosts the first of all
    every = range(max(full, default=0) + 1)
    head = F.get(_constant([heads.get(r, 0) for r in every], "bigint"), F.col("_range"))
    to = F.get(_constant([host.get(r, 0) for r in every], "int"), F.col("_range"))
    seat = lambda r, own: F.struct(r.alias("range"), F.lit(own).alias("own"))
    seats = F.when(F.col(key) == head, F.array(seat(F.col("_range"), True), seat(to, False))).otherwise(
        F.array(seat(F.col("_range"), True)))
    seated = placed.withColumn("_seat", F.explode(seats)).select("*", "_seat.range", "_seat.own").drop("_seat", "_range")
    order = W.partitionBy("range").orderBy(F.desc("own"), F.desc(key), tie)
    for c in columns:
        seated = seated.withColumn(f"next_{c}", F.lead(c).over(order))
    return seated.where("own").drop("range", "own")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    Null texts are empty. Documents follow each other by falling doc_id, null last, those that
    share one by a hash of their text; a lone document follows itself. Rows that repeat stay.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"),
                      F.coalesce("doc_id", F.lit(_LOWEST)).alias("key"))
    own = with_signature(own.withColumn("tie", F.xxhash64("body")), "body", "signature")
    both = _with_next(own, "key", "tie", "body", "signature").drop("key", "tie")
    n = F.length("body")
    last = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("body").substr(F.lit(1), n - last), F.col("next_body").substr(F.lit(1), last))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature")
    both = with_signature(both, "edited", "edited_signature")
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("signature").alias("fingerprint"), as_text("edited_signature").alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
