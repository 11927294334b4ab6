"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints link at 4 or fewer differing bits. Cut into three segments, one segment of a
linked pair differs by at most one bit, so the pair shares a variant: the segment with one
bit left out. Every fingerprint is indexed under its 64 variants; fingerprints under one
variant are compared bit by bit. A variant shared by more fingerprints than a task should
hold is indexed again by the variants of its remaining bits, level by level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import apart, saved, text_bytes
from wayfuse.operators.components import components

LINK_BITS = 4
SHINGLE = 4
BUCKET_ROWS = 4096
# Below this level at most 2**12 fingerprints can agree with a variant of every level above.
LAST_LEVEL = 7


def fingerprint(text: bytes, words_each: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's word shingles, signed; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    each = min(words_each, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - each + 1].tolist(),
                                                        ends[each - 1:].tolist())], dtype="<u8")
    by_byte = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _fingerprints(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(t, words_each) for t in batch.column("_text").to_pylist()]
            at = batch.schema.get_field_index("_text")
            columns = [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(got, pa.int64())]
            names = [n for n in batch.schema.names if n != "_text"] + ["fp"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def with_fingerprints(docs: DataFrame, *columns: str, words_each: int = SHINGLE) -> DataFrame:
    """The named columns and ``fp``, the signed 64-bit fingerprint of ``text``."""
    slim = docs.select(*columns, text_bytes().alias("_text"))
    kinds = ", ".join([f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns] + ["fp bigint"])
    return slim.mapInArrow(_fingerprints(words_each), kinds)


# ---- links -----------------------------------------------------------------------------

def _segments(bits: list[int]) -> list[list[int]]:
    """Three nearly equal runs of bit positions: four differing bits leave one with at most one."""
    n = len(bits)
    cuts = [0, -(-n // 3), -(-2 * n // 3), n]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _variants(segments: list[list[int]]) -> list[tuple[int, int, int]]:
    """(segment, bit left out, mask of what stays) of every variant."""
    return [(k, b, _mask(seg) ^ (1 << b)) for k, seg in enumerate(segments) for b in seg]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _forest(key: np.ndarray, fp: np.ndarray, agreed: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside runs of equal ``key`` that join every linked pair, without those that close a ring.

    Compares each row with the next one of its run, then with the one after, and so on;
    rows already joined are not compared. Pairs that also share an earlier variant of the first
    level are left to that one (``agreed`` holds the variant, or -1).
    """
    label = np.arange(len(key))
    at, found, step = np.arange(len(key)), [], 0
    while True:
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            return found
        open_ = at[label[at] != label[at + step]]
        x = fp[open_] ^ fp[open_ + step]
        near = np.bitwise_count(x) <= LINK_BITS
        open_, x = open_[near], x[near]
        first = agreed[open_] < 0
        if not first.all():
            first |= _first_variant(x) == agreed[open_]
        open_ = open_[first]
        if not len(open_):
            continue
        found.append((fp[open_], fp[open_ + step]))
        while True:  # hook the larger label under the smaller, then shorten the paths
            a, b = label[open_], label[open_ + step]
            differ = a != b
            if not differ.any():
                break
            np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up


_FIRST = _segments(list(range(64)))
_FIRST_VARIANTS = _variants(_FIRST)


def _first_variant(x: np.ndarray) -> np.ndarray:
    """The first variant (its number) under which two fingerprints with this difference meet."""
    out = np.full(len(x), -1)
    for seg in reversed(_FIRST):
        d = x & np.uint64(_mask(seg))
        n = np.bitwise_count(d)
        where = np.where(n == 0, seg[0], np.bitwise_count(d - np.uint64(1)))  # the bit, if only one differs
        out = np.where(n <= 1, where, out)
    return out


def _compared(level: int):
    """Reads rows (key, path, fp) sorted by key; gives links (kind 0) and the rows of overfull keys (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, over_key = np.empty((0, 3), np.int64), None
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "path", "fp")])
            if over_key is not None:  # the rest of a key already given back
                more = int(np.searchsorted(rows[:, 0], over_key, side="right"))
                if more:
                    yield _answer(1, rows[:more])
                rows = rows[more:]
            if not len(rows):
                continue
            rows, over_key = np.concatenate([held, rows]), None
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            yield from _settled(rows[:cut], level)
            held = rows[cut:].copy()
            if len(held) > BUCKET_ROWS and level < LAST_LEVEL:
                yield _answer(1, held)
                held, over_key = held[:0], held[0, 0]
        yield from _settled(held, level)
    return run


def _answer(kind: int, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), kind, np.int32)), *(pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3))],
        ["kind", "key", "path", "fp"])


def _settled(rows: np.ndarray, level: int) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    key = rows[:, 0]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n = np.diff(np.r_[new, len(key)])
    large = np.repeat((n > BUCKET_ROWS) & (level < LAST_LEVEL), n)
    if large.any():
        yield _answer(1, rows[large])
    rows = rows[~large]
    key, fp = np.ascontiguousarray(rows[:, 0]), np.ascontiguousarray(rows[:, 2]).view(np.uint64)
    agreed = key & 63 if level == 0 else np.full(len(key), -1)
    for a, b in _forest(key, fp, agreed):
        yield _answer(0, np.column_stack([a.view(np.int64), np.zeros(len(a), np.int64), b.view(np.int64)]))


def _left(path: int, level: int) -> list[int]:
    """The bits outside the segments chosen so far; ``path`` has a base-3 digit for each level."""
    bits = list(range(64))
    for up in range(level):
        chosen = set(_segments(bits)[path // 3 ** up % 3])
        bits = [b for b in bits if b not in chosen]
    return bits


def _indexed(level: int):
    """Rows (key, path, fp) to one row for each variant of the bits that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "path", "fp")])
            for start in range(0, len(every), 4096):
                part = every[start:start + 4096]
                for path in np.unique(part[:, 1]).tolist():
                    rows = part[part[:, 1] == path]
                    key, fp = rows[:, 0].astype(np.uint64), np.ascontiguousarray(rows[:, 2]).view(np.uint64)
                    for number, (segment, _, mask) in enumerate(_variants(_segments(_left(path, level)))):
                        mixed = _mixed(_mixed(key + np.uint64(number + 1)) ^ (fp & np.uint64(mask)))
                        mixed = (mixed & ~np.uint64(63)) | np.uint64(number)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(mixed.view(np.int64)), pa.array(np.full(len(fp), path + segment * 3 ** level)),
                             pa.array(fp.view(np.int64))], ["key", "path", "fp"])
    return run


_ROWS = "key bigint, path bigint, fp bigint"


def links(fps: DataFrame) -> DataFrame:
    """``a``, ``b``: edges that join all distinct values of ``fp`` linked at 4 or fewer bits.

    Two fingerprints are in one component of these edges exactly if a chain of linked
    ones joins them; of many links inside one variant only a spanning forest is given.
    """
    rows = fps.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("path"), "fp").distinct()
    found, level = None, 0
    while True:
        keyed = rows.mapInArrow(_indexed(level), _ROWS).repartition("key").sortWithinPartitions("key")
        got = saved(keyed.mapInArrow(_compared(level), "kind int, " + _ROWS), f"simhash-{level}")
        part = got.where("kind = 0").select(F.col("key").alias("a"), F.col("fp").alias("b"))
        found = part if found is None else found.union(part)
        rows, level = got.where("kind = 1").select("key", "path", "fp"), level + 1
        if rows.isEmpty():
            return found


def near_groups(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """doc_id, fp, component_id (the smallest id in the group) of every row of ``docs``.

    Null texts, and texts without a word, have the fingerprint zero and link like others. A
    null id keeps its row, and is a group's id only if all its ids are null. Repeated rows
    stay repeated. An empty table gives no rows.
    """
    return _grouped(docs, id_column).select(id_column, "fp", "component_id")


def _grouped(docs: DataFrame, id_column: str, words_each: int = SHINGLE) -> DataFrame:
    """``near_groups`` and ``component``, the group's own key: groups can share their smallest id."""
    slim = saved(with_fingerprints(docs.select(F.col(id_column).alias("_id"), "text"), "_id", words_each=words_each), "fingerprints")
    classes = saved(slim.groupBy("fp").agg(F.min("_id").alias("least")), "fingerprint-classes")
    joined = components(links(classes), "a", "b")
    member = classes.join(joined, classes.fp == joined.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    table = saved(member.join(least, "component").select("fp", "component", "component_id"), "fingerprint-groups")
    return slim.join(table, "fp").select(F.col("_id").alias(id_column), "fp", "component", "component_id")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of every document."""
    return near_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words_each: int = SHINGLE) -> DataFrame:
    """``docs`` without the near-duplicates: of each group the row with the smallest doc_id stays.

    All columns are kept as they are. A group is known by its fingerprints, not by its smallest id: of rows
    that share a doc_id, or have none, each group keeps its own. Where several rows of a group carry its
    smallest id, the one with the least digest of the text stays. A row without an id stays only if no row of
    its group has one.
    """
    def step(rows: DataFrame) -> DataFrame:
        return one_of_each_group(rows, _grouped(rows.select("doc_id", "text"), "doc_id", words_each),
                                 lambda some, *columns: with_fingerprints(some, *columns, words_each=words_each))
    return apart(docs, step)


def one_of_each_group(docs: DataFrame, grouped: DataFrame, keyed: Callable[..., DataFrame]) -> DataFrame:
    """Of each group in ``grouped`` (doc_id, fp, component, component_id of every row) one row of ``docs``.

    ``keyed`` gives rows with the named columns and ``fp``, which tells the rows that share an id apart. What goes is
    named, not what stays: the shorter list, which a join broadcasts while its written size allows.
    """
    groups = saved(grouped, "near-groups")
    per_id = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("component_id").alias("component_id"))
    shared = saved(per_id.where("n > 1").select(F.col("doc_id").alias("_shared")), "shared-ids")
    gone = saved(per_id.where("n = 1 AND NOT doc_id <=> component_id").select(F.col("doc_id").alias("_gone")), "gone-ids")
    is_shared = F.col("doc_id").eqNullSafe(F.col("_shared"))
    plain = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti").join(shared, is_shared, "left_anti")
    # the rows that share their id: their keys again, to know each row's group
    some = docs.join(shared, is_shared, "left_semi").withColumn("_digest", F.xxhash64("text"))
    prints = keyed(some.select(F.col("doc_id").alias("_doc"), "_digest", "text"), "_doc", "_digest")
    of_group = groups.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "component", "component_id").distinct()
    best = (prints.join(of_group, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")))
            .where("_doc <=> component_id").groupBy("component")
            .agg(F.min("_digest").alias("_best"), F.min("_doc").alias("_least")))
    best = best.withColumnRenamed("component", "_group")
    rows = some.join(best, F.col("doc_id").eqNullSafe(F.col("_least")) & (F.col("_digest") == F.col("_best")))
    return plain.unionByName(rows.dropDuplicates(["_group"]).select(*docs.columns))
