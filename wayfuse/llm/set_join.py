"""Documents whose sets of word shingles are alike (Jaccard), by T-occurrence search.

* Equal sets are one class. In a fixed order of all shingles, two linked classes share some of their first ones
  (a fifth to a quarter of a set): these alone are posted. A class with fewer shared ones than any partner needs goes.
* All classes that post a shingle meet under the shingle's pivot, the least of them. So a near copy meets the others
  of its kind under few pivots, not under each shingle. Linked classes share a tenth of their sizes there: each may
  leave the pivots that hold less than half of that share, and still meets its partners under another.
* Each class is first compared with one centre, that of its largest pivot, which ties most near copies together by
  as many comparisons as there are classes. Pivots whose classes are one component by then are done.
* Under the others, classes of different components are searched: the inverted lists of a query's shingles are
  divided (DivideSkip); the short ones are merged by a heap, the long ones probed by binary search for
  what the merge found often enough, and classes that reach the overlap their sizes require are linked. A
  pivot with many classes is dealt out as pairs of blocks; blocks of one component are not paired.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wayfuse.llm.common import apart, saved, text_bytes
from wayfuse.llm.simhash import one_of_each_group
from wayfuse.operators.components import components
from wayfuse.session import dropped

SHINGLE, PERCENT = 5, 80
SPARE_SHARE = 10  # per cent of a set's size, see ``spare``
BLOCK_SETS = 512  # classes of a block; pairs of blocks are a task's work
FILTER_BITS = 1 << 25  # of the filter that spares most texts the way to the join
_SEEN = 50_000
_WORDS = 100_000
_MU = 0.0005  # cost of a probe against a merge step: all long lists are probed at once


# ---- sets ------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted 64-bit hashes of the distinct shingles of a text; words' hashes are kept for the next texts."""

    def __init__(self, words_each: int):
        self.each, self.known = words_each, {}

    def of(self, text: bytes) -> np.ndarray:
        known, digest = self.known, xxhash.xxh3_64_intdigest
        if len(known) > _WORDS:
            known.clear()
        words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
        for w in words:
            if w not in known:
                known[w] = digest(w)
        h = np.array([known[w] for w in words], np.uint64)
        each = min(self.each, len(h))
        if not each:
            return h
        out = np.full(len(h) - each + 1, each, np.uint64)
        for k in range(each):
            out = _mixed(out + h[k:len(h) - each + 1 + k])
        return np.unique(out)


def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` shares with any partner at least."""
    return -(-n * percent // 100)


def spare(n):
    """Shared shingles by which the posted part of a set is longer than one shared shingle would need."""
    return max(1, n * SPARE_SHARE // 100)


def posted(n: int, percent: int) -> int:
    """How many of its first shingles a set of ``n`` posts: two linked sets share ``spare`` of the smaller at least."""
    return min(n, n - least_overlap(n, percent) + spare(n))


def _summaries(words_each: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words_each), set()
        for batch in batches:
            n, classes, numbers, first = [], [], [], []
            for text in batch.column("_text").to_pylist():
                own = shingles.of(text)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                n.append(len(own))
                classes.append(digest)
                numbers.append(int.from_bytes(digest[:8], "little", signed=True))
                again = digest in seen
                if not again:
                    if len(seen) > _SEEN:
                        seen.clear()
                    seen.add(digest)
                first.append(None if again else own[:posted(len(own), percent)].view(np.int64))
            at = batch.schema.get_field_index("_text")
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n, pa.int64()), pa.array(classes, pa.binary()), pa.array(numbers, pa.int64()),
                 pa.array(first, pa.list_(pa.int64()))], [*names, "n", "cls", "number", "first"])
    return run


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each key in the filter."""
    mixed = _mixed(keys.view(np.uint64))
    return (mixed % np.uint64(FILTER_BITS)).astype(np.int64), ((mixed >> np.uint64(32)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.unique(np.concatenate(_bits(batch.column("text_key").to_numpy(zero_copy_only=False).astype(np.int64))))
        yield pa.RecordBatch.from_arrays([pa.array(places >> 5), pa.array(np.int64(1) << (places & 31))], ["word", "mask"])


def _filter(keys: DataFrame) -> bytes:
    """A Bloom filter of ``text_key``: of fixed size, however many keys there are."""
    words = keys.mapInArrow(_marked, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    held = np.zeros(FILTER_BITS // 32, "<u4")
    held[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    return held.tobytes()


def _sets(words_each: int, wanted: bytes):
    """Sets of the texts the filter lets pass: all that are wanted, and a few more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, held_bits = Shingles(words_each), set(), np.frombuffer(wanted, "<u4")
        for batch in batches:
            at, also = _bits(batch.column("text_key").to_numpy(zero_copy_only=False).astype(np.int64))
            passes = ((held_bits[at >> 5] >> (at & 31).astype(np.uint32)) & (held_bits[also >> 5] >> (also & 31).astype(np.uint32)) & 1) == 1
            classes, held = [], []
            for text in batch.column("_text").filter(pa.array(passes)).to_pylist():
                own = shingles.of(text)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                if digest not in seen:
                    if len(seen) > _SEEN:
                        seen.clear()
                    seen.add(digest)
                    classes.append(digest)
                    held.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(held, pa.binary())], ["cls", "held"])
    return run


# ---- comparisons -----------------------------------------------------------------------

def _alike(overlap: int, n: int, m: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


def _starred(percent: int):
    """Rows (cls, held, centre, centre_held): the pairs that are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, own, y, other in zip(*(batch.column(c).to_pylist() for c in ("cls", "held", "centre", "centre_held"))):
                n, m = len(own) // 8, len(other) // 8
                if 100 * min(n, m) >= percent * max(n, m) and _alike(
                        len(np.intersect1d(np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64), assume_unique=True)),
                        n, m, percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    return run


class Lists:
    """Inverted lists of sets, each ascending; sets are numbered by size, so a range of sizes is a slice of a list."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.count = len(sets)
        owner = np.repeat(np.arange(self.count), self.size)
        self.tokens, token = np.unique(np.concatenate(sets), return_inverse=True)
        self.at = np.sort(token.astype(np.int64) * self.count + owner)  # (list, set) as one number

    def search(self, own: np.ndarray, percent: int, skip) -> Iterator[int]:
        """Numbers of the sets linked with ``own``; those for which ``skip`` holds are not looked at."""
        n = len(own)
        least = least_overlap(n, percent)
        low = int(np.searchsorted(self.size, least))
        high = int(np.searchsorted(self.size, 100 * n // percent, side="right"))
        if low >= high:
            return
        where = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
        where = where[self.tokens[where] == own] * self.count
        begin, end = np.searchsorted(self.at, where + low), np.searchsorted(self.at, where + high)
        some = end > begin
        where, begin, end = where[some], begin[some], end[some]
        if len(where) < least:
            return
        order = np.argsort(begin - end, kind="stable")  # the longest lists first
        longest = int((end - begin)[order[0]])
        long = min(least - 1, int(least / (_MU * math.log2(longest + 1) + 1)))
        short = order[long:]
        probed = where[order[:long]]
        lists = [(self.at[b:e] - w).tolist() for w, b, e in zip(where[short].tolist(), begin[short].tolist(), end[short].tolist())]
        last, times, wanted = -1, 0, least - long
        for s in heapq.merge(*lists, (self.count,)):
            if s == last:
                times += 1
                continue
            if times >= wanted and not skip(last):
                overlap = times
                if long:
                    at = np.searchsorted(self.at, probed + last)
                    overlap += int((self.at[np.minimum(at, len(self.at) - 1)] == probed + last).sum())
                if _alike(overlap, n, int(self.size[last]), percent):
                    yield last
            last, times = s, 1


def linked(sets: list[np.ndarray], sides: list, labels: list, percent: int) -> list[tuple[int, int]]:
    """Links that join all linked sets of one task, but those that ``labels`` or links found before join already.

    With two sides only pairs of unlike sides are compared, with one all pairs.
    """
    number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    top = list(range(len(number)))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    own = [number[x] for x in labels]
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    kinds = sorted(set(sides))
    if len(kinds) == 2:  # the smaller side asks
        asking = min(kinds, key=lambda k: (sides.count(k), k))
        asked = [i for i in order if sides[i] != asking]
        order = [i for i in order if sides[i] == asking]
    else:
        asked = order
    lists, found = Lists([sets[i] for i in asked]), []
    for i in order:
        for s in lists.search(sets[i], percent, lambda s: root(own[asked[s]]) == root(own[i])):
            j = asked[s]
            if root(own[i]) != root(own[j]):
                found.append((i, j))
                top[root(own[i])] = root(own[j])
    return found


def _searched(percent: int):
    """Rows (task, side, cls, label, held), those of one task side by side: links (a, b)."""
    def answer(rows: list[dict]) -> pa.RecordBatch:
        pairs = linked([np.frombuffer(r["held"], np.uint64) for r in rows], [r["side"] for r in rows],
                       [r["label"] for r in rows], percent)
        return pa.RecordBatch.from_arrays([pa.array([rows[i]["cls"] for i, _ in pairs], pa.binary()),
                                           pa.array([rows[j]["cls"] for _, j in pairs], pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["task"] != rows[0]["task"]:
                    yield answer(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield answer(rows)
    return run


# ---- join ------------------------------------------------------------------------------

_EDGES = "a binary, b binary"


def _summary(docs: DataFrame, words_each: int, percent: int) -> DataFrame:
    """doc_id, text_key, n, cls (the set's digest), number (64 bits of it), first (posted shingles; null if posted before)."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("_text")).withColumn(
        "text_key", F.xxhash64("_text"))
    return saved(slim.mapInArrow(_summaries(words_each, percent),
                                 "doc_id bigint, text_key bigint, n bigint, cls binary, number bigint, first array<bigint>"), "sets-posted")


def _classes(summary: DataFrame) -> DataFrame:
    """cls, number, n, least (its smallest doc_id), text_key (of one of its texts): a row for each set that is not empty."""
    return saved(summary.where("n > 0").groupBy("cls", "number").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("least"), F.min("text_key").alias("text_key")), "set-classes")


def _meetings(summary: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """pivot, number, times, centre: classes that may have partners, under each pivot they cannot leave."""
    posts = (summary.where("first IS NOT NULL").select(F.explode("first").alias("token"), "number")
             .repartition("token").dropDuplicates(["token", "number"]))
    own = W.partitionBy("token")
    shared = (posts.withColumn("pivot", F.min("number").over(own)).withColumn("_top", F.max("number").over(own))
              .where("pivot < _top").groupBy("number", "pivot").agg(F.count(F.lit(1)).alias("times")))
    shared = saved(shared, "sets-shared")
    # what any partner shares with a class of this size: the spare part of the smallest partner
    sizes = classes.groupBy("number").agg(F.max("n").alias("n")).select(
        "number", F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) * SPARE_SHARE / 100)).alias("least"))
    rising = W.partitionBy("number").orderBy("times", "pivot").rowsBetween(W.unboundedPreceding, W.currentRow)
    kept = (shared.join(sizes, "number").withColumn("_all", F.sum("times").over(W.partitionBy("number")))
            .where(F.col("_all") >= F.col("least")).withColumn("_upto", F.sum("times").over(rising))
            .where(2 * F.col("_upto") >= F.col("least")).select("number", "pivot", "times"))
    kept = saved(kept, "sets-meeting")
    groups = kept.groupBy("pivot").agg(F.min("number").alias("centre"), F.max("number").alias("_top")).where("centre < _top")
    return saved(kept.join(groups.select("pivot", "centre"), "pivot"), "sets-meetings")


def _held(docs: DataFrame, classes: DataFrame, meetings: DataFrame, words_each: int) -> DataFrame:
    """number, cls, held: the whole sets of the classes that meet others, one row a class."""
    wanted = saved(classes.join(meetings.select("number").distinct(), "number", "left_semi").select("cls", "number", "text_key"), "sets-wanted")
    texts = docs.select(text_bytes().alias("_text")).withColumn("text_key", F.xxhash64("_text"))
    held = texts.mapInArrow(_sets(words_each, _filter(wanted.select("text_key"))), "cls binary, held binary")
    return saved(held.join(wanted.select("cls", "number"), "cls").groupBy("cls", "number").agg(F.first("held").alias("held")), "sets-held")


def _tasks(members: DataFrame, block_sets: int) -> DataFrame:
    """task, side, cls, label: what each pair of blocks under a pivot holds.

    ``members`` has pivot, cls, label. A component with more classes than a block holds has blocks of its own.
    """
    counts = saved(members.groupBy("pivot", "label").agg(F.count(F.lit(1)).alias("m")), "sets-labels")
    large = F.col("m") > block_sets
    pooled = counts.where(~large).groupBy("pivot").agg(F.lit(None).cast("binary").alias("of"), F.sum("m").alias("m"))
    parts = pooled.unionByName(counts.where(large).select("pivot", F.col("label").alias("of"), "m")).select(
        "pivot", "of", F.ceil(F.col("m") / block_sets).cast("int").alias("parts"))
    parts = saved(parts, "sets-parts")
    name = F.concat_ws(":", F.coalesce(F.hex("of"), F.lit("")), "part")
    blocks = parts.select("pivot", "of", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        "pivot", "of", name.alias("side"))
    x, y = blocks.select("pivot", F.col("of").alias("x_of"), F.col("side").alias("x")), blocks.select(
        "pivot", F.col("of").alias("y_of"), F.col("side").alias("y"))
    pairs = x.join(y, "pivot").where("x <= y AND (x_of IS NULL OR NOT x_of <=> y_of)")
    task = F.concat_ws("|", F.col("pivot"), "x", "y")
    work = saved(pairs.select("pivot", task.alias("task"), F.explode(F.array_distinct(F.array("x", "y"))).alias("side")), "sets-tasks")
    own = F.when(F.col("m") > block_sets, F.col("label"))
    placed = (members.join(counts, ["pivot", "label"]).withColumn("of", own)
              .join(parts.withColumnsRenamed({"pivot": "_pivot", "of": "_of"}),
                    (F.col("pivot") == F.col("_pivot")) & F.col("of").eqNullSafe(F.col("_of")))
              .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts"))).withColumn("side", name))
    return placed.join(work, ["pivot", "side"]).select("task", "side", "cls", "label")


def links(docs: DataFrame, summary: DataFrame, classes: DataFrame, words_each: int = SHINGLE, percent: int = PERCENT,
          block_sets: int = BLOCK_SETS) -> DataFrame:
    """``a``, ``b``: links between classes that join all classes a chain of links joins."""
    meetings = _meetings(summary, classes, percent)
    held = _held(docs, classes, meetings, words_each)
    centres = held.select(F.col("number").alias("centre"), F.col("cls").alias("_centre"), F.col("held").alias("centre_held"))
    best = meetings.where("number <> centre").groupBy("number").agg(F.max_by("centre", F.struct("times", "centre")).alias("centre"))
    compared = (best.join(held, "number")
                .join(centres, "centre").select("cls", "held", F.col("_centre").alias("centre"), "centre_held"))
    stars = saved(compared.mapInArrow(_starred(percent), _EDGES), "sets-stars")
    joined = saved(components(stars, "a", "b"), "sets-joined")
    known = (meetings.select("pivot", "number").join(held.select("number", "cls"), "number")
             .join(joined, F.col("cls") == F.col("node"), "left")
             .select("pivot", "cls", F.coalesce("component", "cls").alias("label")))
    known = saved(known, "sets-known")
    several = known.groupBy("pivot").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high")
    members = saved(known.join(several.select("pivot"), "pivot", "left_semi"), "sets-open")
    work = _tasks(members, block_sets).join(held.select("cls", "held"), "cls")
    found = (work.select("task", "side", "cls", "label", "held").repartition("task").sortWithinPartitions("task")
             .mapInArrow(_searched(percent), _EDGES))
    found = saved(found, "sets-found")
    for part in (held, meetings, known, members):  # as large as the sets, and read by nothing else
        dropped(part)
    return found.union(joined.select(F.col("node").alias("a"), F.col("component").alias("b")))


def near_sets(docs: DataFrame, words_each: int = SHINGLE, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Rows link where 100 x common shingles >= ``percent`` x all their shingles. A text of fewer words is
    one shingle; null and wordless texts have none, link with nothing and stand alone under their id.
    A component's id is its smallest doc_id, null only if all its ids are. Repeated rows are rows
    of their own. Shingles are compared by 64-bit hashes, classes by 128 bits. An empty table gives no rows.
    """
    summary, named = _named(docs, words_each, percent, block_sets)
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return summary.join(named, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _named(docs: DataFrame, words_each: int, percent: int, block_sets: int) -> tuple[DataFrame, DataFrame]:
    """The rows' summaries, and cls, component, component_id of every class."""
    summary = _summary(docs, words_each, percent)
    classes = _classes(summary)
    joined = components(links(docs, summary, classes, words_each, percent, block_sets), "a", "b")
    member = saved(classes.join(joined, F.col("cls") == F.col("node"), "left")
                   .select("cls", "least", F.coalesce("component", "cls").alias("component")), "set-members")
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    rows = saved(summary.select("doc_id", "n", "cls"), "sets-rows")
    dropped(summary)  # with all posted shingles
    return rows, saved(member.join(least, "component").select("cls", "component", "component_id"), "set-components")


def one_of_each(docs: DataFrame, words_each: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with one row of each component of alike sets: that with the smallest doc_id.

    Rows without a word have no partners, and stay, but of those that share an id (or have none) one stays.
    """
    def step(rows: DataFrame) -> DataFrame:
        summary, named = _named(rows, words_each, percent, BLOCK_SETS)
        empty = F.col("n") == 0
        grouped = summary.join(named, "cls", "left").select(
            "doc_id", F.col("cls").alias("fp"), F.coalesce("component", "cls").alias("component"),
            F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        return one_of_each_group(rows, grouped, lambda some, *columns: _keyed(some, words_each, percent, *columns))
    return apart(docs, step)


def _keyed(rows: DataFrame, words_each: int, percent: int, *columns: str) -> DataFrame:
    slim = rows.select(*columns, text_bytes().alias("_text"))
    kinds = "".join(f"`{c}` {slim.schema[c].dataType.simpleString()}, " for c in columns)
    return slim.mapInArrow(_summaries(words_each, percent), kinds + "n bigint, cls binary, number bigint, first array<bigint>").select(
        *columns, F.col("cls").alias("fp"))
