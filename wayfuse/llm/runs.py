"""Periodic runs of words, found through Lyndon roots.

Phase one of a grouping suffix sorter (Baier) sorts the suffixes by their longest Lyndon prefixes.
Groups are taken from the highest down; a suffix of a group lengthens the prefix of the
nearest suffix before it that is still in a lower group, and so parts that suffix from its own
group. When a group's turn comes, the length of its common prefix is the Lyndon length
of all its suffixes. This is done under an order of the words and under the reverse one; every run has
a root that is a longest Lyndon prefix under one of them. Each such prefix is extended to both
sides by longest common extensions, read from exact ranks of blocks of 1, 2, 4, ... words.

A run that counts has 6 words and 4 periods at least, so each three words of it stand at least twice in the
document. Stretches of words where this holds hold all such runs whole; the sorter works on
these stretches, whatever their length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import batches_by_bytes, free_name, text_bytes

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK = 2 << 20  # bytes of text worked on at once; a longer text stands alone
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word starting at each place; the end counts as less than any code.

    ``codes`` are the numbers 0 to k - 1, each used at least once.
    """
    n = len(codes)
    groups = max(codes, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(groups)]
    for i, c in enumerate(codes):
        members[c].append(i)
    of = list(codes)
    alive = [len(m) for m in members]
    length = [1] * groups
    above, below = list(range(1, groups + 1)), list(range(-1, groups - 1))
    before = list(range(-1, n - 1))
    done = bytearray(n)
    out = [0] * n
    g = groups - 1
    while g >= 0:
        own = [i for i in members[g] if of[i] == g] if alive[g] else ()
        size = length[g]
        for i in own:
            done[i] = 1
            out[i] = size
        hits: dict[int, int] = {}
        for i in own:
            j = before[i]
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        if len(hits) == 1:
            ordered = hits.items()
        else:  # those lengthened most often first: the others are put in below them
            ordered = sorted(hits.items(), key=lambda x: -x[1])
        made, times = {}, 0
        for j, c in ordered:
            if c != times:
                made, times = {}, c
            old = of[j]
            new = made.get(old)
            if new is None:
                if alive[old] == 1:
                    length[old] += c * size
                    continue
                new = len(length)
                made[old] = new
                length.append(length[old] + c * size)
                members.append([])
                alive.append(0)
                up = above[old]
                above.append(up)
                below.append(old)
                above[old] = new
                below[up] = new
            of[j] = new
            members[new].append(j)
            alive[new] += 1
            alive[old] -= 1
        g = below[g]
    return out


class _Blocks:
    """Exact ranks of all blocks of 1, 2, 4, ... codes, and longest common extensions by them.

    The codes end with one that no other place holds, and so does every stretch in them.
    """

    def __init__(self, codes: np.ndarray):
        self.ranks = [codes.astype(np.int64)]
        step = 1
        while True:
            now = self.ranks[-1]
            further = np.zeros_like(now)
            further[:-step] = now[step:] if step < len(now) else 0
            pairs = now * (int(now.max(initial=0)) + 1) + further
            values, ranks = np.unique(pairs, return_inverse=True)
            if len(values) == len(now):
                return
            self.ranks.append(ranks.astype(np.int64))
            step *= 2
            if step >= len(now):
                return

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes from ``a`` on equal those from ``b`` on."""
        size, last = np.zeros(len(a), np.int64), len(self.ranks[0]) - 1
        for k in range(len(self.ranks) - 1, -1, -1):  # no block of the next level stands twice
            x, y, ranks = a + size, b + size, self.ranks[k]
            same = (x <= last) & (y <= last) & (ranks[np.minimum(x, last)] == ranks[np.minimum(y, last)])
            size += same.astype(np.int64) << k
        return size

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes before ``a`` equal those before ``b``."""
        size = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y, ranks = a - size - (1 << k), b - size - (1 << k), self.ranks[k]
            same = (x >= 0) & (y >= 0) & (ranks[np.maximum(x, 0)] == ranks[np.maximum(y, 0)])
            size += same.astype(np.int64) << k
        return size


def _dense(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1]


def runs_of(codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs inside the stretches ``codes[cuts[k]:cuts[k + 1]]``.

    A run has two periods at least; starts count from the first stretch's beginning.
    """
    if not len(codes):
        return np.empty((0, 3), np.int64)
    stretch = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    place = np.arange(len(codes)) + stretch  # with one closing code after each stretch
    top = int(codes.max()) + 1
    closed = np.empty(len(codes) + len(cuts) - 1, np.int64)
    closed[place] = codes
    closed[cuts[1:] + np.arange(len(cuts) - 1)] = top + np.arange(len(cuts) - 1)
    blocks = _Blocks(_dense(closed))
    starts, periods = [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        ranks = _dense(codes[a:b])
        for order in (ranks, ranks.max(initial=0) - ranks):
            starts.append(np.arange(a, b))
            periods.append(np.array(lyndon_lengths(order.tolist()), np.int64))
    start, period = np.concatenate(starts), np.concatenate(periods)
    at = place[start]
    inside = start + period < cuts[stretch[start] + 1]  # a root at the end is found one period earlier
    start, period, at = start[inside], period[inside], at[inside]
    right, left = blocks.forward(at, at + period), blocks.backward(at, at + period)
    found = left + right >= period
    rows = np.column_stack([start - left, left + period + right, period])[found]
    return np.unique(rows, axis=0)


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = len(self)
        return self[word]


def edited_words(words: list, doc_id) -> list:
    """The words with a repeated passage, for a tenth of the ids; a null id is not among them."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _repeated(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places covered by three words that stand in their document again (by hash: perhaps a few more)."""
    cover = np.zeros(len(codes), bool)
    if len(codes) < LEAST_WORDS:
        return cover
    c = codes.astype(np.uint64) + np.uint64(1)
    key = c[:-2] * _ODD[0] + c[1:-1] * _ODD[1] + c[2:] * _ODD[2] + doc[:-2].astype(np.uint64) * _ODD[3]
    key ^= key >> np.uint64(31)
    key *= _ODD[1]
    key ^= key >> np.uint64(29)
    whole = doc[:-2] == doc[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    twice &= whole
    for shift in range(3):
        cover[shift:len(codes) - 2 + shift] |= twice
    return cover


def word_runs(words: list[list]) -> list[np.ndarray]:
    """Of each document (a list of words) the runs that count: rows (start, length, period), sorted."""
    numbers = _Numbers()
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.fromiter((numbers[w] for own in words for w in own), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(words)), sizes)
    begin = np.cumsum(sizes) - sizes
    out = [np.empty((0, 3), np.int64)] * len(words)
    held = np.flatnonzero(_repeated(codes, doc))
    if not len(held):
        return out
    first = np.r_[True, (np.diff(held) > 1) | (np.diff(doc[held]) > 0)]
    size = np.diff(np.r_[np.flatnonzero(first), len(held)])
    long = np.repeat(size >= LEAST_WORDS, size)
    held, size = held[long], size[size >= LEAST_WORDS]
    found = runs_of(codes[held], np.r_[0, np.cumsum(size)])
    found = found[found[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * found[:, 2])]
    at = held[found[:, 0]]
    owner = doc[at]
    rows = np.column_stack([at - begin[owner], found[:, 1], found[:, 2]])
    for d in np.unique(owner).tolist():
        own = rows[owner == d]
        out[d] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return out


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [w for w, drop in zip(words, np.cumsum(change[:-1]).tolist()) if not drop]


def _best(runs: np.ndarray) -> tuple:
    best = None
    for start, length, period in runs.tolist():  # in the order of the ties
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return (*best, 1000 * best[1] // best[2]) if best else (None,) * 4


def _reported(edit: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in batches_by_bytes(batches, "_text", CHUNK):
            ids = chunk.column("doc_id").to_pylist()
            words = [t.split() for t in chunk.column("_text").to_pylist()]  # of bytes: ASCII white space only
            if edit:
                words = [edited_words(w, i) for w, i in zip(words, ids)]
            found = word_runs(words)
            best = [_best(r) for r in found]
            listed = ["".join(f"{s},{n},{p}\n" for s, n, p in r.tolist()) for r in found]
            columns = [chunk.column("doc_id").combine_chunks(), pa.array([len(r) for r in found], pa.int64()),
                       *(pa.array([b[k] for b in best], pa.int64()) for k in range(4)),
                       pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
                       pa.array([hashlib.sha256(b" ".join(collapsed(w, r))).hexdigest() for w, r in zip(words, found)], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                       "runs_sha256", "collapsed_sha256"])
    return run


def run_report(docs: DataFrame, edit: bool = True) -> DataFrame:
    """A row for each row of ``docs``: its runs counted, the one of greatest exponent, and two digests.

    A null text is an empty one; without a run the four numbers are null, and the digests are those of no text and
    of all words. ``edit`` first repeats a passage in a tenth of the documents, chosen by id (never
    of a null id). Repeated rows stay repeated, an empty table gives no rows, other columns are left out.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("_text"))
    return slim.mapInArrow(_reported(edit), "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
                                            "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


def _shortened(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in batches_by_bytes(batches, column, CHUNK):
            words = [t.split() for t in chunk.column(column).to_pylist()]
            texts = [b" ".join(collapsed(w, r)).decode() if len(r) else None for w, r in zip(words, word_runs(words))]
            at = chunk.schema.get_field_index(column)
            yield from chunk.set_column(at, column, pa.array(texts, pa.string())).to_batches()
    return run


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, each run cut to its first period.

    A text without a run stays as it is, white space included; of one with a run the words that
    stay are joined by one space. A null text stays null.
    """
    own = free_name(docs, "_run_text")
    kinds = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{own}` string"])
    return (docs.withColumn(own, text_bytes()).mapInArrow(_shortened(own), kinds)
            .withColumn("text", F.coalesce(own, "text")).drop(own))
