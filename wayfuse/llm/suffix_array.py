"""Byte-level dedup of exact repeats: suffix arrays by the difference-cover algorithm, block by block.

A suffix array over all bytes at once would move some tens of bytes for each byte of text. Here
equal 400-byte strings are first brought together: each string is filed under the least
hash of its 32-byte parts, which only depends on the string itself.

1. Neighbouring strings with one least hash form a run. Runs whose hash no other run has cannot
   repeat and end here; they are most of the corpus.
2. The bytes of the other runs meet in blocks, one block for many hashes; equal runs are kept once.
3. In a block, a screen by rolling hash drops what is not there twice. The rest is
   decided byte by byte: a suffix array of it (sampled triples are sorted and named,
   the names are sorted the same way, the remaining suffixes are merged in) and a comparison of the
   400-byte prefixes of suffixes next to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import batches_by_bytes
from wayfuse.llm.lempel_ziv import _BLOB, _SPAN, _answered, _blobs, _keyed, _mix, _powers, covered, first_of_equal, rolling, sliding_least

LENGTH = 400
GRAM = 32
CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# ---- suffix array ----------------------------------------------------------------------

def _named(*columns: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 1, in order, for the rows of the columns; how many there are."""
    names = columns[0].astype(np.int64)
    for column in columns[1:]:
        top = int(column.max(initial=0)) + 1
        if int(names.max(initial=0)) >= (1 << 62) // top:
            names = np.unique(names, return_inverse=True)[1]
        names = names * top + column
    values, names = np.unique(names, return_inverse=True)
    return names + 1, len(values)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` (numbers from 1 up) in order: the difference cover is {1, 2} modulo 3."""
    n = len(text)
    if n < 8:
        own = text.tolist()
        return np.array(sorted(range(n), key=lambda i: own[i:]), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    # positions 1 and 2 modulo 3; one past the end if n is 1 modulo 3, so that each position 0 has a rank after it
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate([one, two])
    names, distinct = _named(t[sampled], t[sampled + 1], t[sampled + 2])
    if distinct < len(sampled):
        order = suffix_array(names)
    else:
        order = np.argsort(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sampled[order]] = np.arange(1, len(sampled) + 1)
    sorted12 = sampled[order]
    sorted12 = sorted12[sorted12 < n]
    zero = np.arange(0, n, 3)
    first, second = sorted12[sorted12 % 3 == 1], sorted12[sorted12 % 3 == 2]
    # suffixes at 0 modulo 3 against those at 1: one symbol and the rank after it; against those at 2: two symbols
    by_one, _ = _named(t[np.concatenate([zero, first])], rank[np.concatenate([zero, first]) + 1])
    own = by_one[: len(zero)]
    order0 = np.argsort(own, kind="stable")
    zero, own = zero[order0], own[order0]
    both = np.concatenate([zero, second])
    by_two, _ = _named(t[both], t[both + 1], rank[both + 2])
    smaller = np.searchsorted(by_one[len(order0):], own) + np.searchsorted(by_two[len(zero):], by_two[: len(zero)])
    out = np.full(n, -1, np.int64)
    out[np.arange(len(zero)) + smaller] = zero
    out[out < 0] = sorted12
    return out


def repeated_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Which positions of ``data`` (bytes) start a ``length``-byte string inside a segment that another one equals."""
    found = np.zeros(len(data), bool)
    text = np.concatenate([np.r_[data[a:b].astype(np.int64) + 1, 0] for a, b in zip(starts.tolist(), ends.tolist())])
    place = np.concatenate([np.r_[np.arange(a, b), -1] for a, b in zip(starts.tolist(), ends.tolist())])
    stop = np.repeat(ends, ends - starts + 1)
    at = suffix_array(text + 1)
    at = at[(place[at] >= 0) & (place[at] + length <= stop[at])]
    a, b = place[at[:-1]], place[at[1:]]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.zeros(len(data), np.uint64)
    for i in range(8):
        eight |= padded[i:i + len(data)].astype(np.uint64) << np.uint64(8 * i)
    for step in [*range(0, length - 7, 8), max(0, length - 8)]:  # pairs that differ soon are dropped soon
        same = eight[a + step] == eight[b + step]
        a, b = a[same], b[same]
    found[a] = found[b] = True
    return found


# ---- filing ----------------------------------------------------------------------------

def _runs(texts: list[bytes], length: int, gram: int):
    """Runs of string starts with one least hash: row, first start in the text, count, least hash; and the joined bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(n)
    grams = rolling(_BYTE[data], gram, _powers(max(1, len(data))))
    least = sliding_least(grams, length - gram + 1)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)[: len(least)]
    at = np.flatnonzero(np.arange(length, length + len(least)) <= ends[row])
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), data, ends - n, grams
    own = least[at]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (np.diff(at) != 1) | (np.diff(row[at]) != 0)])
    count = np.diff(np.r_[new, len(at)])
    rows = row[at[new]].astype(np.int64)
    return rows, at[new] - (ends - n)[rows], count, own[new], data, ends - n, grams


def _met_within(grams: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Whether a run's least hash stands in more than one place among all those that are least around them.

    Two equal strings of one run both hold it, so a run that repeats in itself is never missed.
    """
    if not len(least):
        return np.empty(0, bool)
    around = sliding_least(grams, width)
    edge = np.full(width - 1, _TOP)
    # the largest of the least hashes of the strings around a place, by complements
    largest = ~sliding_least(np.concatenate([edge, ~around, edge]), width)
    places = np.sort(grams[grams == largest])
    return np.isin(least, places[1:][places[1:] == places[:-1]])


def _bucket(least: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(least) % np.uint64(buckets)).astype(np.int32)


def _filed_hashes(buckets: int, length: int, gram: int):
    """Documents to the least hashes of their runs, for the blocks that look for hashes met twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, "_text", CHUNK_BYTES):
            row, start, _, least, _, _, grams = _runs(table.column("_text").to_pylist(), length, gram)
            first, twice = first_of_equal(least)
            twice |= _met_within(grams, least, length - gram + 1)
            ids = table.column("id").to_numpy(), table.column("digest").to_numpy()
            yield from _blobs(buckets, _bucket(least, buckets), 2 * np.arange(len(row)), start, row, least, first, twice, ids)
    return run


_CONTEXTS = "bucket int, bytes binary, lengths binary, least binary, context binary, row binary, start binary, id binary, digest binary"


def _filed_contexts(buckets: int, length: int, gram: int):
    """Documents and the first starts of their doubtful runs to the bytes of these runs, equal ones once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by_bytes(batches, "_text", CHUNK_BYTES):
            row, start, count, least, data, begin, _ = _runs(table.column("_text").to_pylist(), length, gram)
            wanted = []
            for r, (s, c) in enumerate(zip(table.column("starts").to_pylist(), table.column("counts").to_pylist())):
                for a, b in zip(s or (), c or ()):
                    a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
                    wanted.append(begin[r] + np.repeat(a - (np.cumsum(b) - b), b) + np.arange(int(b.sum())))
            keep = np.isin(begin[row] + start, np.concatenate(wanted)) if wanted else np.zeros(len(row), bool)
            row, start, count, least = row[keep], start[keep], count[keep], least[keep]
            bucket = _bucket(least, buckets)
            ids = table.column("id").to_numpy(), table.column("digest").to_numpy()
            out: dict[str, list] = {c.split()[0]: [] for c in _CONTEXTS.split(", ")}
            raw = data.tobytes()
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[b]:cuts[b + 1]]
                number: dict[bytes, int] = {}
                hashes, context = [], []
                for i in own.tolist():
                    a = int(begin[row[i]] + start[i])
                    piece = raw[a:a + int(count[i]) + length - 1]
                    if piece not in number:
                        number[piece] = len(number)
                        hashes.append(least[i])
                    context.append(number[piece])
                rows, place = np.unique(row[own], return_inverse=True)
                for name, value in (("bucket", b), ("bytes", b"".join(number)), ("lengths", np.array([len(x) for x in number], np.int32).tobytes()),
                                    ("least", np.array(hashes, np.uint64).tobytes()), ("context", np.array(context, np.int32).tobytes()),
                                    ("row", place.astype(np.int32).tobytes()), ("start", start[own].astype(np.int64).tobytes()),
                                    ("id", ids[0][rows].tobytes()), ("digest", ids[1][rows].tobytes())):
                    out[name].append(value)
            if out["bucket"]:
                yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *(
                    pa.array(out[c], pa.binary()) for c in list(out)[1:])], list(out))
    return run


def _decided(length: int):
    """One block: which string starts of its runs repeat, as (start, count) of each document."""
    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        uses, hashes, blobs = [], [], table.to_pylist()
        for x in blobs:
            at, own = 0, []
            for n, h in zip(np.frombuffer(x["lengths"], np.int32).tolist(), np.frombuffer(x["least"], np.uint64).tolist()):
                piece = x["bytes"][at:at + n]
                at += n
                if piece not in number:
                    number[piece] = len(number)
                    uses.append(0)
                    hashes.append(h)
                own.append(number[piece])
            x["context"] = np.array(own, np.int64)[np.frombuffer(x["context"], np.int32)]
            for i, c in zip(*(v.tolist() for v in np.unique(x["context"], return_counts=True))):
                uses[i] += c
            del x["bytes"]
        found = _repeating(list(number), np.array(hashes, np.uint64), np.array(uses), length)
        del number
        out = []
        for x in blobs:
            row, start = np.frombuffer(x["row"], np.int32), np.frombuffer(x["start"], np.int64)
            ids, digests = np.frombuffer(x["id"], np.int64), np.frombuffer(x["digest"], np.int64)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(len(ids) + 1))
            for r in range(len(ids)):
                parts = [(start[i] + a, n) for i in order[cuts[r]:cuts[r + 1]].tolist() for a, n in zip(*found[x["context"][i]])]
                if parts:
                    s, c = (np.array(v, np.int64) for v in zip(*parts))
                    out.append((int(ids[r]), int(digests[r]), s.tobytes(), c.tobytes()))
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                         pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names=["id", "digest", "starts", "counts"])
    return run


def _repeating(contexts: list[bytes], least: np.ndarray, uses: np.ndarray, length: int) -> list[tuple[list, list]]:
    """For each distinct run of bytes the (starts, counts) of its strings met elsewhere; all of them if the run is used twice."""
    out = [([0], [len(c) - length + 1]) if u > 1 else ([], []) for c, u in zip(contexts, uses.tolist())]
    order, at = np.argsort(least, kind="stable"), 0
    while at < len(order):  # some hashes at a time; a hash is never parted
        to, size = at, 0
        while to < len(order) and (size < BLOCK_BYTES or least[order[to]] == least[order[to - 1]]):
            size += len(contexts[order[to]])
            to += 1
        own, at = order[at:to], to
        data = np.frombuffer(b"".join(contexts[i] for i in own), np.uint8)
        n = np.array([len(contexts[i]) for i in own], np.int64)
        ends = np.cumsum(n)
        window = rolling(_BYTE[data], length, _powers(len(data)))
        inside = np.flatnonzero(np.arange(length, length + len(window)) <= np.repeat(ends, n)[: len(window)])
        _, twice = first_of_equal(window[inside])
        inside = inside[twice]
        if not len(inside):
            continue
        new = np.r_[True, np.diff(inside) > 1]
        starts = inside[new]
        stops = np.r_[inside[np.flatnonzero(new)[1:] - 1], inside[-1]] + length
        # runs of starts closer than a string's length stay apart: segments may overlap, each is sorted on its own
        hit = np.flatnonzero(repeated_prefixes(data, starts, stops, length))
        which = np.searchsorted(ends, hit, side="right")
        for k in np.unique(which).tolist():
            if uses[own[k]] > 1:
                continue
            mine = hit[which == k] - (ends[k] - n[k])
            first = np.flatnonzero(np.r_[True, np.diff(mine) > 1])
            out[own[k]] = mine[first].tolist(), np.diff(np.r_[first, len(mine)]).tolist()
    return out


# ---- tables ----------------------------------------------------------------------------

def _collected(found: DataFrame) -> DataFrame:
    return found.groupBy("id", "digest").agg(F.collect_list("starts").alias("starts"), F.collect_list("counts").alias("counts"))


def byte_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """id, digest, starts, counts: for the documents that have any, runs of starts of repeated strings.

    As many blocks as there are shuffle partitions.
    """
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = _keyed(docs.select("doc_id", "text")).select("id", "digest", "_text").where(F.octet_length("_text") >= length)
    met = keyed.mapInArrow(_filed_hashes(buckets, length, gram), _BLOB).groupBy("bucket").applyInArrow(_answered, _SPAN)
    doubtful = keyed.join(_collected(met).hint("shuffle_hash"), ["id", "digest"])
    contexts = doubtful.select("id", "digest", "_text", "starts", "counts").mapInArrow(
        _filed_contexts(buckets, length, gram), _CONTEXTS)
    return _collected(contexts.groupBy("bucket").applyInArrow(_decided(length), _SPAN))


def _measured(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, s, c in zip(*(batch.column(x).to_pylist() for x in ("_text", "starts", "counts"))):
                gone = covered(len(text), s, c, length) if s else np.zeros(len(text), bool)
                spans = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
                rows.append((len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def dedup_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A null text is empty. A text shorter than ``length`` bytes loses nothing. Rows that repeat a text of
    that length lose all of it. Overlapping repeats inside one text count.
    """
    joined = _keyed(docs.select("doc_id", "text")).select("doc_id", "_text", "id", "digest").join(
        byte_spans(docs, length).hint("shuffle_hash"), ["id", "digest"], "left").drop("id", "digest")
    return joined.mapInArrow(_measured(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
