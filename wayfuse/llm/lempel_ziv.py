"""Substring dedup by relative Lempel-Ziv parsing against an index of the whole corpus.

The corpus is its own reference. A window of ``WINDOW`` words is filed in the reference
block its least 8-word hash names, so equal windows meet in one block wherever they
stand. A document is factored greedily from left to right: a factor begins at the first word
that starts a window found in its block a second time, and is extended word by word while the
windows go on being found; factors of at least a window are duplicate spans. Windows across
the boundary of two factors are looked up like all others, so a span that goes from one
reference to another without a break stays whole.

Each task reads some documents at a time and files every distinct window once: what the
task has already seen twice is known to repeat and needs no answer. A passage in a third of
all documents therefore reaches its block once from each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import apart, batches_by_bytes, saved, text_bytes

WINDOW = 35
GRAM = 8
CHUNK_BYTES = 2 << 20  # text a task holds at once; its words and their hashes take some tens of times that
_ODD = 0x9E3779B97F4A7C15


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i below ``n``."""
    inverse = pow(_ODD, -1, 1 << 64)
    up, down = (np.full(n, np.uint64(b)) for b in (_ODD, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def rolling(values: np.ndarray, width: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` values, in one pass over prefix sums."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = powers
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=sums[1:])
    return _mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    if len(x) < width:
        return np.empty(0, x.dtype)
    have, out = 1, x
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First values and lengths of the runs of consecutive numbers in ascending ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.r_[True, np.diff(starts) != 1])
    return starts[new], np.diff(np.r_[new, len(starts)])


def first_of_equal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is the first of its kind, and whether there is another one like it."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    same = s[1:] == s[:-1]
    first, twice = np.ones(len(x), bool), np.zeros(len(x), bool)
    first[order[1:]] = ~same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return first, twice


_BLOB = "bucket int, hashes binary, row binary, start binary, count binary, known binary, id binary, digest binary"
_SPAN = "id bigint, digest bigint, starts binary, counts binary"


def _filed(buckets: int, window: int, gram: int):
    """Documents to what each reference block gets of them: window hashes and whose they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash, powers = _WordHash(), _powers(1)
        for table in batches_by_bytes(batches, "_text", CHUNK_BYTES):
            docs = [t.split() for t in table.column("_text").to_pylist()]
            n = np.fromiter(map(len, docs), np.int64, len(docs))
            values = np.fromiter((word_hash[w] for d in docs for w in d), np.uint64, int(n.sum()))
            del docs
            ends = np.cumsum(n)
            if len(powers[0]) < len(values):
                powers = _powers(len(values))
            hashes = rolling(values, window, powers)
            least = sliding_least(rolling(values, gram, powers), window - gram + 1)
            row = np.repeat(np.arange(len(n)), n)[: len(hashes)]
            at = np.arange(len(hashes))
            inside = at + window <= ends[row]
            at, hashes, row, least = at[inside], hashes[inside], row[inside], least[inside]
            first, twice = first_of_equal(hashes)
            bucket = (_mix(least) % np.uint64(buckets)).astype(np.int32)
            ids = table.column("id").to_numpy(), table.column("digest").to_numpy()
            begin = (ends - n)[row]
            yield from _blobs(buckets, bucket, at, at - begin, row, hashes, first, twice, ids)
    return run


def _blobs(buckets, bucket, at, start, row, hashes, first, twice, ids):
    """One record for each block. Windows of a run (one document, one block) share one entry."""
    told = first | twice  # the others are answered for by the first of their kind: none are left out
    order = np.argsort(bucket[told], kind="stable")
    bucket, at, start, row, hashes, first, twice = (x[told][order] for x in (bucket, at, start, row, hashes, first, twice))
    new = np.r_[True, (np.diff(at) != 1) | (np.diff(row) != 0) | (np.diff(bucket) != 0)
                | (np.diff(twice.astype(np.int8)) != 0)] if len(at) else np.empty(0, bool)
    head = np.flatnonzero(new)
    count = np.diff(np.r_[head, len(at)])
    cuts, run_cuts = np.searchsorted(bucket, np.arange(buckets + 1)), np.searchsorted(bucket[head], np.arange(buckets + 1))
    # A repeated window's hash is sent once; entries of unknown windows carry one hash for each.
    out = {c: [] for c in ("bucket", "hashes", "row", "start", "count", "known", "id", "digest")}
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        w, r = slice(cuts[b], cuts[b + 1]), slice(run_cuts[b], run_cuts[b + 1])
        rows, own = np.unique(row[head][r], return_inverse=True)
        known = twice[head][r]
        sent = np.concatenate([hashes[w][~twice[w]], hashes[w][twice[w] & first[w]]])
        for name, value in (("bucket", b), ("hashes", sent.tobytes()), ("row", own.astype(np.int32).tobytes()),
                            ("start", start[head][r].astype(np.int64).tobytes()), ("count", count[r].astype(np.int32).tobytes()),
                            ("known", known.tobytes()), ("id", ids[0][rows].tobytes()), ("digest", ids[1][rows].tobytes())):
            out[name].append(value)
    if out["bucket"]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["bucket"], pa.int32()), *(pa.array(out[c], pa.binary()) for c in list(out)[1:])], list(out))


def _answered(table: pa.Table) -> pa.Table:
    """One reference block: the windows found twice in it, as runs of each document."""
    blobs = table.to_pylist()
    unknown, all_hashes, lone = [], [], []
    for x in blobs:
        h = np.frombuffer(x["hashes"], np.uint64)
        count, known = np.frombuffer(x["count"], np.int32), np.frombuffer(x["known"], bool)
        n = int(count[~known].sum())
        unknown.append(n)
        all_hashes.append(h)
        lone.append(np.arange(len(h)) < n)
    h = np.concatenate(all_hashes) if all_hashes else np.empty(0, np.uint64)
    _, found = first_of_equal(h)
    found, at, out = found[np.concatenate(lone)] if lone else found, 0, []
    for x, n in zip(blobs, unknown):
        row, start = np.frombuffer(x["row"], np.int32), np.frombuffer(x["start"], np.int64)
        count, known = np.frombuffer(x["count"], np.int32), np.frombuffer(x["known"], bool)
        own_row, own_start, own_count = row[~known], start[~known], count[~known]
        position = np.repeat(own_start - (np.cumsum(own_count) - own_count), own_count) + np.arange(n)
        hit = found[at:at + n]
        at += n
        rows = np.concatenate([np.repeat(own_row, own_count)[hit], row[known]])
        starts = np.concatenate([position[hit], start[known]])
        counts = np.concatenate([np.ones(int(hit.sum()), np.int32), count[known]])
        order = np.lexsort((starts, rows))
        rows, starts, counts = rows[order], starts[order], counts[order]
        ids, digests = np.frombuffer(x["id"], np.int64), np.frombuffer(x["digest"], np.int64)
        here, cut = np.unique(rows, return_index=True)
        for r, a, b in zip(here.tolist(), cut.tolist(), [*cut[1:].tolist(), len(rows)]):
            new = np.flatnonzero(np.r_[True, starts[a + 1:b] > (starts + counts)[a:b - 1]])
            end = np.r_[new[1:] - 1, b - a - 1]
            first = starts[a:b][new]
            out.append((int(ids[r]), int(digests[r]), first.astype(np.int64).tobytes(),
                        ((starts + counts)[a:b][end] - first).astype(np.int64).tobytes()))
    columns = list(zip(*out)) or [[]] * 4
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                    names=["id", "digest", "starts", "counts"])


def covered(n: int, starts: list[bytes], counts: list[bytes], window: int) -> np.ndarray:
    """Which of ``n`` words lie in a factor: runs of repeated windows, all windows wide."""
    mark = np.zeros(n + 1, np.int64)
    for s, c in zip(starts, counts):
        s, c = np.frombuffer(s, np.int64), np.frombuffer(c, np.int64)
        np.add.at(mark, s, 1)
        np.add.at(mark, s + c + window - 1, -1)
    return np.cumsum(mark)[:n] > 0


def _keyed(docs: DataFrame) -> DataFrame:
    """``id`` and ``digest`` tell documents apart; rows alike in both have the same text and answer."""
    return docs.withColumns({"_text": text_bytes(), "id": F.coalesce(F.xxhash64("doc_id"), F.lit(0)),
                             "digest": F.xxhash64(text_bytes(), F.lit(7))})


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, digest, starts, counts: the documents with factors, as arrays of runs of repeated windows.

    As many reference blocks as there are shuffle partitions, so a block stays as
    small as the session's partitions are meant to be.
    """
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    filed = _keyed(docs.select("doc_id", "text")).where(F.octet_length("_text") >= 2 * window - 1)
    filed = filed.select("id", "digest", "_text").mapInArrow(_filed(buckets, window, gram), _BLOB)
    found = filed.groupBy("bucket").applyInArrow(_answered, _SPAN)
    return found.groupBy("id", "digest").agg(F.collect_list("starts").alias("starts"),
                                             F.collect_list("counts").alias("counts"))


def _joined(docs: DataFrame, *columns: str) -> DataFrame:
    """The rows with the runs of their documents, which are written first: hashes and texts never lie on disk together."""
    found = saved(spans(docs), "repeated-windows")
    keyed = _keyed(docs.select("doc_id", "text", *[c for c in columns if c not in ("doc_id", "text")]))
    return keyed.select(*columns, "_text", "id", "digest").join(
        found.hint("shuffle_hash"), ["id", "digest"], "left").drop("id", "digest")


def _measured(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for text, s, c in zip(*(batch.column(x).to_pylist() for x in ("_text", "starts", "counts"))):
                words = text.split()
                n_words.append(len(words))
                gone = covered(len(words), s, c, window) if s else None
                if gone is not None:
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                n_removed.append(n_words[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def dedup_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) of every row.

    A null text has no words. Texts shorter than a window lose nothing. Rows that repeat a
    text lose all windows of it, whatever their doc_id.
    """
    return _joined(docs, "doc_id").mapInArrow(
        _measured(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_spans(text: bytes, starts, counts, window: int) -> bytes:
    """``text`` less its covered words and the white space after each; the rest stays as it was."""
    import re

    places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    gone = covered(len(places), starts, counts, window)
    out, at = [], 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).tolist()
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(text[at:places[a][0]])
        at = places[b][0] if b < len(places) else places[-1][1]
    return b"".join(out) + text[at:]


def _cleaned(window: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None or not s else without_spans(t.encode(), s, c, window).decode()
                     for t, s, c in zip(*(batch.column(x).to_pylist() for x in ("text", "starts", "counts")))]
            made = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([made if c == "text" else batch.column(c) for c in columns], columns)
    return run


def remove_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the duplicate spans cut from ``text``; n_chars, if there, counts what is left.

    No row goes: a text that is all duplicate becomes empty.
    """
    return apart(docs, lambda rows: _without(rows, window))


def _without(docs: DataFrame, window: int) -> DataFrame:
    columns = docs.columns
    joined = _joined(docs, *columns).drop("_text")
    done = joined.mapInArrow(_cleaned(window, columns), docs.schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done
