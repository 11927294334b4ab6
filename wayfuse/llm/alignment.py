"""Alignment of two tokenizers' tokens over the same bytes, and how often ids are linked.

* Both vocabularies cut each text; the ends of their tokens are byte offsets. A batch of documents is merged in
  lockstep: one state vector holds, for every document, a place among its A tokens and one among its B
  tokens. Each step advances, for all documents at once, the one that ends first, or both where they end
  together: that is a cut, and closes a group. Finished documents leave the vector. A long document takes part
  with several stretches between common ends, which are looked up every ``LANE`` tokens.
* All A-B pairs of a group are links. A block of documents becomes one row of a written table: numbers of
  each document, the block's distinct id pairs, and each document's links as places in that list.
* Only distinct pairs of blocks are shuffled: they are counted over the corpus, joined back
  to the blocks' lists, and each block's documents read their counts there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import batches_by_bytes, saved
from wayfuse.llm.packing import _Ids

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k", "piece_bpe_32k"
BLOCK = 2 << 20  # bytes of text in a block; a longer text is a block of its own
PART = 1 << 19  # characters whose tokens are held at once
LANE = 512
B_BITS = 15  # of a B id in a pair's number
WIDE = 4096  # links of a group from which its distinct ids are combined, not its tokens
_CACHED = 50_000  # words whose ids a vocabulary keeps
_SPACE = "▁"


# ---- tokens ----------------------------------------------------------------------------

class _TokensA:
    """Ids of a space and each text, by the byte-level vocabulary."""

    def __init__(self, name: str):
        self.ids = _Ids(name)
        self.ids.whole.encode_special_tokens = True
        import public_tokenizers

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
        self.bytes = np.array([ranks.get(i, b"") for i in range(max(ranks) + 2)], object)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.ids.ends) > _CACHED:
            self.ids.forget()
        ids, ends = self.ids.of([" " + t for t in texts])
        return ids.astype(np.int64), np.asarray(ends, np.int64)


class _TokensB:
    """Ids of each text by the vocabulary of pieces, which puts a space before the text.

    No piece has a space inside or at its end but those of spaces alone, so words
    with one space between them are cut apart, and their ids kept.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_word = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.bytes = np.array([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode()
                               for i, p in enumerate(pieces)], object)
        self.known: dict[str, list[int]] = {}

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > _CACHED:
            self.known = {}
        known, ids, ends = self.known, [], []
        for text in texts:
            words = text.split(" ")
            if self.by_word and "" not in words and _SPACE not in text:
                new = list({w for w in words if w not in known})
                if new:
                    known.update(zip(new, self.model.encode(new, num_threads=1)))
                for w in words:
                    ids += known[w]
            else:
                ids += self.model.encode(text, num_threads=1)
            ends.append(len(ids))
        return np.array(ids, np.int64), np.array(ends, np.int64)


# ---- lockstep --------------------------------------------------------------------------

def lockstep(end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray) -> np.ndarray:
    """Rows (first A, past A, first B, past B) of all groups.

    ``end_a`` and ``end_b`` are the ends of all tokens; lane k begins at tokens a[k] and b[k], and ends
    where A token ``stop_a[k] - 1`` and some B token end together.
    """
    going = a < stop_a
    a, b, stop = a[going], b[going], stop_a[going]
    from_a, from_b, cuts = a.copy(), b.copy(), []
    a, b = a.copy(), b.copy()
    while len(a):
        x, y = end_a[a], end_b[b]
        a += x <= y
        b += y <= x
        cut = np.flatnonzero(x == y)
        if not len(cut):
            continue
        past_a, past_b = a[cut], b[cut]
        cuts.append((from_a[cut], past_a, from_b[cut], past_b))
        from_a[cut], from_b[cut] = past_a, past_b
        if (past_a == stop[cut]).any():
            going = a < stop
            a, b, stop, from_a, from_b = a[going], b[going], stop[going], from_a[going], from_b[going]
    if not cuts:
        return np.empty((0, 4), np.int64)
    rows = np.column_stack([np.concatenate(c) for c in zip(*cuts)])
    return rows[np.argsort(rows[:, 0], kind="stable")]


def _lanes(end_a: np.ndarray, end_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray):
    """Beginnings in A and B and ends in A of the lanes: the documents, the long ones in stretches."""
    begin_a, begin_b = np.r_[0, stops_a[:-1]], np.r_[0, stops_b[:-1]]
    more_a, more_b = [], []
    for d in np.flatnonzero(stops_a - begin_a > 2 * LANE).tolist():
        own = end_b[begin_b[d]:stops_b[d]]
        for at in range(int(begin_a[d]) + LANE, int(stops_a[d]) - LANE, LANE):
            ends = end_a[at:at + 64]
            place = np.minimum(np.searchsorted(own, ends), len(own) - 1)
            hit = np.flatnonzero(own[place] == ends)
            if len(hit):
                more_a.append(at + int(hit[0]) + 1)
                more_b.append(int(begin_b[d] + place[hit[0]]) + 1)
    a = np.r_[begin_a, np.array(more_a, np.int64)]
    b = np.r_[begin_b, np.array(more_b, np.int64)]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    # documents without tokens begin where the next one does, and end there
    return a, b, np.r_[a[1:], stops_a[-1] if len(stops_a) else 0]


def _linked(groups: np.ndarray, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (document, pair) and how many links each stands for; a number can come more than once."""
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    size = n_a * n_b
    small = np.flatnonzero(size <= WIDE)
    size = size[small]
    upto = np.cumsum(size)
    group = np.repeat(small, size)
    inside = np.arange(int(upto[-1]) if len(upto) else 0) - np.repeat(upto - size, size)
    keys = [doc[group] << (16 + B_BITS) | a[groups[group, 0] + inside // n_b[group]] << B_BITS
            | b[groups[group, 2] + inside % n_b[group]]]
    weights = [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(n_a * n_b > WIDE).tolist():
        ids_a, times_a = np.unique(a[groups[g, 0]:groups[g, 1]], return_counts=True)
        ids_b, times_b = np.unique(b[groups[g, 2]:groups[g, 3]], return_counts=True)
        keys.append((doc[g] << (16 + B_BITS) | ids_a[:, None] << B_BITS | ids_b[None, :]).ravel())
        weights.append((times_a[:, None] * times_b[None, :]).ravel())
    return np.concatenate(keys), np.concatenate(weights)


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


class Aligner:
    """Tokens, groups and links of the documents of a block."""

    def __init__(self, a: str = VOCABULARY_A, b: str = VOCABULARY_B):
        self.a, self.b = _TokensA(a), _TokensB(b)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.comma_a, self.bar = (np.array([f"{i}{c}" for i in range(len(self.a.bytes))], object) for c in ",|")
        self.comma_b, self.semi = (np.array([f"{i}{c}" for i in range(len(self.b.bytes))], object) for c in ",;")

    def _same(self, texts: list[str], found) -> list[bool]:
        """Do the tokens' bytes, joined, give a space and the text?"""
        vocabulary, (ids, ends) = found
        pieces = vocabulary.bytes[ids]
        out, start = [], 0
        for text, end in zip(texts, ends.tolist()):
            out.append(b"".join(pieces[start:end]) == b" " + text.encode())
            start = end
        return out

    def of(self, texts: list[str | None]) -> dict:
        """Per document n_a, n_b, n_groups, n_links, groups (its digest); links as numbers with weights."""
        parts, start, size = [], 0, 0
        for i, text in enumerate([*texts, "x" * PART]):
            if size and size + len(text or "") > PART:
                part = self._part(texts[start:i])
                part["keys"] += start << (16 + B_BITS)
                parts.append(part)
                start, size = i, 0
            size += len(text or "")
        if start < len(texts) or not parts:
            parts.append(self._part(texts[start:]))
            parts[-1]["keys"] += start << (16 + B_BITS)
        return {k: sum((p[k] for p in parts), []) if k == "groups" else np.concatenate([p[k] for p in parts]) for k in parts[0]}

    def _part(self, texts: list[str | None]) -> dict:
        n = len(texts)
        held = [i for i, t in enumerate(texts) if t]
        some = [texts[i] for i in held]
        cut_a, cut_b = self.a.of(some), self.b.of(some)
        fits = np.array([x and y for x, y in zip(self._same(some, (self.a, cut_a)), self._same(some, (self.b, cut_b)))], bool)
        held = np.array(held, np.int64)[fits]
        a, stops_a = _only(*cut_a, fits)
        b, stops_b = _only(*cut_b, fits)
        # both vocabularies cover the same bytes, so their running ends meet where a document ends
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        groups = lockstep(end_a, end_b, *_lanes(end_a, end_b, stops_a, stops_b))
        local = np.searchsorted(stops_a, groups[:, 0], side="right")
        keys, weights = _added(*_linked(groups, a, b, held[local]))
        out = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out["n_a"][held], out["n_b"][held] = np.diff(np.r_[0, stops_a]), np.diff(np.r_[0, stops_b])
        out["n_groups"][:] = np.bincount(held[local], minlength=n)[:n]
        np.add.at(out["n_links"], held[local], (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2]))
        digests = [""] * n
        for i, listed in zip(held.tolist(), self._listed(groups, a, b, stops_a, stops_b)):
            digests[i] = hashlib.sha256(listed.encode()).hexdigest()
        return out | {"groups": digests, "keys": keys, "weights": weights}

    def _listed(self, groups, a, b, stops_a, stops_b) -> Iterator[str]:
        """The groups of each document as text."""
        group_a = np.repeat(np.arange(len(groups)), groups[:, 1] - groups[:, 0])
        group_b = np.repeat(np.arange(len(groups)), groups[:, 3] - groups[:, 2])
        words = np.empty(len(a) + len(b), object)
        at_a, at_b = np.arange(len(a)) + groups[group_a, 2], np.arange(len(b)) + groups[group_b, 1]
        words[at_a], words[at_b] = self.comma_a[a], self.comma_b[b]
        last_a, last_b = groups[:, 1] - 1, groups[:, 3] - 1
        words[at_a[last_a]], words[at_b[last_b]] = self.bar[a[last_a]], self.semi[b[last_b]]
        start = 0
        for end in (stops_a + stops_b).tolist():
            yield "".join(words[start:end])[:-1]
            start = end


def _only(ids: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.r_[0, ends])
    return ids[np.repeat(keep, sizes)], np.cumsum(sizes[keep])


# ---- blocks ----------------------------------------------------------------------------

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCKS = ("block bigint, doc_id array<bigint>, " + "".join(f"{n} array<bigint>, " for n in _NUMBERS)
           + "groups array<string>, pairs array<bigint>, held_by array<bigint>, places binary, weights binary, ends binary")


def _blocked(size: int, a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, aligner = TaskContext.get().partitionId() << 32, None
        for chunk in batches_by_bytes(batches, "text", size):
            aligner = aligner or Aligner(a, b)
            found = aligner.of(chunk.column("text").to_pylist())
            doc = found["keys"] >> (16 + B_BITS)
            pairs, places = np.unique(found["keys"] & ((1 << (16 + B_BITS)) - 1), return_inverse=True)
            ends = np.searchsorted(doc, np.arange(chunk.num_rows), side="right")
            row = [block, chunk.column("doc_id").to_pylist(), *(found[k] for k in _NUMBERS), found["groups"], pairs,
                   np.bincount(places, minlength=len(pairs)), places.astype("<i4").tobytes(),
                   found["weights"].astype("<i8").tobytes(), ends.astype("<i8").tobytes()]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                             ["block", "doc_id", *_NUMBERS, "groups", "pairs", "held_by", "places", "weights", "ends"])
            block += 1
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            own = batch.slice(row, 1)
            places, weights, ends = (np.frombuffer(own.column(c)[0].as_py(), k)
                                     for c, k in (("places", "<i4"), ("weights", "<i8"), ("ends", "<i8")))
            listed = own.column("counts").flatten()
            sums = []
            for field in ("best", "n"):
                values = np.asarray(listed.field(field)).astype(np.int64)
                sums.append(np.r_[0, np.cumsum(values[places] * weights)] if len(places) else np.zeros(1, np.int64))
            begin = np.r_[0, ends[:-1]]
            columns = [own.column(c).flatten() for c in ("doc_id", *_NUMBERS)]
            columns += [pa.array(s[ends] - s[begin]) for s in sums] + [own.column("groups").flatten()]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"])


def align_blocks(docs: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B, block: int = BLOCK) -> DataFrame:
    """The written table of blocks: a row for about ``block`` bytes of text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(slim.mapInArrow(_blocked(block, a, b), _BLOCKS), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, n: in how many documents (rows) two ids are linked; ``best``: no pair of this A id has more."""
    counts = saved(blocks.select(F.explode(F.arrays_zip("pairs", "held_by")).alias("_p"))
                   .groupBy(F.col("_p.pairs").alias("pair")).agg(F.sum("_p.held_by").alias("n"))
                   .withColumn("a", F.shiftright("pair", B_BITS)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row for each id of the vocabulary at most
    return counts.join(F.broadcast(most), "a").select(
        "pair", "a", (F.col("pair") % (1 << B_BITS)).alias("b"), "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: str = VOCABULARY_A, b: str = VOCABULARY_B, block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    A text that is null or empty, or that one vocabulary cannot give back byte for byte, has no
    tokens: zeros, and '' as digest. Repeated rows are rows of their own, and each counts as a
    document. An empty table gives no rows; other columns are left out.
    """
    blocks = align_blocks(docs, a, b, block)
    listed = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    counts = (listed.join(pair_counts(blocks).select("pair", "n", "best"), "pair")
              .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("counts")))
    rows = blocks.drop("pairs", "held_by").join(counts, "block", "left").withColumn(
        "counts", F.coalesce("counts", F.expr("CAST(array() AS array<struct<at: int, n: bigint, best: boolean>>)")))
    return rows.mapInArrow(_counted, "doc_id bigint, " + "".join(f"{n} bigint, " for n in _NUMBERS)
                           + "n_best bigint, count_sum bigint, groups_sha256 string")
