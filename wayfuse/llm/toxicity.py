"""Toxicity by votes of the nearest labelled examples, under exact TF-IDF cosine.

* Examples: a bounded sample of the labelled training rows (``EXAMPLES``, by the least hash
  of their id and text), one row for each id and text. Terms: every word of the examples, with its true count;
  the space of the vectors is that of these words.
* A few insults in a long text move its cosines little. So there is a second space of vectors, of the ``TELLING`` words and
  beginnings of words (four and five letters) that go with the label most by chi-square among the examples; a document without such a
  term has no neighbours there. Each space has its index, its nearest examples and its votes.
* Inverse document frequencies count all documents.
* The inverted index is cut into blocks of examples. Words in many examples are kept as columns,
  with the largest weight of each in every block; the others as lists of examples, whose sums over a block are exact. A document first
  gets an upper bound for every block; blocks are opened from the highest bound down, until none that
  is left can hold one of the nearest. Documents are scored by the batch: a block is one matrix product for all that
  open it. The nearest are exact; ties go by a hash that does not know the label.
* A neighbour's vote weighs by its distance; the votes' share is turned into a
  probability by a logistic curve of both spaces' votes, fitted to the examples. An example with the very text that is scored never votes, neither
  when the curve is fitted nor when it is applied: no document is scored by its own label.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import saved

EXAMPLES = 8192
NEIGHBOURS = 31
BLOCK = 64
COLUMNS = 256
TELLING = 4096  # terms of the second space at most
TOXIC_FROM = 0.7
EVIDENCE = 5
AT_ONCE = 64  # documents scored together
REMEMBERED = 4096  # scores kept for equal texts
PART = 4 << 20  # bytes of a learnt model in a row
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose label is never learnt from: crc32 of the id as text leaves 1 modulo 3 (a null id: false)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


# ---- terms -----------------------------------------------------------------------------

def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [w for text in batch.column("text").to_pylist() for w in set(_WORD.findall((text or "").lower()))]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string())], ["term"])


def _hints(word: str) -> list[str]:
    """The word and its beginnings; a beginning is no word."""
    return [word, *(word[:n] + "-" for n in (4, 5) if len(word) > n)]


class _Cutter:
    """Numbers and counts of a text's terms, in the space of all words and in that of the telling ones."""

    def __init__(self, terms: dict[str, int], telling: dict[str, int]):
        self.terms = terms
        self.words = {h: i for h, i in telling.items() if not h.endswith("-")}
        self.four = {h[:-1]: i for h, i in telling.items() if h.endswith("-") and len(h) == 5}
        self.five = {h[:-1]: i for h, i in telling.items() if h.endswith("-") and len(h) == 6}

    def told(self, words) -> list[tuple[int, str]]:
        """Numbers of telling terms, each with the word that has it; a word can have several."""
        four, five = self.four, self.five
        found = [(four[w[:4]], w) for w in words if w[:4] in four and len(w) > 4]
        found += [(five[w[:5]], w) for w in words if w[:5] in five and len(w) > 5]
        return found + [(self.words[w], w) for w in self.words.keys() & words]

    def of(self, text: str | None) -> tuple:
        words = Counter(_WORD.findall((text or "").lower()))
        known = self.terms.keys() & words.keys()
        told: dict[int, int] = {}
        for h, w in self.told(words.keys()):
            told[h] = told.get(h, 0) + words[w]
        return ((np.array([self.terms[w] for w in known], np.int64), np.array([words[w] for w in known], np.int64)),
                (np.array(list(told), np.int64), np.array(list(told.values()), np.int64)))


def _example_hints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, toxic = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = {h for w in set(_WORD.findall((text or "").lower())) for h in _hints(w)}
            terms += own
            toxic += [label] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(toxic, pa.int32())], ["term", "toxic"])


def _telling_terms(examples: DataFrame) -> dict[str, int]:
    """Numbers of the terms that go with the label most: ``TELLING`` at most."""
    total = examples.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p")).first()
    n, p = total["n"], total["p"] or 0
    with_it, toxic = F.col("with_it").cast("double"), F.col("toxic").cast("double")
    cross = toxic * (n - p - with_it + toxic) - (with_it - toxic) * (p - toxic)
    chi = n * cross * cross / F.greatest(F.lit(1.0), with_it * (n - with_it) * F.lit(float(p) * (n - p)))
    found = (examples.select("text", "toxic").mapInArrow(_example_hints, "term string, toxic int")
             .groupBy("term").agg(F.count(F.lit(1)).alias("with_it"), F.sum("toxic").alias("toxic"))
             .where((F.col("with_it") > 1) & (cross > 0)).orderBy(chi.desc(), "term").limit(TELLING).select("term").toArrow())
    return {w: i for i, w in enumerate(found.column("term").to_pylist())}


def _held_by(cutter: _Cutter):
    """How many documents of a task hold each term, the telling ones numbered after the words; -1 counts the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = cutter.terms
        known, seen, told, total = terms.keys(), Counter(), Counter(), 0
        for batch in batches:
            total += batch.num_rows
            for text in batch.column("text").to_pylist():
                words = set(_WORD.findall((text or "").lower()))
                seen.update(known & words)
                told.update({h for h, _ in cutter.told(words)})
        numbers = [-1, *(terms[w] for w in seen), *(len(terms) + h for h in told)]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([total, *seen.values(), *told.values()], pa.int64())],
                                         ["term", "n"])
    return run


_FEATURES = "doc_id bigint, digest binary, words binary, counts binary, told binary, told_counts binary"


def _features(cutter: _Cutter):
    """Texts as numbers and counts of their terms, and their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            cut = [cutter.of(t) for t in texts]
            columns = [[x.astype("<i4").tobytes() for x in (v[k][j] for v in cut)] for k in (0, 1) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.binary()) for c in ([_digest(t) for t in texts], *columns))],
                ["doc_id", "digest", "words", "counts", "told", "told_counts"])
    return run


def _held_by_features(first_told: int):
    """As ``_held_by``, of features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(0, np.int64), 0
        for batch in batches:
            total += batch.num_rows
            for name, shift in (("words", 0), ("told", first_told)):
                n = np.bincount(np.frombuffer(b"".join(batch.column(name).to_pylist()), "<i4") + shift)
                if len(n) > len(seen):
                    seen = np.concatenate([seen, np.zeros(len(n) - len(seen), np.int64)])
                seen[:len(n)] += n
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some].astype(np.int32)), pa.array(np.r_[total, seen[some]])], ["term", "n"])
    return run


def _all_terms(examples: DataFrame) -> dict[str, int]:
    """Numbers of all words of the examples, those of most examples first."""
    found = (examples.select("text").mapInArrow(_example_terms, "term string")
             .groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow())  # as many as EXAMPLES texts can hold
    words = sorted(zip(found.column("n").to_pylist(), found.column("term").to_pylist()), key=lambda x: (-x[0], x[1]))
    return {w: i for i, (_, w) in enumerate(words)}


# ---- index -----------------------------------------------------------------------------

class Index:
    """Examples' unit vectors as an inverted index of blocks with their largest weights."""

    def __init__(self, vectors: list[tuple[list[int], list[int]]], labels: list[int], ids: list, idf: np.ndarray,
                 texts: list | None = None):
        self.idf, self.labels, self.ids = idf, np.array(labels, np.int64), ids
        self.same: dict = {}  # examples by the digest of their text
        for e, digest in enumerate(texts or []):
            self.same.setdefault(digest, []).append(e)
        self.prior = float(self.labels.sum()) / (len(labels) + 1)
        n = len(labels)
        self.blocks = max(1, -(-n // BLOCK))
        size = self.blocks * BLOCK
        # places: examples with like words side by side, so that a block's largest weights are near its own
        self.number = np.arange(size)
        self.number[:n] = sorted(range(n), key=lambda e: sorted(vectors[e][0])[:64])
        self.place = np.argsort(self.number)
        at, example, weight = self._weights([vectors[e] for e in self.number[:n]])
        order = np.argsort(at, kind="stable")
        at, example, weight = at[order], example[order], weight[order]
        lists = np.bincount(at, minlength=len(idf))
        often = np.argsort(-lists, kind="stable")[:COLUMNS]
        often = often[lists[often] > max(BLOCK, n // 32)]
        self.column = np.full(len(idf), -1, np.int32)
        self.column[often] = np.arange(len(often))
        common = self.column[at] >= 0
        self.common = np.zeros((size, len(often)))
        self.common[example[common], self.column[at[common]]] = weight[common]
        self.common = self.common.reshape(self.blocks, BLOCK, -1)
        self.most = self.common.max(axis=1)
        self.example, self.weight = example[~common], weight[~common]
        self.cuts = np.searchsorted(at[~common], np.arange(len(idf) + 1))

    def _weights(self, vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms, number of the vector, and weight in the unit vector, of all terms of all vectors."""
        none = [np.empty(0, np.int64)]
        at = np.concatenate([np.asarray(t, np.int64) for t, _ in vectors] + none)
        counts = np.concatenate([np.asarray(c, np.int64) for _, c in vectors] + none)
        owner = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        w = (1 + np.log(counts)) * self.idf[at]
        length = np.sqrt(np.bincount(owner, w * w, len(vectors)))
        return at, owner, w / np.maximum(length[owner], 1e-12)

    def weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self._weights([(terms, counts)])[2]

    def nearest(self, vectors: list, k: int, but: list[list[int]] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Numbers and cosines of the ``k`` nearest examples above 0 of each vector, ties by number.

        ``but``: the examples each vector leaves out.
        """
        out = []
        for start in range(0, len(vectors), AT_ONCE):
            out += self._nearest(vectors[start:start + AT_ONCE], k, but[start:start + AT_ONCE] if but else [])
        return out

    def _nearest(self, vectors: list, k: int, but: list[list[int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        n, size = len(vectors), self.blocks * BLOCK
        at, owner, q = self._weights(vectors)
        column = self.column[at]
        own = column >= 0
        dense = np.zeros((n, self.most.shape[1]))
        dense[owner[own], column[own]] = q[own]
        # words of few examples: their lists in full, one document after the other, which stays in the processor's cache
        few, listed = np.empty((n, size)), ~own
        begin, long, q = self.cuts[at[listed]], self.cuts[at[listed] + 1] - self.cuts[at[listed]], q[listed]
        ends = np.searchsorted(owner[listed], np.arange(n + 1))
        for d in range(n):
            a, b = ends[d], ends[d + 1]
            m = long[a:b]
            places = np.repeat(begin[a:b] - (np.cumsum(m) - m), m)
            places += np.arange(len(places))
            few[d] = np.bincount(self.example[places], self.weight[places] * np.repeat(q[a:b], m), size)
        for d, left_out in enumerate(but):
            few[d, self.place[left_out]] = -9.0
        few = few.reshape(n, self.blocks, BLOCK)
        bound = few.max(axis=2) + dense @ self.most.T
        sums = np.full(few.shape, -1.0)

        def opened(wanted):
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                d = np.flatnonzero(wanted[:, b])
                sums[d, b] = few[d, b] + dense[d] @ self.common[b].T

        most = np.argpartition(-bound, min(k // BLOCK + 3, self.blocks - 1), axis=1)[:, :k // BLOCK + 4]
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, most, True, axis=1)
        opened(first)
        some = np.take_along_axis(sums, most[:, :, None], axis=1).reshape(n, -1)
        # the k-th of these is not above the k-th of all
        reached = np.maximum(np.partition(some, -k, axis=1)[:, -k], 0.0) if some.shape[1] >= k else np.zeros(n)
        reached -= 1e-9
        opened((bound >= reached[:, None]) & ~first)
        out = []
        for d, row in enumerate(sums.reshape(n, size)):
            some = np.flatnonzero(row >= max(reached[d], 1e-12))
            # cosines that differ by rounding alone are ties
            order = np.lexsort((self.number[some], -np.round(row[some], 9)))[:k]
            out.append((self.number[some[order]], np.minimum(row[some[order]], 1.0)))
        return out

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """The share of toxic votes, each by 1 / (1.05 - cosine); the prior votes once at cosine 0."""
        weight, own = 1 / (1.05 - cosine), 1 / 1.05
        return float((weight @ self.labels[found] + own * self.prior) / (weight.sum() + own))


class Model:
    """The indexes of both spaces, and the curve from their votes to a probability."""

    def __init__(self, words: Index, told: Index, cutter: _Cutter):
        self.indexes, self.cutter = (words, told), cutter
        self.curve = np.array([0.5, 0.5, 0.0])

    def nearest(self, vectors: list[tuple], texts: list) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per space, the nearest examples of each document that are not its own text."""
        return [index.nearest([v[k] for v in vectors], NEIGHBOURS, [index.same.get(t, []) for t in texts])
                for k, index in enumerate(self.indexes)]

    def votes(self, nearest: list) -> np.ndarray:
        return np.array([[_logit(index.vote(*found)) for found in own] for index, own in zip(self.indexes, nearest)]).T

    def scores(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes @ self.curve[:2] + self.curve[2], -40.0, 40.0)))

    def calibrate(self, votes: np.ndarray) -> None:
        """The logistic curve from votes to labels, by Newton steps with a weak pull to the mean of both votes."""
        y, start = self.indexes[0].labels, self.curve
        design, beta = np.column_stack([votes, np.ones(len(votes))]), start
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
            beta = beta + np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.eye(3), design.T @ (y - p) - (beta - start))
        self.curve = np.array([max(0.0, beta[0]), max(0.0, beta[1]), beta[2]])


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _digest(text: str | None) -> bytes:
    return hashlib.blake2b((text or "").encode(), digest_size=16).digest()


class _Scorer:
    """Scores and evidence of texts; equal texts are scored once while they are remembered."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def of(self, digests: list[bytes], vector) -> list[tuple[float, list]]:
        """``vector(i)``: the terms of the i-th text in both spaces."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        model = self.model
        new = {d: i for i, d in enumerate(digests) if d not in self.known}
        nearest = model.nearest([vector(i) for i in new.values()], list(new))
        scores = model.scores(model.votes(nearest)).tolist() if new else []
        index = model.indexes[0]
        for d, score, (found, cosine) in zip(new, scores, nearest[0]):
            self.known[d] = score, [{"doc_id": index.ids[e], "cosine": c, "toxic": int(index.labels[e])}
                                    for e, c in zip(found[:EVIDENCE].tolist(), cosine[:EVIDENCE].tolist())]
        return [self.known[d] for d in digests]


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def _scored(model: bytes):
    """Scores of features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(_unpacked(model))
        for batch in batches:
            held = [batch.column(c).to_pylist() for c in ("words", "counts", "told", "told_counts")]

            def vector(i):
                words, counts, told, told_counts = (np.frombuffer(h[i], "<i4").astype(np.int64) for h in held)
                return (words, counts), (told, told_counts)
            got = scorer.of(batch.column("digest").to_pylist(), vector)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x for x, _ in got], pa.float64()), pa.array([w for _, w in got], _EVIDENCE)],
                ["doc_id", "score", "evidence"])
    return run


def _kept(model: bytes, cutter: _Cutter, limit: float):
    """The rows, as they are, that score below ``limit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(_unpacked(model))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = scorer.of([_digest(t) for t in texts], lambda i: cutter.of(texts[i]))
            yield batch.filter(pa.array([x < limit for x, _ in got], pa.bool_()))
    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with an id and text that this task has not given yet: ``EXAMPLES`` at most."""
    seen = set()
    for batch in batches:
        keep = []
        for key in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()):
            keep.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def examples_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, digest, text of at most ``EXAMPLES`` labelled documents outside the held-out third.

    One row for each id and text. Every id drawn gives one text before any gives a second one.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    drawn = (usable.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES))
    drawn = drawn.select(F.col("doc_id").alias("_labelled"), F.col("toxic").cast("int"))
    digested = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    texts = saved(digested.join(F.broadcast(drawn), F.col("doc_id") == F.col("_labelled"))
                  .groupBy("doc_id", "toxic", "digest").agg(F.count(F.lit(1)).alias("n")), "toxic-texts")
    first = texts.groupBy(F.col("doc_id").alias("_id")).agg(F.min("digest").alias("_first"))  # EXAMPLES rows at most
    chosen = (texts.join(F.broadcast(first), F.col("doc_id") == F.col("_id"))
              .orderBy(F.col("digest") != F.col("_first"), F.xxhash64("doc_id", "digest"), "doc_id", "digest").limit(EXAMPLES)
              .select(F.col("doc_id").alias("_labelled"), "toxic", F.col("digest").alias("_digest")))
    found = digested.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_labelled")) & (F.col("digest") == F.col("_digest")))
    return found.select("doc_id", "toxic", "digest", "text").mapInArrow(
        _once, "doc_id bigint, toxic int, digest bigint, text string").dropDuplicates(["doc_id", "digest"])


def vocabulary(examples: DataFrame) -> _Cutter:
    """The terms of both spaces."""
    return _Cutter(_all_terms(examples), _telling_terms(examples))


def _fitted(rows: list[dict], counts: dict[int, int], cutter: _Cutter) -> Model:
    """The model of the examples ``rows``; ``counts`` has the documents with each term."""
    n_words = len(cutter.terms)
    idf = np.array([1 + math.log((1 + counts.get(-1, 0)) / (1 + counts.get(t, 0))) for t in range(n_words + TELLING)])
    # EXAMPLES rows; their order decides ties, and does not know the label
    rows = sorted(rows, key=lambda r: (r["tie"], r["doc_id"]))
    texts, vectors = [_digest(r["text"]) for r in rows], [cutter.of(r["text"]) for r in rows]
    model = Model(*(Index([v[k] for v in vectors], [r["toxic"] for r in rows], [r["doc_id"] for r in rows], own, texts)
                    for k, own in enumerate((idf[:n_words], idf[n_words:]))), cutter)
    if rows:
        model.calibrate(model.votes(model.nearest(vectors, texts)))
    return model


def _packed(model: Model) -> bytes:
    """What the model holds, but for the cutter, which the driver has."""
    return pickle.dumps(([vars(index) for index in model.indexes], model.curve), pickle.HIGHEST_PROTOCOL)


def _unpacked(held: bytes, cutter: _Cutter | None = None) -> Model:
    indexes, curve = pickle.loads(held)
    made = [Index.__new__(Index) for _ in indexes]
    for index, own in zip(made, indexes):
        vars(index).update(own)
    model = Model(*made, cutter)
    model.curve = curve
    return model


def _learnt(cutter: _Cutter):
    """Examples and counts of terms, all rows in one task, to the parts of the pickled model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts = [], {}
        for batch in batches:
            counted = batch.column("term").is_valid()
            some = batch.filter(counted)
            counts.update(zip(some.column("term").to_pylist(), some.column("n").to_pylist()))
            rows += batch.filter(pa.compute.invert(counted)).select(["doc_id", "toxic", "text", "tie"]).to_pylist()
        held = _packed(_fitted(rows, counts, cutter))
        for part, at in enumerate(range(0, len(held), PART)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([held[at:at + PART]], pa.binary())], ["part", "held"])
    return run


def learnt(examples: DataFrame, cutter: _Cutter, held_by: DataFrame) -> bytes:
    """The examples' vectors in both spaces, indexed, and the curve; ``held_by`` has the documents (n) of a task for each term.

    A task makes the model of the ``EXAMPLES`` rows, and the driver hands it on as it is: working on them takes
    many times the size of the model.
    """
    drawn = examples.select("doc_id", "toxic", "text", F.xxhash64("doc_id", "digest").alias("tie"))
    counts = held_by.groupBy("term").agg(F.sum("n").alias("n"))  # a row for each term
    parts = (drawn.unionByName(counts, allowMissingColumns=True).coalesce(1)
             .mapInArrow(_learnt(cutter), "part int, held binary").toArrow())
    by_part = dict(zip(parts.column("part").to_pylist(), parts.column("held").to_pylist()))
    return b"".join(by_part[i] for i in sorted(by_part)) or _packed(_fitted([], {}, cutter))


def learn(examples: DataFrame, cutter: _Cutter, held_by: DataFrame) -> Model:
    """The model of ``learnt``."""
    return _unpacked(learnt(examples, cutter, held_by), cutter)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document.

    Null texts and texts without a known word have no neighbours: their score is the curve's value at
    the prior, without evidence. Without labels all scores are near 0.
    Repeated rows are scored each, equal texts alike. Nothing but the text enters a score.
    """
    examples = saved(examples_of(docs, labels), "toxic-examples")
    cutter = vocabulary(examples)
    # texts are cut once: what the scores need of them is kept
    kept = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_features(cutter), _FEATURES), "toxic-features")
    model = learnt(examples, cutter, kept.select("words", "told").mapInArrow(_held_by_features(len(cutter.terms)), "term int, n bigint"))
    return kept.mapInArrow(_scored(model), "doc_id bigint, score double, "
                           "evidence array<struct<doc_id: bigint, cosine: double, toxic: int>>").select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows predicted toxic."""
    examples = saved(examples_of(docs, labels), "toxic-examples")
    cutter = vocabulary(examples)
    model = learnt(examples, cutter, docs.select("text").mapInArrow(_held_by(cutter), "term int, n bigint"))
    return docs.mapInArrow(_kept(model, cutter, TOXIC_FROM), docs.schema)
