"""Packing documents into sequences: best fit, then swap-based local search.

Groups of pieces are packed apart: best fit by falling length, then moves and exchanges
between underfull sequences that raise the sum of squared fills, until the emptiest
sequences are empty. The emptiest sequences of many groups are opened again and
packed together, level by level, until one group is left.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import saved

LENGTH = 2048
GROUP = 16_384
OPENED = 32  # sequences of a group that the next level may pack anew
FAN = 64  # groups whose opened sequences meet
END_ID = 0
CACHED = 300_000
TOKENIZER = "byte_bpe_50k"


# ---- tokens ----------------------------------------------------------------------------

# Inside a run of white space a space is a token of its own only where it ends the run.
_INSIDE_RUN = re.compile(r"\s (?:\s|\Z)")
_SPECIAL = "<|endoftext|>"


class _Cut(dict):
    """Numbers of words already cut into ids; ``lead`` is put before each word."""

    def __init__(self, lead, encode, flat, ends):
        self.lead, self.encode, self.flat, self.ends = lead, encode, flat, ends

    def __missing__(self, word):
        self.flat.extend(self.encode(self.lead + word))
        self.ends.append(len(self.flat))
        self[word] = len(self.ends) - 2
        return self[word]


class _Ids:
    """Ids of whole texts. Most are put together from cached words: the vocabulary's pattern never
    joins the end of a word to the space after it. Texts with other runs of white space, or with
    the name of a special id, go through the tokenizer as they are."""

    def __init__(self, tokenizer: str):
        import base64
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{tokenizer}.json"))
        with open(public_tokenizers.path(f"{tokenizer}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding(tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        self.forget()

    def forget(self):
        self.flat, self.ends = array("I"), array("q", [0])
        self.bare, self.spaced = (_Cut(lead, self.words, self.flat, self.ends) for lead in ("", " "))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts one after another (uint32), and the end of each text among them."""
        if len(self.ends) > CACHED:
            self.forget()
        plain = [not (_INSIDE_RUN.search(t) or _SPECIAL in t) for t in texts]
        slow = iter(self.whole.encode_batch([t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        numbers, counts = [], []
        for text, cached in zip(texts, plain):
            if cached:
                first, *rest = text.split(" ")
                numbers.append(self.bare[first])
                numbers.extend(map(self.spaced.__getitem__, rest))
                counts.append(len(rest) + 1)
            else:
                self.flat.extend(next(slow).ids)
                self.ends.append(len(self.flat))
                numbers.append(len(self.ends) - 2)
                counts.append(1)
        flat, ends = np.array(self.flat, np.uint32), np.array(self.ends)
        numbers = np.array(numbers, np.int64)
        starts, lengths = ends[numbers], ends[numbers + 1] - ends[numbers]
        upto = np.cumsum(lengths)
        ids = flat[np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1] if len(upto) else 0)]
        return ids, np.r_[0, upto][np.cumsum(counts)]


def _pieces(tokenizer: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _Ids(tokenizer)
        for batch in batches:
            rows, texts = [], batch.column("text").to_pylist()
            ids, ends = ids_of.of(texts)
            start = 0
            for doc, end in enumerate(ends.tolist()):
                own = ids[start:end].astype("<u4").tobytes() + END_ID.to_bytes(4, "little")
                n = end - start + 1
                at, to, number = 0, n % length or length, 0
                while at < n:
                    rows.append((doc, number, at, to - at, zlib.crc32(own[4 * at:4 * to])))
                    at, to, number = to, to + length, number + 1
                start = end
            doc, number, at, size, crc = (list(c) for c in zip(*rows)) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(number, pa.int32()),
                 pa.array(at, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids and the end id, cut where longer than ``length``.

    The first piece of a cut text takes what does not fill a sequence. A null text is empty
    and gives the end id alone.
    """
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _pieces(tokenizer, length), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


# ---- packing ---------------------------------------------------------------------------

def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms: list[int] = []  # the rooms some bin has, ascending
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        at = bisect.bisect_left(rooms, n)
        if at == len(rooms):
            bins.append([i])
            b, room = len(bins) - 1, most - n
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
            room -= n
        if room:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append(b)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], most: int) -> list[list[int]]:
    """``bins`` after moves and exchanges among the underfull ones; emptied bins are gone.

    Takes the emptiest bin and tries, for each of its items and pairs of items: to move it
    into another bin, to exchange it for a shorter item of another bin, or for two items
    that are shorter together; of the partners the one left with the least room. An
    exchange is made only if it raises the sum of squared fills, which ends the search.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    order = sorted((b for b in range(len(bins)) if fill[b] < most), key=lambda b: (fill[b], b))
    partners = _Partners(bins, lengths, fill, order, most)
    for e in order:
        partners.close(e)
        moved = True
        while moved and bins[e]:
            moved = False
            own = sorted(bins[e], key=lambda i: -lengths[i])
            pairs = [(i, j) for x, i in enumerate(own[:24]) for j in own[x + 1:24]]
            for given in [(i,) for i in own] + pairs:
                size = sum(lengths[i] for i in given)
                found = partners.best(size, fill[e], len(given))
                if found is None:
                    continue
                b, taken = found
                back = sum(lengths[i] for i in taken)
                bins[e] = [i for i in bins[e] if i not in given] + list(taken)
                bins[b] = [i for i in bins[b] if i not in taken] + list(given)
                fill[e] += back - size
                fill[b] += size - back
                partners.refresh(b)
                moved = True
                break
        if bins[e]:
            break  # fuller bins are harder to empty
    return [b for b in bins if b]


class _Partners:
    """What underfull bins can give back for an item: nothing, one item or two, with the room that leaves."""

    def __init__(self, bins, lengths, fill, order, most):
        self.bins, self.lengths, self.fill, self.most = bins, lengths, fill, most
        self.open = set(order)
        self.rows: dict[int, list] = {}
        self.table = None
        for b in order:
            self.rows[b] = self._of(b)

    def _of(self, b):
        room, own = self.most - self.fill[b], self.bins[b]
        out = [(0, room, b, (), self.fill[b])]
        out += [(self.lengths[i], room + self.lengths[i], b, (i,), self.fill[b]) for i in own]
        few = own[:16]
        out += [(self.lengths[i] + self.lengths[j], room + self.lengths[i] + self.lengths[j], b, (i, j), self.fill[b])
                for x, i in enumerate(few) for j in few[x + 1:]]
        return out

    def close(self, b):
        self.open.discard(b)
        self.rows.pop(b, None)
        self.table = None

    def refresh(self, b):
        if self.fill[b] < self.most and b in self.open:
            self.rows[b] = self._of(b)
        else:
            self.close(b)
        self.table = None

    def best(self, size, fill, given):
        """The partner with the least room left that takes ``size``, gives back less, and ends fuller than ``fill``."""
        if self.table is None:
            every = [r for rows in self.rows.values() for r in rows]
            every.sort(key=lambda r: (r[1], r[0], r[2]))
            self.table = every, np.array([r[0] for r in every], np.int64), np.array([r[1] for r in every], np.int64), \
                np.array([r[4] for r in every], np.int64), np.array([len(r[3]) for r in every])
        every, back, takes, fills, n = self.table
        start = int(np.searchsorted(takes, size))
        ok = (back[start:] < size) & (fills[start:] + size - back[start:] > fill) & (n[start:] + given <= 3)
        at = int(ok.argmax()) if len(ok) else 0
        return (every[start + at][2], every[start + at][3]) if len(ok) and ok[at] else None


def _packed(level: int, length: int, opened: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_no"], ascending=[False, True])
        lengths = rows["length"].tolist()
        bins = local_search(best_fit(lengths, length), lengths, length)
        fills = [sum(lengths[i] for i in b) for b in bins]
        again = set() if last else set(sorted((b for b in range(len(bins)) if fills[b] < length),
                                              key=lambda b: (fills[b], b))[:opened])
        number, offset, open_ = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for b, own in enumerate(bins):
            at = 0
            for i in own:
                number[i], offset[i], open_[i] = b, at, b in again
                at += lengths[i]
        group = int(rows["grp"].iloc[0])
        return rows.assign(sequence_id=(level << 58) + (group << 20) + number, offset=offset, open=open_.astype(bool))
    return run


_ROW = "row_no bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, grp bigint"


def pack(rows: DataFrame, length: int = LENGTH, group: int = GROUP, opened: int = OPENED, fan: int = FAN) -> DataFrame:
    """``rows`` (of :func:`pieces`) plus ``sequence_id`` and ``offset``, at most ``length`` ids in a sequence.

    Every piece is placed once. No group holds more than about ``group`` pieces, whatever
    repeats: pieces are dealt by their row number.
    """
    rows = saved(rows.withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(rows.count() / group))
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("row_no"), F.lit(groups)))
    placed, level = None, 0
    while True:
        last = groups == 1
        got = saved(rows.groupBy("grp").applyInPandas(
            _packed(level, length, opened, last), _ROW + ", sequence_id bigint, offset bigint, open boolean"),
            f"packed-{level}")
        done = got.where("NOT open").drop("open", "row_no", "grp")
        placed = done if placed is None else placed.unionByName(done)
        if last:
            return placed
        rows = got.where("open").drop("open", "sequence_id", "offset").withColumn("grp", F.floor(F.col("grp") / fan))
        groups, level = math.ceil(groups / fan), level + 1


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Rows that repeat are packed as often as they stand; a null doc_id stays null; an empty
    table gives no pieces.
    """
    return pack(pieces(docs, length, tokenizer), length)
