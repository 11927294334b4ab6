"""Line-first cleaning: rules look at single lines, failed lines go, then documents that lose too much.

A line with words fails if

* punctuation: runs of symbols or of exclamation and question marks stand beside more than 3 of 10 words;
* navigation: separators such as ``|`` make up more than 3 of 10 words;
* unfinished: it has at least ``UNFINISHED`` words and no mark that ends a sentence anywhere;
* boilerplate: it has one of the set phrases, or repeats an earlier line of its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfuse.llm.common import batches_by_bytes
from wayfuse.llm.lempel_ziv import _WordHash, _mix, _powers, first_of_equal, rolling

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MOST_LOST = 40  # per cent of the words, in failed lines
UNFINISHED = 30
CHUNK_BYTES = 8 << 20
SYMBOLS = "#*$%&|<>"

_BLANK = " \t\n\x0b\x0c\r"
_MARKS = re.compile(r"[#*$%&]{2,}|[!?]{2,}")
_SEPARATORS = re.compile(r"[|<>»•]")
_ENDING = re.compile(r"[.!?…:;。]")
# Fixed phrases, matched in lower case.
PHRASES = ("all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service", "terms of use",
           "enable javascript", "subscribe to our newsletter", "sign up for", "click here", "share this", "lorem ipsum")
_PHRASES = re.compile("|".join(map(re.escape, PHRASES)))


def line_fails(line: str, n_words: int) -> bool:
    """One of the rules on a single line holds; ``n_words`` over 0."""
    if 10 * len(_MARKS.findall(line)) > 3 * n_words or 10 * len(_SEPARATORS.findall(line)) > 3 * n_words:
        return True
    return (n_words >= UNFINISHED and not _ENDING.search(line)) or bool(_PHRASES.search(line.lower()))


def cleaned(text: str) -> tuple[str, int, int]:
    """``text`` without failed lines, the words lost, and the number of lines equal to an earlier one."""
    seen: set[str] = set()
    kept, lost, repeated = [], 0, 0
    for line in text.split("\n"):
        n = len(_words(line))
        if n:
            again = line in seen
            repeated += again
            seen.add(line)
            if again or line_fails(line, n):
                lost += n
                continue
        kept.append(line)
    return "\n".join(kept), lost, repeated


def _words(text: str) -> list[bytes]:
    return text.encode().split()  # of bytes: ASCII white space only


def _repeat_words(docs: list[list[bytes]], word_hash, width: int = 3) -> np.ndarray:
    """Per document, the words in windows of ``width`` words found twice or more in it."""
    n = np.fromiter(map(len, docs), np.int64, len(docs))
    total = int(n.sum())
    values = np.fromiter((word_hash[w] for d in docs for w in d), np.uint64, total)
    ends = np.cumsum(n)
    hashes = rolling(values, width, _powers(max(1, total)))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(hashes))
    inside = at + width <= ends[row[: len(hashes)]]
    at = at[inside]
    _, twice = first_of_equal(_mix(hashes[inside] + _mix(row[at].astype(np.uint64))))
    mark = np.zeros(total + 1, np.int64)
    np.add.at(mark, at[twice], 1)
    np.add.at(mark, at[twice] + width, -1)
    return np.bincount(row[np.cumsum(mark)[:total] > 0], minlength=len(n)) if total else np.zeros(len(n), np.int64)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    word_hash = _WordHash()
    for table in batches_by_bytes(batches, "text", CHUNK_BYTES):
        texts = [t or "" for t in table.column("text").to_pylist()]
        docs = [_words(t) for t in texts]
        repeats = _repeat_words(docs, word_hash)
        rows = []
        for text, words, again in zip(texts, docs, repeats.tolist()):
            _, lost, repeated = cleaned(text)
            rows.append((len(words), len(text) - sum(map(text.count, _BLANK)), sum(map(text.count, SYMBOLS)),
                         repeated, again, lost))
        at = table.schema.get_field_index("text")
        rest = [c for i, c in enumerate(table.columns) if i != at]
        names = [x for x in table.schema.names if x != "text"]
        columns = np.array(rows, np.int64).reshape(-1, len(_MEASURES))
        made = pa.table([*rest, *(pa.array(columns[:, i]) for i in range(len(_MEASURES)))], names=[*names, *_MEASURES])
        yield from made.to_batches()


def measures(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the measures of every whole text (null: all 0)."""
    slim = docs.select(*columns, "text")
    kinds = [f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in columns]
    return slim.mapInArrow(_measured, ", ".join([*kinds, *(f"{m} bigint" for m in _MEASURES)]))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words.

    Every row of ``docs`` is judged by itself; null and empty texts have no words and fail.
    """
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    lost = 100 * F.col("n_lost_words") > MOST_LOST * F.col("n_words")
    return measures(docs, "doc_id").withColumns({"base_failed": base, "kept": ~base & ~lost})


def _rewritten(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([cleaned(t)[0] for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([made if c == "text" else batch.column(c) for c in columns], columns)
    return run


def clean_documents(docs: DataFrame) -> DataFrame:
    """``docs`` that are kept, all columns, their failed lines removed; n_chars, if there, is counted anew."""
    columns = docs.columns
    clash = {c: f"_own_{c}" for c in columns if c in _MEASURES}
    named = docs.withColumnsRenamed(clash).withColumn("_whole", F.col("text"))
    own = [clash.get(c, c) for c in columns if c != "text"]
    base = (F.col("n_words") >= LEAST_WORDS) & (100 * F.col("n_repeat_words") <= MOST_REPEATED * F.col("n_words"))
    kept = measures(named, *own, "_whole").where(base & (100 * F.col("n_lost_words") <= MOST_LOST * F.col("n_words")))
    kept = kept.withColumnRenamed("_whole", "text").select(*own, "text").withColumnsRenamed({v: k for k, v in clash.items()})
    done = kept.select(*columns).mapInArrow(_rewritten(columns), docs.schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


_ALT = "|".join(PHRASES)
ORACLE = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
lines AS (
  SELECT doc_id, line, n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM (
    SELECT doc_id, line, i, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM (
      SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs))
  WHERE n > 0),
by_line AS (
  SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(n) FILTER (
    again OR 10 * len(regexp_extract_all(line, '[#*$%&]{{2,}}|[!?]{{2,}}')) > 3 * n
    OR 10 * len(regexp_extract_all(line, '[|<>»•]')) > 3 * n
    OR n >= {UNFINISHED} AND NOT regexp_matches(line, '[.!?…:;。]')
    OR regexp_matches(lower(line), '{_ALT}')), 0) AS lost
  FROM lines GROUP BY doc_id),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) > 1 AS twice FROM (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k:k+2])) AS g
    FROM words WHERE len(w) >= 3)),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE twice)
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(r, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words
  FROM words LEFT JOIN by_line USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND 100 * n_lost_words <= {MOST_LOST} * n_words AS kept FROM judged
"""
