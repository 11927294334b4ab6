import hashlib
import random
from collections import Counter

import pytest

from wayfuse.llm import lempel_ziv
from wayfuse.llm.common import settings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts, w):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(d[i:i + w]) for d in words for i in range(len(d) - w + 1))
    out = []
    for d in words:
        gone = [False] * len(d)
        for i in range(len(d) - w + 1):
            if seen[tuple(d[i:i + w])] > 1:
                gone[i:i + w] = [True] * w
        kept = [x for x, g in zip(d, gone) if not g]
        out.append((len(d), len(d) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "ü x", "a b"]
    passages = [rng.choices(vocabulary, k=k) for k in (34, 35, 36, 50, 90, 200)]
    docs = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else rng.choices(vocabulary, k=rng.randint(1, 80))
        docs.append(rng.choice([" ", "\n", " \t", "  "]).join(words))
    return docs + docs[:4] + [None, "", "  ", "a " * 70, ("b c " * 40).strip()]


@pytest.mark.parametrize("chunk", [1, 4000, 1 << 20])
def test_against_brute_force(spark, monkeypatch, chunk):
    settings(spark)
    monkeypatch.setattr(lempel_ziv, "CHUNK_BYTES", chunk)
    texts = corpus(random.Random(chunk), 60)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = lempel_ziv.dedup_digest(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == dict(enumerate(brute(texts, 35)))


def test_rows_repeat_and_ids_are_missing(spark):
    settings(spark)
    long = " ".join(f"x{i}" for i in range(40))
    rows = [(1, long, None, None, None), (1, long, None, None, None), (None, "q " + long, None, None, None),
            (2, "a b", None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS digest", "3 AS starts")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in lempel_ziv.dedup_digest(frame).collect())
    assert got == [("1", 40, 40), ("1", 40, 40), ("2", 2, 0), ("None", 41, 40)]
    assert lempel_ziv.dedup_digest(frame.limit(0)).count() == 0


def test_removal_keeps_the_rest(spark):
    settings(spark)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(1, f"Head one.\n{shared}\nTail.", "en", "a", 5), (2, f"{shared} end", "en", "a", 6), (3, "alone\n here", "en", "a", 7)]
    got = lempel_ziv.remove_spans(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {
        1: ("Head one.\nTail.", 15), 2: ("end", 3), 3: ("alone\n here", 11)}


def test_a_task_holds_little_beside_its_text():
    """Words and hashes of 11 MB of text are not held at once."""
    import tracemalloc

    import pyarrow as pa

    def batches():
        for _ in range(10):
            texts = [" ".join(f"w{k % 999}" for k in range(j, j + 10000)).encode() for j in range(23)]
            ids = pa.array(range(len(texts)), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], ["id", "digest", "_text"])

    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in lempel_ziv._filed(8, 35, 8)(batches())) >= 8
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 120 << 20, peak >> 20


def test_hashes_are_not_shuffled_beside_texts(spark):
    """The runs of repeated windows are a written table by the time texts are joined with them."""
    settings(spark)
    rows = [(i, " ".join(f"x{k}" for k in range(i, 60)), "en", "s", 0) for i in range(3)]
    done = lempel_ziv.remove_spans(spark.createDataFrame(rows, SCHEMA))
    plan = done._jdf.queryExecution().toString()
    assert "FlatMapGroupsInArrow" not in plan and "repeated-windows" in plan
    assert done.count() == 3
