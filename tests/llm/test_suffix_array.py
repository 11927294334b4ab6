import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from wayfuse.llm import suffix_array
from wayfuse.llm.common import settings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_suffix_order():
    rng = random.Random(1)
    for n in [*range(1, 40), 200, 1001]:
        for letters in (1, 2, 5, 200):
            t = [rng.randint(1, letters) for _ in range(n)]
            assert suffix_array.suffix_array(np.array(t)).tolist() == sorted(range(n), key=lambda i: t[i:])


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    letters = "abcdefgh é"
    passages = ["".join(rng.choices(letters, k=k)) for k in (398, 399, 400, 401, 700, 2000)]
    docs = []
    for _ in range(40):
        docs.append("".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randint(1, 300)))
                            for _ in range(rng.randint(0, 5))))
    long = passages[5]
    docs += docs[:3] + [None, "", "x" * 399, "y" * 400, "z" * 401, "ab" * 300, long[100:900] + "q" + long[300:1500]]
    return docs + [long[i:i + 800] for i in range(0, 1200, 90)]


@pytest.mark.parametrize("chunk, block", [(1, 1), (5000, 3000), (1 << 20, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, chunk, block):
    settings(spark)
    monkeypatch.setattr(suffix_array, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(suffix_array, "BLOCK_BYTES", block)
    texts = corpus(random.Random(chunk))
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).selectExpr("*", "1 AS id", "2 AS row")
    got = suffix_array.dedup_bytes(frame.repartition(3))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == dict(enumerate(brute(texts, 400)))


def test_empty_table_and_repeated_rows(spark):
    settings(spark)
    rows = [(None, "k" * 10 + "".join(map(str, range(300))), None, None, None)] * 2
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [(r.n_removed, r.n_bytes) for r in suffix_array.dedup_bytes(frame).collect()] == [(800, 800)] * 2
    assert suffix_array.dedup_bytes(frame.limit(0)).count() == 0
