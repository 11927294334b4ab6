import hashlib
import random
import zlib

import numpy as np

from tests.llm.frames import SCHEMA, clashing
from wayfuse.llm import runs
from wayfuse.llm.common import settings


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def lyndon_by_hand(codes):
    out = []
    for i in range(len(codes)):
        j = i + 1
        while j < len(codes) and codes[j:] > codes[i:]:
            j += 1
        out.append(j - i)
    return out


def runs_by_hand(w):
    """Every (start, length, smallest period) of two periods at least that no neighbour extends."""
    n, found = len(w), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if j - i >= p and not any(w[i:i + length - q] == w[i + q:i + length] for q in range(1, p)):
                found.add((i, length, p))
            i = max(j, i + 1)
    return found


def sample(rng):
    c = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 40))]
    if rng.random() < 0.5:
        c += c[:rng.randint(1, 6)] * rng.randint(2, 7) + c[:5]
    return c


def test_lyndon_lengths_and_runs():
    rng = random.Random(1)
    for _ in range(400):
        c = sample(rng)
        dense = np.unique(c, return_inverse=True)[1]
        assert runs.lyndon_lengths(dense.tolist()) == lyndon_by_hand(dense.tolist())
        assert set(map(tuple, runs.runs_of(np.array(c), np.array([0, len(c)])).tolist())) == runs_by_hand(c)
    assert runs.lyndon_lengths([]) == [] and len(runs.runs_of(np.empty(0, np.int64), np.array([0]))) == 0


def report_by_hand(doc_id, text, edit=True):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if edit and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted((r for r in runs_by_hand(w) if r[1] >= max(6, 4 * r[2])), key=lambda r: (r[0], r[2]))
    gone = {i for s, n_, p in found for i in range(s + p, s + n_)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{n_},{p}\n" for s, n_, p in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_report(spark):
    settings(spark)
    rng = random.Random(2)
    texts = [" ".join(f"w{x}" for x in sample(rng)) for _ in range(300)]
    texts += ["", "\t\n ", "a a a a a a", "a a a a a", "a b " * 9, "x y z " * 4000, "é ß " * 3 + "é"]
    rows = [(i, t, "x", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", "s", 1), (None, "q q q q q q q", None, None, None),
                                                                 (7, None, None, None, None)]
    got = sorted(map(tuple, runs.run_report(frame(spark, rows).repartition(5)).collect()), key=str)
    short = [r for r in rows if r[1] is None or len(r[1]) < 20000]
    assert [g for g in got if g[0] != texts.index("x y z " * 4000)] == sorted(
        (report_by_hand(r[0], r[1]) for r in short if r[0] != texts.index("x y z " * 4000)), key=str)
    whole = runs.run_report(frame(spark, [(1, "x y z " * 4000, "x", "s", 1)]), edit=False).first()
    assert (whole.n_runs, whole.start, whole.length, whole.period, whole.exponent_milli) == (1, 0, 12000, 3, 4_000_000)


def test_collapse(spark):
    settings(spark)
    docs = clashing(frame(spark, [(1, "go  on and on and on and on and\non", "x", "s", 1), (2, "as  it is", "x", "s", 1),
                                  (2, None, "x", "s", 1), (None, "", "x", "s", 1)]))
    got = runs.collapse_runs(docs)
    assert got.columns == docs.columns
    assert sorted((r.text for r in got.collect()), key=str) == sorted(["go on and", "as  it is", None, ""], key=str)
    assert runs.run_report(frame(spark, [])).count() == 0 and runs.collapse_runs(frame(spark, [])).count() == 0
    assert runs.run_report(clashing(frame(spark, [(1, "a", "x", "s", 1)]))).count() == 1
