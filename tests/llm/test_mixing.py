import random

import numpy as np

from wayfuse.llm import mixing
from wayfuse.llm.common import settings
from tests.llm.frames import clashing, docs


def brute_targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * per > 3 * sizes[s]}
        if not full:
            return out | {s: w[s] * per for s in open_}
        for s in full:
            out[s] = 3 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def corpus(rng, n=400):
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 60])), rng.choice(["a", "a", "a", "b", "Z", "é", None, ""])) for i in range(n)]


def test_targets_and_sums(spark):
    settings(spark)
    rows = corpus(random.Random(4)) + [(1000, None, "a"), (1001, "x y", "tiny")]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    got = mixing.mix_report(clashing(docs(spark, rows))).collect()
    size_of = {k: len((t or "").split()) for k, t, _ in rows}
    source_of = {k: s for k, _, s in rows}
    taken = {}
    assert sorted(r.doc_id for r in got) == sorted(size_of)
    for r in got:
        assert r.size == size_of[r.doc_id] and r.source_size == sizes[source_of[r.doc_id]]
        assert abs(r.target - want[source_of[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[source_of[r.doc_id]] = taken.get(source_of[r.doc_id], 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60
    again = mixing.mix_report(docs(spark, rows[::-1])).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}


def test_tree_of_many_blocks(spark):
    settings(spark)
    rng = random.Random(8)
    rows = [(i, i * 7919, "a" if i % 3 else "b", rng.randint(1, 40), 0.3) for i in range(600)]
    units = spark.createDataFrame(rows, "unit long, draw long, source string, size long, share double")
    got = {r.unit: r.share for r in mixing.rounded_shares(units, block=8).collect()}
    assert set(got) == {r[0] for r in rows} and set(got.values()) == {0.0, 1.0}
    for s in "ab":
        own = [r for r in rows if r[2] == s]
        assert abs(sum(r[3] * got[r[0]] for r in own) - 0.3 * sum(r[3] for r in own)) <= 40


def test_chances_are_kept():
    rng = np.random.default_rng(1)
    share, size = np.array([0.2, 0.5, 0.7, 0.35, 0.6]), np.array([3.0, 9.0, 4.0, 1.0, 2.0])
    mean = np.zeros(5)
    for _ in range(20_000):
        mean += mixing._pivot(share, size, rng.random(5))[0]
    assert np.abs(mean / 20_000 - share).max() < 0.02


def test_documents_repeat(spark):
    settings(spark)
    frame = docs(spark, [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, None), (3, "d " * 50, "y")])
    got = mixing.mix_documents(frame)
    assert got.columns == frame.columns
    report = mixing.mix_report(frame).collect()
    assert got.where("doc_id = 3").count() * 50 == sum(r.taken for r in report if r.doc_id == 3)
    assert mixing.mix_report(docs(spark, [])).count() == 0 and mixing.mix_documents(docs(spark, [])).count() == 0
