import random

import numpy as np
import pytest

from tests.llm.frames import SCHEMA, clashing
from wayfuse.llm import set_join
from wayfuse.llm.common import settings


def shingles_by_hand(text, each):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i:i + each]) for i in range(len(w) - each + 1)} if len(w) >= each else {tuple(w)}


def by_hand(rows, each, percent):
    sets = [shingles_by_hand(t, each) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for _ in range(12):  # chains of near copies: neighbours are linked, ends are not
        base = [rng.choice(words) for _ in range(rng.choice([9, 30, 60, 120]))]
        for _ in range(rng.randint(1, 9)):
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = rng.choice(words)
            if rng.random() < 0.3:
                base.insert(rng.randrange(len(base)), "more")
            texts.append(" ".join(base))
    for _ in range(40):  # one passage in many texts, most of some
        own = [rng.choice(words) for _ in range(rng.choice([0, 2, 4, 6, 8, 12, 30]))]
        texts.append(" ".join(own + passage))
    texts += [texts[0]] * 5 + [texts[3].upper(), "a b", "A  b", "b a", "", None, " \t", "one two three", "one two three four"]
    rng.shuffle(texts)
    return [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(1, texts[5]), (2, None)]


@pytest.mark.parametrize("seed, each, percent, block", [(1, 4, 85, 1024), (2, 4, 85, 3), (3, 5, 80, 7)])
def test_against_all_pairs(spark, seed, each, percent, block):
    settings(spark)
    rows = corpus(seed)
    frame = spark.createDataFrame([(i, t, "x", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    got = set_join.near_sets(clashing(frame) if seed == 2 else frame, each, percent, block)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, each, percent)


def test_empty(spark):
    settings(spark)
    assert set_join.near_sets(spark.createDataFrame([], SCHEMA)).count() == 0


def test_search_finds_all_links():
    rng = np.random.default_rng(5)
    for percent in (60, 85, 100):
        sets = []
        for _ in range(25):
            base = np.unique(rng.integers(0, 4000, rng.integers(1, 90)).astype(np.uint64))
            sets.append(base)
            for _ in range(rng.integers(0, 6)):
                keep = base[rng.random(len(base)) > 0.08]
                sets.append(np.unique(np.r_[keep, rng.integers(0, 4000, rng.integers(0, 4)).astype(np.uint64)]))
        sets = sorted((s for s in sets if len(s)), key=len)
        lists = set_join.Lists(sets)
        for s in sets:
            want = [j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= percent * len(np.union1d(s, t))]
            assert list(lists.search(s, percent, lambda _: False)) == want


def test_posted_parts_of_linked_sets_meet():
    rng = np.random.default_rng(6)
    for _ in range(2000):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 1000, n))
        b = np.unique(np.r_[a[rng.random(len(a)) > 0.1], rng.integers(0, 1000, rng.integers(0, 6))])
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 85 * len(np.union1d(a, b)):
            first = np.intersect1d(a[:set_join.posted(len(a), 85)], b[:set_join.posted(len(b), 85)])
            assert len(first) >= min(set_join.spare(len(a)), set_join.spare(len(b)))
            for s in (a, b):  # what a set asks for is no more than any partner's share
                assert set_join.spare(set_join.least_overlap(len(s), 85)) <= len(first)
