"""Components of an edge table: right for chains and rings, and no round where edges are stars already."""

from __future__ import annotations

import random

from wayfuse.operators import components as C


def _by_hand(edges):
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x
    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        top[high] = low
    return {x: root(x) for x in top}


def test_chains_rings_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(12)] + [(20, 22), (22, 21), (21, 20), (20, 20)] + [(30, k) for k in range(31, 40)]
    edges += [(rng.randrange(100, 140), rng.randrange(100, 140)) for _ in range(25)]
    got = C.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    linked = [(a, b) for a, b in edges if a != b]
    assert sorted(map(tuple, got)) == sorted(_by_hand(linked).items())


def test_stars_take_no_round(spark, monkeypatch):
    labels = []
    plain = C.saved
    monkeypatch.setattr(C, "saved", lambda df, label: labels.append(label) or plain(df, label))
    got = C.components(spark.createDataFrame([(5, 1), (1, 7), (3, 2)], "a long, b long"), "a", "b").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (3, 2), (5, 1), (7, 1)]
    assert labels == ["edges"]
