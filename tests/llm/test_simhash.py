import random

import xxhash

from wayfuse.llm import simhash
from wayfuse.llm.common import settings


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(4, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (id, fp); returns id -> smallest id linked by a chain."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (k, _) in enumerate(fps):
        least[root(i)] = min(least.get(root(i), k), k)
    return {k: least[root(i)] for i, (k, _) in enumerate(fps)}


def texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            words = rng.choice(out).split()
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        else:
            out.append(" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 4, 5, 40, 200]))))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_against_brute_force(spark):
    settings(spark)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts(250))]
    rows += [(900, None, None, None, None), (901, "", None, None, 0), (902, " \t\n", "", "", 3),
             (903, "ÄB c\x0bd E", "", "", 1), (904, "äb c d e", "", "", 1)]
    got = {r.doc_id: r for r in simhash.simhash_groups(frame(spark, rows)).collect()}
    fps = [(r[0], brute_fp(r[1])) for r in rows]
    want = brute_components(fps)
    assert len(got) == len(rows)
    for k, fp in fps:
        assert got[k].fingerprint == f"{fp:016x}"
        assert got[k].component_id == want[k]


def test_links_survive_overfull_buckets(spark, monkeypatch):
    settings(spark)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 60)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base}
    for _ in range(400):  # a chain of steps of up to four bits, and a ball around its start
        x = rng.choice([base, rng.choice(sorted(fps))])
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    rows = sorted(fps)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in rows]
    edges = simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    want = brute_components(list(enumerate(rows)))
    number = {x[0]: i for i, x in enumerate(signed)}
    parent = {i: i for i in number.values()}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in ((number[e.a], number[e.b]) for e in edges):
        assert (rows[a] ^ rows[b]).bit_count() <= 4
        parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i in sorted(number.values()):
        least.setdefault(root(i), i)
    assert {i: least[root(i)] for i in number.values()} == want


def test_keeps_one_of_each(spark):
    settings(spark)
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a, "x", "s", 1), (1, a, "x", "s", 1), (1, a, "x", "s", 1), (7, b, "x", "s", 1),
            (8, None, None, None, None), (9, "", None, None, None), (None, b, None, None, None)]
    rows += [(2, b, "x", "s", 1), (2, "q r s t u v", "x", "s", 1)]  # one id, one text of group b and one of its own
    got = simhash.one_of_each(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = got.collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id != 2 and r.doc_id != 8) == [(1, a)]
    assert [r.doc_id for r in kept if r.doc_id == 8] == [8]
    assert len([r for r in kept if r.doc_id == 2]) == 2
    assert simhash.one_of_each(frame(spark, [])).count() == 0
    assert simhash.simhash_groups(frame(spark, [])).count() == 0


def test_groups_with_one_id_keep_a_row_each(spark):
    settings(spark)
    some = ["a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z aa bb", "cc dd ee ff gg hh ii"]
    rows = [(None, some[0]), (None, some[0]), (None, some[1]), (None, some[2]), (4, some[2]),  # no id; the last has one beside it
            (5, some[3]), (5, some[4]), (5, some[4]), (6, some[4])]
    got = simhash.one_of_each(frame(spark, [(k, t, "en", "s", 1) for k, t in rows])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [
        (0, some[0]), (0, some[1]), (4, some[2]), (5, some[4]), (5, some[3])]
