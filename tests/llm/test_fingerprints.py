import hashlib
import random

from wayfuse.llm import fingerprints
from wayfuse.llm.common import settings
from tests.llm.frames import clashing, docs


def shingles(text):
    w = text.encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_against_brute_force(spark, monkeypatch):
    settings(spark)
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(500)] + ["é", "日本"]
    rows = [(i * 3 - 50, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 4, 5, 6, 40, 300, 900])))) for i in range(120)]
    rows += [(1000, None), (-999, rows[-1][1]), (None, "only one")]
    for each in (7, 2000):
        monkeypatch.setattr(fingerprints, "RANGE_ROWS", each)
        got = {r.doc_id: r for r in fingerprints.fingerprints(clashing(docs(spark, rows))).collect()}
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
        gaps = []
        for i, (k, t) in enumerate(order):
            t, follower = t or "", order[(i + 1) % len(order)][1] or ""
            m = len(t) // 3
            edited = t[:len(t) - m] + follower[:m]
            r = got[k]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            gaps += [abs(r.near_edited - jaccard(t, edited)), abs(r.near_next - jaccard(t, follower))]
            assert len(r.fingerprint) == 2 * fingerprints.BINS and 0 <= r.near_next <= 1
        assert len(got) == len(rows) and sum(gaps) / len(gaps) < 0.02 and max(gaps) < 0.25
        assert got[-999].fingerprint == got[rows[119][0]].fingerprint
        assert got[1000].near_edited == 1.0


def test_lone_and_repeated_rows(spark):
    settings(spark)
    lone = fingerprints.fingerprints(docs(spark, [(1, "abcdef")])).collect()
    assert [(r.n_chars, r.edited_sha256) for r in lone] == [(6, hashlib.sha256(b"abcdab").hexdigest())]
    assert lone[0].near_next == 1.0
    twice = fingerprints.fingerprints(docs(spark, [(1, "a b"), (1, "a b"), (0, "c")])).collect()
    assert len(twice) == 3
    assert fingerprints.fingerprints(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    settings(spark)
    plan = fingerprints.fingerprints(docs(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
