import math
import os
import random
import zlib
from collections import Counter

import numpy as np

from wayfuse.llm import toxicity
from wayfuse.llm.common import settings
from tests.llm.frames import clashing, docs


def corpus(rng, n=400):
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = rng.choices(plain, k=rng.randint(5, 60))
        for w in rng.sample(["nasty", "vile", "FOUL", "rotten"], 3) * 2 if bad else []:
            words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_and_holds_out(spark):
    settings(spark)
    rows, labels = corpus(random.Random(3))
    truth = {k: t for k, _, t in labels}
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, q, t in labels]  # never learnt from
    rows += [(900, None), (901, ""), (902, "12 !"), (1, rows[1][1]), (None, "nasty vile FOUL nasty")]
    frame = clashing(docs(spark, rows))
    got = toxicity.toxicity_scores(frame, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
    assert {r.predicted for r in got if r.doc_id in (900, 901, 902)} == {0}
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    kept = toxicity.drop_toxic(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.where("doc_id < 400").collect()) == sorted([k for k, t in truth.items() if not t] + [1])


def test_without_labels_or_documents(spark):
    settings(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity_scores(docs(spark, [(1, "a"), (2, None)]), none).collect()} == {0}
    assert toxicity.toxicity_scores(docs(spark, []), none).count() == 0


def test_nearest_is_exact():
    rng = random.Random(5)
    terms = 40
    idf = np.array([1 + rng.random() * 5 for _ in range(terms)])
    vectors = []
    for _ in range(700):
        own = sorted(rng.sample(range(terms), rng.randint(0, 6)))
        vectors.append((own, [rng.randint(1, 4) for _ in own]))
    index = toxicity.Index(vectors, [i % 5 == 0 for i in range(700)], list(range(700)), idf)
    dense = np.zeros((700, terms))
    for i, (t, c) in enumerate(vectors):
        dense[i, t] = index.weights(np.array(t, np.int64), np.array(c, np.int64))
    asked = list(range(0, 700, 7))
    left_out = [[i, 3, 9] if i % 2 else [] for i in asked]
    for i, but, (found, cosine) in zip(asked, left_out, index.nearest([vectors[i] for i in asked], 9, left_out)):
        sims = np.round(dense @ dense[i], 9)
        want = [j for j in sorted(range(700), key=lambda j: (-sims[j], j)) if sims[j] > 0 and j not in but][:9]
        assert found.tolist() == want and np.allclose(cosine, sims[want])


def test_a_common_id_gives_each_text_once(spark, monkeypatch):
    settings(spark)
    monkeypatch.setattr(toxicity, "EXAMPLES", 6)
    own = [k for k in range(30) if zlib.crc32(str(k).encode()) % 3 != 1][:4]
    rows = [(k, f"text of {k}") for k in own] + [(own[0], "the same text")] * 50 + [(own[0], f"text {i}") for i in range(20)]
    labels = spark.createDataFrame([(k, 1, 1) for k in own], "doc_id long, quality int, toxic int")
    got = toxicity.examples_of(docs(spark, rows), labels).select("doc_id", "toxic", "text").collect()
    assert len(got) == len(set(got)) == 6 and {r.doc_id for r in got} == set(own)


def brute_force(texts, wanted):
    """Cosines of every text with the ``wanted`` ones, every word counted."""
    words = [Counter((t or "").lower().split()) for t in texts]
    df = Counter(w for c in words for w in c)
    idf = {w: 1 + math.log((1 + len(texts)) / (1 + n)) for w, n in df.items()}
    number = {w: i for i, w in enumerate(idf)}
    dense = np.zeros((len(texts), len(idf)))
    for i, c in enumerate(words):
        for w, n in c.items():
            dense[i, number[w]] = (1 + math.log(n)) * idf[w]
    dense /= np.maximum(np.linalg.norm(dense, axis=1), 1e-12)[:, None]
    return dense @ dense[wanted].T


def test_nearest_by_every_word_with_all_examples_drawn(spark, monkeypatch):
    """Labels that no single word tells: a document is like its neighbours by ordinary words only."""
    settings(spark)
    monkeypatch.setattr(toxicity, "EXAMPLES", 200)
    rng = random.Random(8)
    letters = "abcdefghij"
    plain = [a + b + c for a in letters for b in letters for c in letters][:600]
    rows, truth = [], {}
    for i in range(420):
        if i % 3 or not rows:
            words = rng.choices(plain, k=rng.randint(12, 40))
            truth[i] = int(rng.random() < 0.3)
        else:  # a near copy
            k, text = rng.choice(rows)
            words, truth[i] = text.split(), truth[k]
            words[rng.randrange(len(words))] = rng.choice(plain)
        rows.append((i, " ".join(words)))
    labels = spark.createDataFrame([(k, 1, t) for k, t in truth.items()], "doc_id long, quality int, toxic int")
    drawn = [r.doc_id for r in toxicity.examples_of(docs(spark, rows), labels).collect()]
    assert len(drawn) == toxicity.EXAMPLES
    cosine = brute_force([t for _, t in rows], drawn)
    seen, copies, right = {w for k in drawn for w in rows[k][1].split()}, 0, 0
    for r in toxicity.toxicity_scores(docs(spark, rows), labels).collect():
        own = np.array([-1.0 if rows[k][1] == rows[r.doc_id][1] else c for k, c in zip(drawn, cosine[r.doc_id])])  # not its own text
        best = np.sort(own)[::-1][:len(r.evidence)]
        at = [own[drawn.index(e.doc_id)] for e in r.evidence]
        assert len(r.evidence) == 5 and np.allclose(at, best)  # the nearest ones, whatever the label
        if set(rows[r.doc_id][1].split()) <= seen:
            assert np.allclose([e.cosine for e in r.evidence], best)
        if r.doc_id not in drawn and best[0] > 0.8:
            copies, right = copies + 1, right + (r.evidence[0].toxic == truth[r.doc_id])
    assert copies > 20 and right == copies


def test_ties_do_not_know_the_label(spark):
    settings(spark)
    own = [k for k in range(300) if zlib.crc32(str(k).encode()) % 3 != 1][:120]
    rows = [(k, "one text for all" + " or" * (k % 2)) for k in own]  # two texts, as near to each other
    labels = spark.createDataFrame([(k, 1, int(i < 40)) for i, k in enumerate(own)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(docs(spark, rows), labels).collect()
    assert {e.toxic for r in got for e in r.evidence} == {0, 1}
    assert {r.predicted for r in got} == {0}


def test_no_document_is_scored_by_its_own_label(spark):
    """Turning the label of one document changes every score but its own and those of its copies."""
    settings(spark)
    rows, labels = corpus(random.Random(9), 120)
    one = next(k for k, _, t in labels if t and zlib.crc32(str(k).encode()) % 3 != 1)
    rows.append((500, rows[one][1]))
    turned = [(k, q, 1 - t if k == one else t) for k, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    learnt, held = [], docs(spark, rows)
    for told in (labels, turned):
        examples = toxicity.saved(toxicity.examples_of(held, spark.createDataFrame(told, schema)), "test-examples")
        cutter = toxicity.vocabulary(examples)
        learnt.append(toxicity.learn(examples, cutter, held.select("text").mapInArrow(toxicity._held_by(cutter), "term int, n bigint")))
    votes = []
    for model in learnt:
        near = model.nearest([model.cutter.of(rows[one][1])], [toxicity._digest(rows[one][1])])
        for index, own in zip(model.indexes, near):
            assert index.ids.index(one) not in own[0][0].tolist()
        votes.append(near[0][0][0].tolist())
    assert votes[0] == votes[1]
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs(spark, rows), spark.createDataFrame(labels, schema)).collect()}
    assert got[one] == got[500]


def test_the_driver_does_not_index(spark, monkeypatch):
    """The examples are worked on by a task; the driver hands the model on."""
    settings(spark)
    rows, labels = corpus(random.Random(9), 120)
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    driver, index = os.getpid(), toxicity.Index.__init__

    def elsewhere(self, *args):
        assert os.getpid() != driver
        index(self, *args)
    want = sorted(r.doc_id for r in toxicity.drop_toxic(docs(spark, rows), told).collect())
    monkeypatch.setattr(toxicity.Index, "__init__", elsewhere)
    assert sorted(r.doc_id for r in toxicity.drop_toxic(docs(spark, rows), told).collect()) == want
    assert 0 < len(want) < len(rows)
