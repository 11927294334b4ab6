import random

from wayfuse.llm import line_quality
from wayfuse.llm.common import settings
from tests.llm.frames import clashing, docs


def sentences(n):
    rng = random.Random(n)
    return "\n".join(" ".join(f"w{rng.randint(0, 400)}is" for _ in range(12)) + "." for _ in range(n))


def brute(text):
    words = (text or "").encode().split()
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures(spark):
    settings(spark)
    good = sentences(12)
    texts = [good, good + "\n" + good, "a b c " * 30, "x | y | z\n" * 40, None, "", " \n\n ", "é ü\x0b* <b>\n\na b\na b", "a b c a b c d",
             good.replace("is", "is***"), "WORD!! " * 60, good + "\nAccept cookies now\nall rights reserved"]
    rows = list(enumerate(texts)) + [(0, good), (None, good)]
    got = line_quality.quality(clashing(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
            n, _, _, _, again = brute(texts[r.doc_id])
            assert r.base_failed == (n < 50 or 100 * again > 50 * n)
            assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in got if r.kept} == {0, 11, None}
    assert line_quality.quality(docs(spark, [])).count() == 0


def test_lines_go(spark):
    settings(spark)
    good = sentences(12)
    frame = clashing(docs(spark, [(1, good + "\nHome | News | About | Help\nClick here"), (2, "short")]))
    got = line_quality.clean_documents(frame)
    assert got.columns == frame.columns
    assert [(r.doc_id, r.text, r.n_chars) for r in got.collect()] == [(1, good, len(good))]
