import duckdb
import pytest

import corpus_pipeline
from wayfuse.llm.common import settings

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = rows.columns, [rows.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        rows = corpus_pipeline.saved(rows, f"test-{name}")
        assert rows.columns == columns, name
        counts.append(rows.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3]


def test_run_packs_every_mixed_document(spark):
    settings(spark)
    got = corpus_pipeline.run(spark, SF).toPandas()
    per = duckdb.sql("SELECT sequence_id, sum(length) AS n, max(\"offset\" + length) AS e FROM got GROUP BY 1").fetchall()
    assert per and all(n == e <= 2048 for _, n, e in per)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_documents(spark, name):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, empty, SF).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_clashing_columns_pass(spark, name):
    from tests.llm.frames import clashing

    docs = clashing(spark.read.parquet(f"{SF}/documents.parquet").limit(40)).selectExpr("*", "1 AS _gone", "2 AS starts", "4 AS cls")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    stage = dict(corpus_pipeline.STAGES)[name]
    got, want = stage(spark, docs, SF), stage(spark, plain, SF)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.select(*plain.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {tuple(r) for r in got.select("n", "copies", "_gone", "cls").collect()} == {tuple(docs.select("n", "copies", "_gone", "cls").first())}


def test_near_duplicates_at_a_similarity_of_0_8_go(spark):
    """Every pair at 0.8 and more, by five-word shingles counted by hand, loses one; nothing else goes."""
    import random

    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([40, 120, 300]))]
        copy = list(base)
        for _ in range(rng.randint(0, len(base) // 40)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts += [" ".join(base), " ".join(copy)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert 10 < len(alike) < 30
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    gone = {i for i, _ in alike}
    assert not got & gone
    near = {i for i in set(range(len(texts))) - got - gone}  # linked by fingerprints alone: not far from 0.8
    assert all(any(len(sets[i] & sets[j]) >= 0.7 * len(sets[i] | sets[j]) for j in range(len(texts)) if j != i) for i in near)


def test_near_duplicates_leave_no_sets_behind(spark):
    """Of what the join of sets wrote only small tables stay, and of what was shuffled for them nothing."""
    from pathlib import Path

    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in (blocks.apply(i).name() for i in range(blocks.size())) if b.startswith("shuffle")}

    def written():
        return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir"), "wayfuse").glob("*")}
    settings(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, had = shuffled(), written()
    done = corpus_pipeline.near_duplicates(spark, docs, SF)
    left = {n.rsplit("-", 1)[0] for n in written() - had}
    assert "sets-rows" in left and not left & {"sets-posted", "sets-held", "sets-meetings"}
    assert not {b for b in shuffled() - before if b.endswith((".data", "_0")) }
    assert 0 < done.count() < docs.count()
