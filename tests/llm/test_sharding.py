import random
import zlib

from wayfuse.llm import sharding
from wayfuse.llm.common import saved, settings
from tests.llm.frames import clashing, docs


def check(rows, shards, got):
    total = sum(r[1] for r in rows)
    assert sorted((r.doc_id is None, r.doc_id, r.size) for r in got) == sorted((k is None, k, n) for k, n in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    for s, own in by.items():
        assert 0 <= s < shards and sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= 2 * max(n for _, n in rows)
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert order == sorted(order)


def test_bytes_are_near_equal(spark):
    settings(spark)
    rng = random.Random(2)
    rows = [(rng.choice([None, 7, i, i]), rng.choice([17, 30, 500, 4000])) for i in range(900)]
    frame = clashing(spark.createDataFrame(rows, "doc_id long, size_ long").withColumnRenamed("size_", "mass"))
    for range_rows in (50, 100_000):
        got = sharding.assign_shards(frame.withColumn("size", frame.mass) if "size" not in frame.columns else
                                     frame.drop("size").withColumn("size", frame.mass), 7, range_rows=range_rows)
        check(rows, 7, got.collect())


def test_one_key_for_all_rows(spark):
    settings(spark)
    rows = [(5, 10)] * 400
    check(rows, 4, sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, size long"), 4, range_rows=30).collect())


def test_a_hot_key_among_few_others(spark):
    settings(spark)
    top = (1 << 63) - 1
    for hot in (10, None, top):
        rows = [(k, 20) for k in range(21)] + [(hot, 20)] * 3000
        frame = spark.createDataFrame(rows, "doc_id long, size long")
        check(rows, 5, sharding.assign_shards(frame, 5, range_rows=100).collect())
        ranges, _ = sharding._subdivided(frame.selectExpr(
            "coalesce(doc_id, -9223372036854775808) AS _key", "size AS _size", "monotonically_increasing_id() AS row_no",
            "0L AS range").transform(lambda df: saved(df, "test-ranges")), 100)
        assert max(r.n for r in ranges.collect()) <= 100


def test_documents(spark):
    settings(spark)
    texts = [(1, "é"), (2, None), (2, None), (3, ""), (None, "x" * 900)]
    got = sharding.shard_documents(clashing(docs(spark, texts))).collect()
    assert {(r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got} == {
        (k, 16 + len((t or "").encode()), zlib.crc32((t or "").encode()), "bytes", None) for k, t in texts}
    assert len(got) == 5
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_written_in_slot_order(spark, tmp_path):
    settings(spark)
    frame = docs(spark, [(i, "w" * (i % 9)) for i in range(60)])
    back = spark.read.parquet(sharding.write_shards(frame, str(tmp_path / "out"), 5))
    assert back.count() == 60 and set(frame.columns) < set(back.columns)
