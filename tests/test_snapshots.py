"""Tables of snapshots: what readers see while a write goes on, fails, or is run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_audit import feed
from wayfuse.operators import snapshots as SN
from wayfuse.operators.curate import typed_rows, write_partitioned

NOW = "2026-02-02"


def base(spark):
    return typed_rows(feed(spark, "uk_stats19", 3, lambda i: f"14/0{i + 1}/2023 08:30"))


def change(spark):
    """Record 0 moves from January to March, record 3 is new there."""
    return typed_rows(feed(spark, "uk_stats19", 4, lambda i: "20/03/2023 09:00", batch="u2", severity="fatal")).where(
        F.col("source_record_id").isin("0", "3"))


def seen(rows):
    return sorted((r.source_record_id, r.month, r.batch_id, r.severity) for r in rows.collect())


OLD = [("0", 1, "u1", "minor"), ("1", 2, "u1", "minor"), ("2", 3, "u1", "minor")]
NEW = [("0", 3, "u2", "fatal"), ("1", 2, "u1", "minor"), ("2", 3, "u1", "minor"), ("3", 3, "u2", "fatal")]


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "fact")
    SN.replace(spark, path, base(spark))
    return path


def test_merge_moves_amended_rows_and_is_repeatable(spark, root):
    for turn in range(2):
        assert SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp")).number == 2 + turn
        assert seen(SN.read(spark, root)) == NEW
    assert {r.ingested_at_utc for r in SN.read(spark, root).where("batch_id = 'u2'").collect()} == {dt.datetime(2026, 2, 2)}
    folders = {f for f, _ in SN.current(spark, root).versions}
    assert folders == {"source_id=uk_stats19/year=2023/month=2", "source_id=uk_stats19/year=2023/month=3"}
    with pytest.raises(ValueError):
        SN.merge(spark, root, change(spark).unionByName(change(spark)))
    assert SN.read(spark, root).columns[-3:] == ["source_id", "year", "month"]


def test_reader_keeps_the_state_it_resolved(spark, root):
    before = SN.current(spark, root)
    rows = SN.read(spark, before)  # not read yet
    SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    SN.replace(spark, root, base(spark).limit(1))
    assert seen(rows) == seen(SN.read(spark, before)) == OLD
    assert SN.read(spark, SN.snapshot(spark, root, 2)).count() == 4 and SN.read(spark, root).count() == 1


@pytest.mark.parametrize("step", ["require_unique", "_put", "_folders", "_written", "_renamed", "commit"])
def test_write_that_fails_at_any_step_changes_nothing(spark, root, monkeypatch, step):
    """A reader during the failing merge, and after it, sees the old table; the next merge goes through."""
    real, during = getattr(SN, step), []

    def fails(*args, **kwargs):
        during.append(seen(SN.read(spark, root)))
        if step in ("_put", "_folders", "_written"):
            real(*args, **kwargs)  # its work is done, and then the driver is lost
        raise OSError("lost")
    monkeypatch.setattr(SN, step, fails)
    with pytest.raises(OSError, match="lost"):
        SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    assert during == [OLD] and seen(SN.read(spark, root)) == OLD
    monkeypatch.undo()
    assert SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp")).number == 2 and seen(SN.read(spark, root)) == NEW
    SN.vacuum(spark, root, 1)
    assert seen(SN.read(spark, root)) == NEW


def test_failure_after_the_commit_is_the_new_table(spark, root, monkeypatch):
    real = SN._renamed

    def lost(*args):
        real(*args)
        raise OSError("lost")
    monkeypatch.setattr(SN, "_renamed", lost)
    with pytest.raises(OSError):
        SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    monkeypatch.undo()
    assert seen(SN.read(spark, root)) == NEW
    SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    assert seen(SN.read(spark, root)) == NEW


def test_two_writers_from_one_state(spark, root):
    parent = SN.current(spark, root)
    SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    with pytest.raises(SN.Conflict):
        SN.commit(spark, root, parent, {})
    assert seen(SN.read(spark, root)) == NEW


def test_publish_moves_the_candidate(spark, root, tmp_path, monkeypatch):
    candidate = write_partitioned(base(spark).limit(2), str(tmp_path / "candidate"))
    monkeypatch.setattr(SN, "_written", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        SN.publish(spark, candidate, root)
    monkeypatch.undo()
    assert seen(SN.read(spark, root)) == OLD and spark.read.parquet(candidate).count() == 2  # put back
    SN.publish(spark, candidate, root)
    assert SN.read(spark, root).count() == 2
    with pytest.raises(FileNotFoundError):
        SN.publish(spark, candidate, root)


def test_vacuum(spark, root):
    for _ in range(3):
        SN.merge(spark, root, change(spark), F.lit(NOW).cast("timestamp"))
    old = SN.snapshot(spark, root, 3)
    assert SN.vacuum(spark, root, 2) == 1  # the second merge's March; January and February of the first write stay in use
    assert seen(SN.read(spark, old)) == seen(SN.read(spark, root)) == NEW
    with pytest.raises(ValueError):
        SN.vacuum(spark, root, 0)


def test_merge_reads_touched_folders_only(spark, root):
    state = SN.current(spark, root)
    some = SN.read(spark, state, {"source_id=uk_stats19/year=2023/month=2"})
    assert [r.month for r in some.collect()] == [2] and len(some.inputFiles()) == 1
    assert SN.read(spark, state, set()).count() == 0


def test_absent_table(spark, tmp_path):
    assert SN.current(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        SN.read(spark, str(tmp_path / "none"))
    assert SN.merge(spark, str(tmp_path / "none"), change(spark), F.lit(NOW).cast("timestamp")).number == 1
