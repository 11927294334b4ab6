"""Partitioned tables whose readers see one state: versions of folders, and a pointer that names them.

A table is a folder with two things in it:

* ``data/version=ID/<partition folders>``: what one write has written; never changed afterwards;
* ``pointers/NNNNNNNNN``: one small file for each state of the table, a line for each partition folder with the version it is in.

The highest pointer is the current state. A reader resolves it once and reads just the folders it names, so a write that
comes later, or fails on the way, changes nothing for it. A write puts down a new version, then its pointer under
another name, and renames the pointer: that rename is the commit. What an interrupted write leaves is
named by no pointer, and goes with the next ``vacuum``.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfuse.operators.curate import write_folders
from wayfuse.operators.merging import NATURAL_KEY, require_unique, upsert
from wayfuse.session import dropped, in_rounds, rounds_for, saved, unshuffled
from wayfuse.spec import PARTITION_KEYS

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value


class Conflict(RuntimeError):
    """Another write was committed since this one read the table."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its number, and the version each partition folder is in."""
    root: str
    number: int
    versions: tuple[tuple[str, str], ...]

    def paths(self, only: set[str] | None = None) -> list[str]:
        return [f"{self.root}/data/version={v}/{folder}" for folder, v in self.versions if only is None or folder in only]


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_name(values) -> str:
    return "/".join(f"{k}={NO_VALUE if v is None else v}" for k, v in zip(PARTITION_KEYS, values))


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest committed state, or None for a table nothing was ever committed to."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return snapshot(spark, root, numbers[-1]) if numbers else None


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _path(spark, f"{root}/pointers")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def snapshot(spark: SparkSession, root: str, number: int) -> Snapshot:
    """A state by its number: one that is committed and not vacuumed."""
    root = root.rstrip("/")
    fs, p = _path(spark, f"{root}/pointers/{number:09d}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    lines = [json.loads(line) for line in text.splitlines()]
    return Snapshot(root, number, tuple((x["folder"], x["version"]) for x in lines))


def read(spark: SparkSession, table: str | Snapshot, only: set[str] | None = None) -> DataFrame:
    """The rows of a table as it is now, or of a state resolved before; ``only`` names the folders to read."""
    state = current(spark, table) if isinstance(table, str) else table
    if state is None:
        raise FileNotFoundError(f"no committed table at {table}")
    paths = state.paths(only)
    every = state.paths()
    if not every:
        raise FileNotFoundError(f"the table at {state.root} has no folder")
    rows = spark.read.option("basePath", f"{state.root}/data").parquet(*(paths or every[:1])).drop("version")
    return rows if paths else rows.where(F.lit(False))


def commit(spark: SparkSession, root: str, parent: Snapshot | None, versions: dict[str, str]) -> Snapshot:
    """Make ``versions`` (folder to version) the current state, if ``parent`` still is."""
    root = root.rstrip("/")
    number = parent.number + 1 if parent else 1
    fs, waiting = _path(spark, f"{root}/pointers/waiting-{uuid.uuid4().hex}")
    _, final = _path(spark, f"{root}/pointers/{number:09d}")
    listed = tuple(sorted(versions.items()))
    _written(fs, waiting, "".join(json.dumps({"folder": f, "version": v}) + "\n" for f, v in listed))
    if fs.exists(final) or not _renamed(fs, waiting, final):
        fs.delete(waiting, False)
        raise Conflict(f"state {number} of {root} was committed by another write")
    return Snapshot(root, number, listed)


def _written(fs, path, text: str) -> None:
    stream = fs.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _renamed(fs, old, new) -> bool:
    return fs.rename(old, new)


def _put(spark: SparkSession, root: str, rows: DataFrame | list[DataFrame]) -> tuple[str, list[str]]:
    """Rows, or parts of them, as a new version: its id and the folders it has."""
    version = uuid.uuid4().hex
    target = f"{root}/data/version={version}"
    write_folders([rows] if isinstance(rows, DataFrame) else rows, target)
    return version, _folders(spark, target)


def _folders(spark: SparkSession, target: str) -> list[str]:
    fs, pattern = _path(spark, target + "/*" * len(PARTITION_KEYS))
    found = fs.globStatus(pattern) or []
    return ["/".join(s.getPath().toString().rsplit("/", len(PARTITION_KEYS))[1:]) for s in found if s.isDirectory()]


def replace(spark: SparkSession, root: str, rows: DataFrame) -> Snapshot:
    """The whole table anew."""
    root, parent = root.rstrip("/"), current(spark, root)
    version, folders = _put(spark, root, rows)
    return commit(spark, root, parent, dict.fromkeys(folders, version))


def publish(spark: SparkSession, candidate: str, root: str) -> Snapshot:
    """An audited candidate becomes the table: its folder is moved below the table, no data is read or written.

    Whatever fails leaves the table as it was; the candidate is then where it was, or moved and named by nothing:
    the error says where.
    """
    root, parent = root.rstrip("/"), current(spark, root)
    fs, source = _path(spark, candidate)
    if not fs.exists(source):
        raise FileNotFoundError(f"no candidate at {candidate}")
    version = uuid.uuid4().hex
    _, target = _path(spark, f"{root}/data/version={version}")
    fs.mkdirs(target.getParent())
    if not _renamed(fs, source, target):
        raise RuntimeError(f"could not move {candidate} to {target.toString()}")
    try:
        return commit(spark, root, parent, dict.fromkeys(_folders(spark, target.toString()), version))
    except Exception:
        _renamed(fs, target, source)
        raise


def merge(spark: SparkSession, root: str, incoming: DataFrame, now: Column | None = None, stored: bool = False) -> Snapshot:
    """Incoming rows into the table: those with a known key replace it, nothing is deleted.

    Only touched folders are read and written again: those of the incoming rows and those where their earlier versions lie (found by
    a scan of the keys alone), as an amended date moves a record to another month. The state is resolved once at
    the beginning. A merge that is run again, after a failure or not, gives the same rows.

    ``stored`` says that the rows are read as they lie in files: they are not put down once more. Keys are met and rows
    written in rounds where there is much of them.
    """
    root, parent = root.rstrip("/"), current(spark, root)
    if now is None:  # the same time in all rounds
        now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    if stored or parent is None:
        return _merge_into(spark, root, parent, incoming, now, stored)
    incoming = saved(incoming, "incoming")  # used five times: what it takes to derive the rows is done once
    try:
        return _merge_into(spark, root, parent, incoming, now, True)
    finally:
        dropped(incoming)


def _merge_into(spark: SparkSession, root: str, parent: Snapshot | None, incoming: DataFrame, now: Column, stored: bool) -> Snapshot:
    """``stored``: the rows are the same each time they are read, so that rounds may each read them."""
    key = NATURAL_KEY[-1]
    if parent is None:
        rounds = rounds_for(incoming) if stored else 1
        parts = in_rounds(incoming, key, rounds)
        for part in parts:
            require_unique(part, NATURAL_KEY)
        version, folders = _put(spark, root, [p.withColumn("ingested_at_utc", now) for p in parts])
        return commit(spark, root, parent, dict.fromkeys(folders, version))
    existing = _like(read(spark, parent), incoming)
    alike = existing.schema[key].dataType == incoming.schema[key].dataType
    rounds = rounds_for(existing, incoming) if alike else 1
    names = set()
    for part, held in zip(in_rounds(incoming, key, rounds), in_rounds(existing, key, rounds)):
        require_unique(part, NATURAL_KEY)
        held = held.join(part.select(*NATURAL_KEY), NATURAL_KEY, "left_semi")
        # one row per folder: its number is that of the folders of the table
        with unshuffled(spark):
            names |= {folder_name(v) for v in held.select(*PARTITION_KEYS).union(part.select(*PARTITION_KEYS)).distinct().collect()}
    touched = _like(read(spark, parent, names), incoming)
    merged = [upsert(old, new, now) for old, new in zip(in_rounds(touched, key, rounds), in_rounds(incoming, key, rounds))]
    version, folders = _put(spark, root, merged)
    kept = {f: v for f, v in parent.versions if f not in names}
    return commit(spark, root, parent, kept | dict.fromkeys(folders, version))


def _like(rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """Partition values read from folder names, in the types of the incoming rows."""
    return rows.withColumns({k: F.col(k).cast(incoming.schema[k].dataType) for k in PARTITION_KEYS})


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all states but the newest ``keep``, and versions none of these names; returns how many versions went.

    Readers of older states must be done, and no write may be under way.
    """
    if keep < 1:
        raise ValueError("the current state must be kept")
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    named = {v for n in numbers[-keep:] for _, v in snapshot(spark, root, n).versions}
    fs, pointers = _path(spark, f"{root}/pointers")
    kept = {f"{n:09d}" for n in numbers[-keep:]}
    for status in fs.listStatus(pointers) if fs.exists(pointers) else []:
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), False)
    _, data = _path(spark, f"{root}/data")
    gone = 0
    for status in fs.listStatus(data) if fs.exists(data) else []:
        if status.getPath().getName().removeprefix("version=") not in named:
            gone += fs.delete(status.getPath(), True)
    return gone
