"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # The JVM never compiles a method above 8000 bytes of bytecode; the wide
    # mapping projections would run interpreted inside one fused stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# A row of the given tables takes some ten bytes in Parquet and some five hundred as a row of text: a split of
# the usual 128 MB is a task of gigabytes, which spills all it shuffles, and a table of 1 GB keeps a few cores busy.
_FEEDS = {"spark.sql.files.maxPartitionBytes": "8m"}

# A byte read is some five bytes shuffled. The rounds are bounded, as each scans the whole input for its rows: time and
# disk stay in proportion to it. Frames that don't come from files have no size.
_ROUND_BYTES, _MOST_ROUNDS, _UNKNOWN = 256 << 20, 4, 1 << 60


def build_session(app: str = "wayfuse", cores: int | str | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    # Recording the Python call site of every column doubles the time to build a plan.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if cores is not None:
        builder = builder.master(f"local[{cores}]")
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession, feeds: bool = False) -> SparkSession:
    """Apply the runtime settings every plan here assumes (UTC, AQE); ``feeds`` for queries on the crash feeds."""
    for key, value in {**_RUNTIME, **(_FEEDS if feeds else {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if not feeds:
        for key, value in _FEEDS.items():
            if spark.conf.get(key, None) == value:
                spark.conf.unset(key)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A runtime setting for the jobs of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a folder of its own: on a cluster a
    machine-local folder would vanish with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="wayfuse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), "wayfuse", f"{label}-{uuid.uuid4().hex[:12]}")


def dropped(df: DataFrame) -> None:
    """Remove the files of a table made by :func:`saved` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage of an iterative plan: a lost executor costs one step, not
    all of them. A written table also has a known size, so a small one is
    broadcast in the next join and a large one is not. What the plan shuffled goes
    with the write: else it stays on disk until the driver collects its garbage.
    """
    path = scratch_path(df.sparkSession, label)
    with unshuffled(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unshuffled(spark: SparkSession):
    """What a query begun in this block shuffles is removed when it ends, not when the driver collects its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def rounds_for(*frames: DataFrame) -> int:
    """Rounds in which a job over these frames is done, by the bytes its scans read."""
    read = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        read += sum(n for n in sizes if n < _UNKNOWN)
    return max(1, min(_MOST_ROUNDS, -(-read // _ROUND_BYTES)))


def in_rounds(df: DataFrame, key: str, rounds: int) -> list[DataFrame]:
    """``df`` in so many parts by a hash of ``key``: rows alike in it, or without it, are in one part.

    Jobs that take the parts one after the other hold the shuffle of one part at a time. Each of them reads all of
    ``df`` again, but the filter acts on the key alone, below what else is derived. ``df`` must give the
    same rows each time.
    """
    if rounds == 1:
        return [df]
    dealt = F.pmod(F.xxhash64(F.col(key)), F.lit(rounds))
    return [df.where(dealt == i) for i in range(rounds)]
