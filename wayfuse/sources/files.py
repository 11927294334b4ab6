"""Incoming files as tables: listing, checks, fingerprints, manifests, change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfuse.sources.datasets import file_key
from wayfuse.sources.lines import byte_pieces, record_texts

MANIFEST_COLUMNS = ["source_id", "batch_id", "file_name", "type", "raw_path", "size_bytes",
                    "sha256", "record_count", "retrieved_at_utc"]


def file_name(path: Column) -> Column:
    """Name of the file, or of the ``file=NAME`` or ``NAME/part-*`` folder that holds its parts."""
    folder = F.nullif(F.regexp_extract(path, "/file=([^/]+)/", 1), F.lit(""))
    last, above = F.element_at(F.split(path, "/"), -1), F.element_at(F.split(path, "/"), -2)
    return F.coalesce(F.url_decode(folder), F.when(last.startswith("part-"), above).otherwise(last))


def incoming(spark: SparkSession, root: str) -> DataFrame:
    """name, path, length, modificationTime and content of each file part below ``root``.

    The content is read only where it is used.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .withColumn("name", file_name(F.col("path"))))


def listed(spark: SparkSession, root: str) -> DataFrame:
    """One row per named file: a path, size and time of its newest part."""
    return (incoming(spark, root).groupBy("name")
            .agg(F.min("path").alias("path"), F.sum("length").alias("size_bytes"),
                 F.max("modificationTime").alias("modificationTime")))


def glob_to_regex(pattern: str) -> str:
    """Anchored regular expression of a shell pattern with * and ?."""
    special = {"*": ".*", "?": "."}
    return "^" + "".join(special.get(ch, "\\" + ch if ch in r".+()[]{}^$|\\" else ch)
                         for ch in pattern) + "$"


CHUNK = 1 << 20  # bytes of a leaf
FAN = 1024  # hashes below a node
LEVELS = 4  # of nodes above the leaves: enough for 2**60 bytes


def content_hash(pieces: DataFrame, keys: list[str], chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """SHA-256 of contents of any size: ``keys`` and ``sha256``.

    ``pieces`` has the keys, ``start`` (byte offset) and ``content``, in any order and cut anyhow. A content
    of one chunk has the hash of its bytes. A longer one has a tree of hashes: a node is the hash of the
    hashes (lowercase hex, one after another) of the ``fan`` nodes below it, up to the first level of
    one node. No task holds more than a chunk or ``fan`` hashes, and the hash does not depend on the cuts.
    """
    end = F.col("start") + F.octet_length("content")
    number = F.explode(F.sequence(F.floor(F.col("start") / chunk), F.floor((end - 1) / chunk)))
    parts = pieces.where(F.octet_length("content") > 0).select(*keys, "start", "content", number.alias("number"))
    begin = F.greatest(F.col("number") * chunk - F.col("start"), F.lit(0)).cast("int")
    # a piece inside its chunk is passed on as it is
    held = F.when((begin == 0) & (end <= (F.col("number") + 1) * chunk), F.col("content")).otherwise(F.substring(
        F.col("content"), begin + 1, F.least((F.col("number") + 1) * chunk - F.col("start") - begin, F.lit(chunk)).cast("int")))
    parts = parts.select(*keys, "number", F.struct((F.col("start") + begin).alias("start"), held.alias("content")).alias("part"))
    whole = F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: F.hex(p["content"])), ""))
    nodes = parts.groupBy(*keys, "number").agg(F.sha2(whole, 256).alias("node"))
    for _ in range(LEVELS):
        below = F.sort_array(F.collect_list(F.struct("number", "node")))
        nodes = (nodes.groupBy(*keys, F.floor(F.col("number") / fan).alias("up")).agg(below.alias("below"))
                 .select(*keys, F.col("up").alias("number"), F.when(
                     (F.col("up") == 0) & (F.size("below") == 1), F.col("below")[0]["node"]).otherwise(
                     F.sha2(F.array_join(F.transform("below", lambda n: n["node"]), ""), 256)).alias("node")))
    return nodes.select(*keys, F.col("node").alias("sha256"))


def fingerprints(spark: SparkSession, root: str, chunk: int = CHUNK) -> DataFrame:
    """name, path, size_bytes and sha256 of each named file below ``root``.

    The bytes of a file's parts count one after another in the order of their paths, so the hash is the
    same however they are cut into parts; parts that change places give another. See
    :func:`content_hash`: files of any size are read and hashed by many tasks. The file source does not
    list files without a byte, so they are no rows here.
    """
    parts = incoming(spark, root).select("name", "path", F.col("length").cast("long").alias("length"))
    before = W.partitionBy("name").orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    placed = parts.withColumn("before", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        file_key(F.col("path")).alias("_part"), "name", "before")
    pieces = byte_pieces(spark, root).join(placed, file_key(F.col("path")) == F.col("_part")).select(
        "name", (F.col("before") + F.col("start")).alias("start"), "content")
    files = parts.groupBy("name").agg(F.min("path").alias("path"), F.sum("length").alias("size_bytes"))
    hashed = content_hash(pieces, ["name"], chunk)
    return files.join(hashed, "name").select(
        "name", "path", "size_bytes", "sha256")


def header_columns(line: Column) -> Column:
    """Number of columns a CSV header line names; commas inside quotes separate nothing."""
    return F.size(F.split(F.regexp_replace(line, '"(?:[^"]|"")*"', "q"), ","))


def csv_sanity(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Per named CSV file: valid UTF-8, header columns, number of data rows, status.

    Lines are checked where they are read, so a file of any size is split over
    many tasks; the header is the record at the lowest position. With ``multi_line`` quoted cells may
    hold line ends: records are told apart by the quotes before them, again over many tasks.
    """
    if multi_line:
        records = record_texts(spark, root).select(
            file_name(F.col("path")).alias("name"), "path", "first", F.is_valid_utf8("record").alias("utf8"),
            F.when(F.col("first"), header_columns(F.col("record"))).alias("columns"))
        counted = records.groupBy("name").agg(
            F.bool_and("utf8").alias("utf8"), F.min_by("columns", F.when(F.col("first"), F.col("path"))).alias("header_columns"),
            F.count_if(~F.col("first")).alias("row_count"))
        return _with_status(counted)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = (spark.read.option("recursiveFileLookup", "true").text(root)
             .select(file_name(F.col("_metadata.file_path")).alias("name"), place.alias("place"),
                     F.is_valid_utf8("value").alias("utf8"),
                     header_columns(F.col("value")).alias("columns")))
    head = lines.groupBy("name").agg(F.bool_and("utf8").alias("utf8"),
                                     F.min_by("columns", "place").alias("header_columns"))
    rows = (spark.read.option("quote", '"').option("escape", '"')
            .option("header", True).option("recursiveFileLookup", "true").schema("first string").csv(root)
            .groupBy(file_name(F.col("_metadata.file_path")).alias("name"))
            .agg(F.count("*").alias("row_count")))
    return _with_status(head.join(rows, "name", "left").na.fill(0, ["row_count"]))


def _with_status(counted: DataFrame) -> DataFrame:
    return counted.withColumn("status", F.when(~F.col("utf8"), "not utf-8")
                              .when(F.col("header_columns") < 2, "no header").otherwise("ok"))


def newest_file(files: DataFrame, pattern: str) -> DataFrame:
    """The newest file matching a pattern: by name, then by modification time."""
    return (files.where(F.col("name").rlike(glob_to_regex(pattern)))
            .agg(F.max_by("path", F.struct("name", "modificationTime")).alias("path"),
                 F.max("name").alias("name"))
            .withColumn("status", F.when(F.col("path").isNull(), "missing").otherwise("ok")))


def expected_files(spark: SparkSession, files: DataFrame, years: list[int], pattern: str) -> DataFrame:
    """One row per expected year: the exact name, else the single file naming the year.

    A missing or ambiguous year does not hide the others: each year carries its
    own status and the caller fails with all of them.
    """
    wanted = spark.createDataFrame([(y, pattern.format(year=y)) for y in years],
                                   "year int, exact_name string")
    match = F.expr("name = exact_name OR name rlike concat('(?s)^.*', year, '.*[.]csv$')")
    # The few expected years are the broadcast side, however long the listing is.
    hits = (files.select("name", "path").join(F.broadcast(wanted), match)
            .groupBy("year")
            .agg(F.count("path").alias("matches"),
                 F.max(F.when(F.col("name") == F.col("exact_name"), F.col("path"))).alias("exact"),
                 F.max("path").alias("any_path")))
    found = wanted.join(hits, "year", "left").na.fill(0, ["matches"])
    single = F.when(F.col("matches") == 1, F.col("any_path"))
    return found.select(
        "year", F.coalesce("exact", single).alias("path"),
        F.when(F.col("exact").isNotNull() | (F.col("matches") == 1), "ok")
         .when(F.col("matches") == 0, "missing").otherwise("ambiguous").alias("status"))


def require_all(found: DataFrame) -> list[str]:
    """Paths of all expected files, or one error that lists every year that failed."""
    rows = found.orderBy("year").collect()
    failed = [f"{r.year}: {r.status}" for r in rows if r.status != "ok"]
    if failed:
        raise FileNotFoundError("years failed: " + ", ".join(failed))
    return [r.path for r in rows]


def manifest_entries(prints: DataFrame, counts: DataFrame | None, source_id: str, batch_id: str,
                     kind: str = "file_copy", retrieved_at: Column | None = None) -> DataFrame:
    """One manifest row per file of a batch."""
    out = prints if counts is None else prints.join(
        counts.select("name", F.col("row_count").alias("record_count")), "name", "left")
    if counts is None:
        out = out.withColumn("record_count", F.lit(None).cast("long"))
    now = F.current_timestamp() if retrieved_at is None else retrieved_at
    return out.select(
        F.lit(source_id).alias("source_id"), F.lit(batch_id).alias("batch_id"),
        F.col("name").alias("file_name"), F.lit(kind).alias("type"),
        F.col("path").alias("raw_path"), F.col("size_bytes"), F.col("sha256"),
        F.col("record_count"), now.alias("retrieved_at_utc"))


def append_manifest(entries: DataFrame, root: str) -> None:
    entries.select(MANIFEST_COLUMNS).write.mode("append").parquet(root)


def batch_totals(manifest: DataFrame) -> DataFrame:
    """File count and records per batch; a file without a count adds one."""
    return manifest.groupBy("source_id", "batch_id").agg(
        F.count("*").alias("file_count"),
        F.sum(F.coalesce("record_count", F.lit(1))).alias("total_records_or_files"),
        F.min("retrieved_at_utc").alias("retrieved_at_utc"))


def latest_batches(batches: DataFrame) -> DataFrame:
    """Newest batch per source; batch ids sort by time."""
    return batches.groupBy("source_id").agg(F.max("batch_id").alias("batch_id"))


def detect_change(manifest: DataFrame, incoming_files: DataFrame,
                  present: DataFrame | None = None) -> DataFrame:
    """Per source: do the incoming files differ from the newest batch?

    ``incoming_files`` has source_id, file_name, sha256. Unchanged means the same
    set of names with the same hash each, all kept as file copies that are still
    there; ``present`` (raw_path) is the listing of the raw folder.
    """
    newest = manifest.join(F.broadcast(latest_batches(manifest)), ["source_id", "batch_id"])
    if present is None:
        newest = newest.withColumn("_there", F.lit(True))
    else:
        newest = (newest.join(present.select("raw_path").distinct()
                              .withColumn("_there", F.lit(True)), "raw_path", "left"))
    old = newest.select("source_id", "file_name", "batch_id", F.col("sha256").alias("old_sha"),
                        (F.coalesce("_there", F.lit(False)) & (F.col("type") == "file_copy")).alias("reusable"))
    new = incoming_files.select("source_id", "file_name", F.col("sha256").alias("new_sha"))
    same = (F.col("old_sha").eqNullSafe(F.col("new_sha")) & F.coalesce("reusable", F.lit(False)))
    return (old.join(new, ["source_id", "file_name"], "full")
            .groupBy("source_id")
            .agg(F.max("batch_id").alias("previous_batch_id"), F.bool_and(same).alias("_same"))
            .select("source_id", "previous_batch_id",
                    (~F.col("_same")).alias("content_changed")))

