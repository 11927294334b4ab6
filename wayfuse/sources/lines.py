"""Files of any size as lines with their places: the splittable source below fingerprints and quoted CSV.

The text source cuts a file into splits at line ends and hands out the bytes as they are. Each split is read by
one task in order, so a line's place inside its split needs no shuffle. What a split cannot know by itself, the bytes and the
quotes before it, is added from a table with one row for each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed value: file endings for which the text source unpacks the content instead of handing out the bytes.
PACKED = ("gz", "gzip", "bz2", "deflate", "lz4", "snappy", "zst")
TINY = 3  # bytes: a file of a byte order mark alone has no line

_NUMBERED = "path string, file_size bigint, split bigint, line bigint, at bigint, quotes bigint, before bigint, content binary"


def is_packed(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "[.]"), -1)).isin(*PACKED)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to lines in file order: number, byte offset, and quotes before them, each counted from the split's first line."""
    path, split, line, at, before = None, None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        splits = batch.column("split").to_numpy()
        paths = pc.fill_null(batch.column("path"), "").dictionary_encode()
        names = paths.dictionary.to_pylist()
        codes = paths.indices.to_numpy()
        size = pc.binary_length(batch.column("content")).to_numpy().astype(np.int64) + 1
        quotes = pc.count_substring(batch.column("content"), '"').to_numpy().astype(np.int64)
        first = np.flatnonzero(np.r_[True, (np.diff(codes) != 0) | (np.diff(splits) != 0)])
        lines, ats, befores = (np.empty(len(size), np.int64) for _ in range(3))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(size)]):
            if (names[codes[a]], splits[a]) != (path, split):
                path, split, line, at, before = names[codes[a]], splits[a], 0, 0, 0
            lines[a:b] = np.arange(line, line + b - a)
            ats[a:b] = at + np.cumsum(size[a:b]) - size[a:b]
            befores[a:b] = before + np.cumsum(quotes[a:b]) - quotes[a:b]
            line, at, before = line + b - a, at + int(size[a:b].sum()), before + int(quotes[a:b].sum())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("file_size"), batch.column("split"), pa.array(lines), pa.array(ats),
             pa.array(quotes), pa.array(befores), batch.column("content")],
            ["path", "file_size", "split", "line", "at", "quotes", "before", "content"])


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, file_size, split, line, at, quotes, before, content of every line below ``paths``.

    ``split`` is the place in the file where the reader's split begins; ``line``, ``at`` (bytes) and
    ``before`` (double quotes) count from the split's first line. A line ends at a line feed, a carriage return
    before it is content. Packed files are left out. One line must stay below 2 GB.
    """
    meta = F.col("_metadata")
    lines = (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(paths)
             .select(meta["file_path"].alias("path"), meta["file_size"].alias("file_size"),
                     meta["file_block_start"].alias("split"), F.col("value").cast("binary").alias("content")))
    return lines.where(~is_packed(F.col("path"))).mapInArrow(_numbered, _NUMBERED)


def splits(lines: DataFrame) -> DataFrame:
    """path, split, and the bytes and quotes of the file before the split; one row for each split."""
    totals = lines.groupBy("path", "file_size", "split").agg(
        F.sum(F.octet_length("content") + 1).alias("n_bytes"), F.sum("quotes").alias("n_quotes"), F.count(F.lit(1)).alias("n_lines"))
    order = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("path")
    # the reader leaves out a byte order mark at the beginning, and a file may end without a line feed
    missing = F.col("file_size") - F.sum("n_bytes").over(whole)
    return totals.select(
        "path", "file_size", "split", "n_lines",
        F.coalesce(F.sum("n_bytes").over(order), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n_quotes").over(order), F.lit(0)).alias("quotes_before"),
        F.when(missing >= 2, 3).otherwise(0).alias("mark"),
        F.when(missing.isin(0, 3), F.lit(True)).when(missing.isin(-1, 2), F.lit(False)).alias("closed"))


def byte_pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, file_size, start, content: pieces that make up each file below ``paths``, byte for byte.

    A piece is a line with its line feed, so the pieces of a file of any size come from many
    tasks. A packed file is one piece, and must stay below 2 GB. An empty file has no piece.
    """
    lines = numbered_lines(spark, paths).where(F.col("file_size") > TINY)
    placed = lines.join(splits(lines).drop("file_size", "n_lines"), ["path", "split"])
    end = F.col("bytes_before") + F.col("mark") + F.col("at") + F.octet_length("content")
    is_last = end + F.when(F.col("closed"), 1).otherwise(0) == F.col("file_size")
    feed = F.when(is_last & ~F.col("closed"), F.lit(b"")).otherwise(F.lit(b"\n"))
    # a file whose bytes do not add up is not what the text source says it is
    known = F.when(F.col("closed").isNull(), F.raise_error(F.concat(F.lit("cannot account for the bytes of "), F.col("path"))).cast("binary"))
    lead = F.when((F.col("mark") > 0) & (F.col("bytes_before") + F.col("at") == 0), F.lit(b"\xef\xbb\xbf")).otherwise(F.lit(b""))
    start = F.col("bytes_before") + F.col("at") + F.when(F.octet_length(lead) > 0, 0).otherwise(F.col("mark"))
    plain = placed.select("path", "file_size", start.alias("start"),
                          F.coalesce(known, F.concat(lead, F.col("content"), feed)).alias("content"))
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    packed = whole.option("pathGlobFilter", "*.{" + ",".join(sorted({*PACKED, *(p.upper() for p in PACKED)})) + "}").load(paths)
    tiny = whole.option("pathGlobFilter", "*").load(paths).where((F.col("length") <= TINY) & ~is_packed(F.col("path")))
    return plain.unionByName(packed.unionByName(tiny).select(
        "path", F.col("length").alias("file_size"), F.lit(0).cast("long").alias("start"), "content"))


def _unended(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)


def record_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, first, record: the CSV records below ``paths``; quoted cells may hold line ends.

    ``first`` marks the record at the beginning of its file. Whether a line begins a record depends on the
    quotes before it, an even number if it does: each split counts its own, and the parity at its
    beginning comes from the splits before. A line that begins a record and has an even number itself is a record,
    wherever it stands; only lines of records over several lines are brought together. Quotes inside a cell
    must be doubled and the cell quoted. Blank lines between records are left out.
    """
    lines = numbered_lines(spark, paths)
    known = splits(lines)
    placed = (lines.join(known.select("path", "split", "quotes_before"), ["path", "split"])
              .withColumn("inside", (F.col("quotes_before") + F.col("before")) % 2 == 1)
              .withColumn("odd", F.col("quotes") % 2 == 1))
    text = _unended(F.col("content").cast("string"))
    single = placed.where("NOT inside AND NOT odd").select(
        "path", ((F.col("split") == 0) & (F.col("line") == 0)).alias("first"), text.alias("record"))
    parts = placed.where("inside OR odd")
    opens = F.when(~F.col("inside"), 1).otherwise(0)
    opened = parts.groupBy("path", "split").agg(F.sum(opens).alias("n"))
    earlier = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    opened = opened.select("path", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("opened_before"))
    so_far = W.partitionBy("path", "split").orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow)
    several = (parts.withColumn("opened", F.sum(opens).over(so_far)).join(opened, ["path", "split"])
               .groupBy("path", (F.col("opened") + F.col("opened_before")).alias("number"))
               .agg(F.min((F.col("split") != 0) | (F.col("line") != 0)).alias("later"),
                    F.sort_array(F.collect_list(F.struct("split", "line", "content"))).alias("lines")))
    joined = _unended(F.array_join(F.transform("lines", lambda x: x["content"].cast("string")), "\n"))
    return single.unionByName(several.select("path", (~F.col("later")).alias("first"), joined.alias("record"))).where("record <> ''")
