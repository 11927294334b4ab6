"""Raw scans: every cell text, only a blank cell is null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from wayfuse.sources.lines import record_texts


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_text(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None,
                  multi_line: bool = False) -> DataFrame:
    """CSV with a header, all text; 'NA' and 'null' stay text.

    A file is split over many tasks, also with ``multi_line``, which says that quoted cells may hold
    line ends: see :func:`wayfuse.sources.lines.record_texts`.

    ``columns`` names the header when it is known; otherwise it is read from the
    first line. Several files must share their header: use ``read_csv_union``
    where they differ.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("nullValue", "").option("emptyValue", "")
              .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
              .option("enforceSchema", False))
    if not multi_line:
        if columns is None:
            return reader.csv(paths)
        return reader.schema(text_schema(columns)).csv(paths).select(*columns)
    if columns is None:
        columns = reader.csv(paths).columns  # reads one record
    return _parsed(record_texts(spark, paths), columns)


def _parsed(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records as rows of text; one whose header differs from ``columns`` fails."""
    inner = text_schema([f"c{i}" for i in range(len(columns))])
    told = {"nullValue": "", "emptyValue": "", "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1",
            "mode": "PERMISSIVE"}
    cells = records.withColumn("_cells", F.from_csv("record", inner.simpleString()[len("struct<"):-1].replace(":", " "), told))
    expected = F.array(*[F.lit(c) for c in columns])
    header = F.array(*[F.coalesce(f"_cells.c{i}", F.lit("")) for i in range(len(columns))])
    wrong = F.raise_error(F.concat(F.lit("header differs from the expected columns in "), F.col("path"))).cast("boolean")
    # a header that does not fit fails; one that fits is no row
    kept = cells.where(F.when(~F.col("first"), F.lit(True)).when(header == expected, F.lit(False)).otherwise(wrong))
    return kept.select(*[F.col(f"_cells.c{i}").alias(c) for i, c in enumerate(columns)])


def read_csv_union(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """Files of one batch, columns aligned by name, an absent column null."""
    if not paths:
        raise FileNotFoundError("the batch lists no files")
    out = None
    for path in paths:
        rows = read_csv_text(spark, path, multi_line=multi_line)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def read_json_pages(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """Pages that each hold an array of records; numbers read as text, absent keys null."""
    return (spark.read.option("multiLine", True).option("primitivesAsString", True)
            .schema(text_schema(columns)).json(paths).select(*columns))


def drop_page_overlap(pages: DataFrame, key: str, *newest_first: str) -> DataFrame:
    """One record per key where a page boundary repeated it.

    Keeps the record that sorts first by ``newest_first`` descending. max_by is
    combined before the shuffle, so a record repeated on very many pages does
    not end up whole in one task.
    """
    order = F.struct(*[F.col(c) for c in newest_first])
    rest = F.struct(*[F.col(c) for c in pages.columns if c != key])
    return (pages.groupBy(key).agg(F.max_by(rest, order).alias("_row"))
            .select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in pages.columns]))


def trailing_window(df: DataFrame, date_column: str, days: int, since=None, until=None,
                    max_rows: int | None = None, order: list[str] | None = None,
                    by: list[str] | None = None) -> DataFrame:
    """Rows from ``days`` before the newest date up to it, both ends included.

    ``by`` (columns with few values) gives each group the window of its own newest date.
    ``since`` and ``until`` override the window for a backfill. ``max_rows`` is
    the optional cap of a partial pull; it needs an order to be repeatable.
    """
    newest = df.groupBy(*(by or [])).agg(F.max(date_column).alias("_newest"))
    last = F.col("_newest") if until is None else F.lit(until).cast("date")
    first = F.date_sub(last, days) if since is None else F.lit(since).cast("date")
    out = (df.join(F.broadcast(newest), by) if by else df.join(F.broadcast(newest)))
    out = out.where(F.col(date_column).between(first, last)).select(*df.columns)
    if max_rows is not None:
        out = out.orderBy(*(order or [date_column])).limit(max_rows)
    return out


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when a pull came back empty: an empty window means a broken feed."""
    if df.isEmpty():
        raise RuntimeError(f"{what}: 0 rows returned")
    return df


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, first by ``order``; the rank limit is applied before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
