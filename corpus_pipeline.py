"""From documents to packed sequences: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last
return the columns of ``documents``; the last one returns a row for each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfuse.llm import set_join, simhash
from wayfuse.llm.common import documents, saved, settings, table
from wayfuse.llm.lempel_ziv import remove_spans
from wayfuse.llm.mixing import mix_documents
from wayfuse.llm.packing import pack_documents
from wayfuse.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic by their nearest labelled neighbours go."""
    return drop_toxic(docs, table(settings(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles) the document with the smallest id stays.

    SimHash links come first. They find few pairs at a similarity near 0.8, so what is left is joined by the
    similarity itself, at 0.8 and more.
    """
    settings(spark)
    return set_join.one_of_each(saved(simhash.one_of_each(docs, words_each=5), "pipeline-simhash"), words_each=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in a window of 35 that also starts anywhere else are cut from the texts."""
    settings(spark)
    return remove_spans(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stands as often as the target weight of its source takes it."""
    settings(spark)
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids and their places in the packed sequences."""
    settings(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixing", mixing), ("packing", packing)]

# The vocabulary's ids can't be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = documents(settings(spark), sf_dir)
    for name, stage in STAGES:
        rows = saved(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
