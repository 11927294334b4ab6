"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfuse.llm import line_quality
from wayfuse.llm.alignment import align
from wayfuse.llm.common import documents, settings, table
from wayfuse.llm.fingerprints import fingerprints
from wayfuse.llm.html_text import extract_text
from wayfuse.llm.lempel_ziv import dedup_digest
from wayfuse.llm.mixing import mix_report
from wayfuse.llm.packing import pack_documents
from wayfuse.llm.runs import run_report
from wayfuse.llm.set_join import near_sets
from wayfuse.llm.sharding import shard_documents
from wayfuse.llm.simhash import simhash_groups
from wayfuse.llm.suffix_array import dedup_bytes
from wayfuse.llm.toxicity import toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(settings(spark), sf_dir)
    return fn


@_query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


@_query
def op8_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(documents(spark, sf_dir))


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@_query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.quality(documents(spark, sf_dir))


ORACLES["op4_line_quality"] = line_quality.ORACLE


@_query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@_query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


@_query
def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir))


@_query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(documents(spark, sf_dir))


@_query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))


@_query
def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_sets(documents(spark, sf_dir), words_each=4, percent=85)
