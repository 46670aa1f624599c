"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm.base import table
from daypanel.llm import queries_sql, quality_nbsvm, toxicity, url_lists
from daypanel.llm.decontaminate import leaks
from daypanel.llm.html_text import extract
from daypanel.llm.importance import resample
from daypanel.llm.line_dedup import dedup_lines
from daypanel.llm.merkle import tampered, verify
from daypanel.llm.mixing import mix
from daypanel.llm.ngram_join import jaccard_classes
from daypanel.llm.quality_rules import clean_lines
from daypanel.llm.secret_scan import scan
from daypanel.llm.sharding import shard_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    if sql := getattr(queries_sql, function.__name__.split("_")[0].upper(), None):
        ORACLES[function.__name__] = sql
    return function


@_query
def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_classes(table(spark, sf, "documents"))


@_query
def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages"))


@_query
def op3_toxicity_chain(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"))
    return scored.drop("text")


@_query
def op4_quality_nbsvm(spark: SparkSession, sf: str) -> DataFrame:
    return quality_nbsvm.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@_query
def op5_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents"))


@_query
def op6_temporal_url_list(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return url_lists.filter_captures(url_lists.captures_of(pages), url_lists.list_of(pages))


@_query
def op7_line_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_lines(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "n_removed", "chars_removed", "text")


@_query
def op8_line_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return clean_lines(table(spark, sf, "documents"))


@_query
def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query
def op10_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@_query
def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@_query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return verify(table(spark, sf, "documents"), tampered(F.col("doc_id"), F.col("text"))).drop("source")


@_query
def op13_hypergeometric_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shard_rows(table(spark, sf, "documents"))
