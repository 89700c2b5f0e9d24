"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, langid, lexical_search, mix, periodic_runs, quality_model, quality_rules, shard, simhash,
               substring_dedup, token_count, toxicity, url_filter)
from .common import read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.score_documents(docs, carry=["doc_id"]).drop("failed_rule")


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return shard.shard_documents(docs, carry=["doc_id"])


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.mix_sources(docs, carry=["doc_id"])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), carry=["page_id"])


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.score_quality(docs, read(spark, sf_dir, "labels"), carry=["doc_id"])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(docs, read(spark, sf_dir, "benchmark"), carry=["doc_id"]).drop("spans")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, read(spark, sf_dir, "labels"), carry=["doc_id"]).drop("spans")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, carry=["doc_id"])


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(docs, plant_by="doc_id", carry=["doc_id"]).drop("runs")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, read(spark, sf_dir, "benchmark"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, carry=["doc_id"]).drop("spans")


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_feistel_shards, op3_source_mix, op4_language_id, op5_url_filter, op6_quality_classifier,
    op7_decontamination, op8_toxicity, op9_simhash_dedup, op10_token_counts, op11_periodic_runs, op12_lexical_search,
    op13_substring_dedup)}
