"""A training-text pipeline over ``documents``: classify, near-dedup, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns a
DataFrame, which ``run`` writes as Parquet and reads back as the next stage's docs. All stages but
the last return the columns of documents; further columns of the input, whatever their names, come through
unchanged to the last stage, whose results replace those of their names.

Defined results: a null or empty text is scored like a text without words by the first stage, links with
other empty ones in the second, is never contaminated, and has no words to be mixed, so it ends there; null ids
and sources are values like any other; of repeated rows one stays (second stage); very long texts pass
whole; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltrends.llm import decontaminate, mix, quality_model, shard, simhash
from skilltrends.llm.common import col, read, stored


def kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """Rows of ``docs`` for which an operator's results fulfil ``condition``. The operator sees the id, the text
    and the row's other columns packed in one, so its results overwrite none of them."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias("rest"), "doc_id", "text")
    fields = {c: F.col("rest").getField(f"c{i}") for i, c in enumerate(rest)} | {"text": F.col("text")}
    return judge(rows).filter(condition).select(*[fields[c].alias(c) for c in docs.columns])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    labels = read(spark, sf_dir, "labels")
    return kept(docs, lambda rows: quality_model.score_quality(rows, labels, carry=["rest", "text"]), "predicted = 1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with benchmark items."""
    benchmark = read(spark, sf_dir, "benchmark")
    return kept(docs, lambda rows: decontaminate.find_contamination(rows, benchmark, carry=["rest", "text"]), "NOT contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights, a row per copy of a whole document."""
    return mix.mixed_documents(docs)


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return shard.shard_documents(docs)


STAGES = [("classify", classify), ("near_dedup", near_dedup), ("decontaminate", drop_contaminated),
          ("mix", mix_sources), ("shard", shard_rows)]

#: The trained classifier of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
