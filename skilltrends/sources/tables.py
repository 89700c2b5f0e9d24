"""Parquet table access for the test-data layout ``{dir}/{name}.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Tables whose rows carry enough per-row work (long texts, wide fan-out) that a scan
# in fewer tasks than cores leaves the cluster idle.
CPU_HEAVY = {"documents", "pages", "conversations", "lineitem"}


# Key each CPU-heavy table is spread on (later per-key work then needs no exchange).
SPREAD_KEY = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def spread(df: DataFrame, min_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks when its scan has fewer.

    A large input is split by the file reader already (this is then a no-op); a small
    file with a single row group would otherwise run all per-row work in one task.
    With ``key`` the rows are hash-partitioned on it, which later aggregations and
    windows on that key reuse."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want, key) if key else df.repartition(want)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table. Projections and filters applied later reach the parquet scan."""
    if name not in TABLES:
        raise KeyError(name)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, key=SPREAD_KEY.get(name)) if name in CPU_HEAVY else df
