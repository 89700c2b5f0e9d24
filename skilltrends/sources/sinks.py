"""Sinks: JSON lines for interchange, Parquet partitioned by day for the clean layer.

Dynamic partition overwrite rewrites the partitions present in the written frame and leaves the
others alone. A partition is a day, or a day and the delivered file, so that a re-delivery replaces
what it delivers again and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jsonl import TS_NTZ_FORMAT

DAY_PARTITIONS = ("year", "month", "day")
DELIVERY_PARTITIONS = (*DAY_PARTITIONS, "delivery")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("timestampNTZFormat", TS_NTZ_FORMAT).json(path)
    return path


def write_daily(df: DataFrame, path: str, fmt: str = "parquet",
                partitions: tuple[str, ...] = DAY_PARTITIONS, max_records_per_file: int = 5_000_000) -> str:
    """Write (or re-deliver) partitions: only those present in ``df`` are replaced.

    Rows are rebalanced on the partition columns first: small partitions meet in one task and become
    one file each, a large one is split over tasks by its measured size; no file holds
    more than ``max_records_per_file`` rows."""
    (df.hint("rebalance", *[F.col(c) for c in partitions])
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", str(max_records_per_file))
       .partitionBy(*partitions)
       .format(fmt)
       .save(path))
    return path
