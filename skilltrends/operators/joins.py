"""Joins whose hot keys Spark can split.

Spark splits a skewed partition only where both sides of a sort-merge join come straight from a
shuffle made for that join. A side that was just aggregated on the key is partitioned already,
gets no such shuffle, and blocks the split for the other side too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``left`` with ``right``, which has one row per key (an aggregate), so that a hot key of
    ``left`` is spread over tasks at run time.

    The join key is the one-field struct of ``key``: equal exactly where the keys are, but not the
    expression the aggregate is partitioned on, so both sides get a shuffle of their own. NULL keys
    match nothing."""
    if how not in ("inner", "left"):
        raise ValueError(how)
    r = right.where(F.col(key).isNotNull()).select(F.struct(F.col(key).alias("k")).alias("_k"),
                                                   *[F.col(c) for c in right.columns if c != key])
    joined = left.join(r, F.struct(F.col(key).alias("k")) == F.col("_k"), how)
    return joined.drop("_k")
