"""Document frequencies as a state that deliveries are added to and taken from.

Each delivery has a table of its own (token, df), and their sum stands beside them. A delivery that comes again is
subtracted as it was and added as it is, so a refit of the idf reads two deliveries' counts and the sum and never
the corpus. The tables are immutable; a commit log (:mod:`..sources.versioned`) names the ones that stand, so a
run that dies leaves the former state, two writers can't both commit, and readers see one version."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versioned as VS
from .select_text import document_frequencies, idf_model

#: Log entry of the sum; deliveries are entries below ``delivery/``.
TOTAL = "total"


def _entry(path: str, folder: str) -> dict:
    return {"path": path, "mtime": 0, "size": 0, "key": path, "number": "0", "files": [folder]}


def _tables(spark: SparkSession, state: str, version: int) -> dict[str, str]:
    """Folder of the sum and of every delivery at a version: one row a delivery."""
    return {r.path: r.files[0] for r in VS.state(spark, state, version).select("path", "files").collect() if r.files}


def _read(spark: SparkSession, state: str, folder: str) -> DataFrame:
    return spark.read.schema("token STRING, df BIGINT").parquet(f"{state}/{folder}")


def deliver(spark: SparkSession, state: str, delivery: str, passages: DataFrame, text_col: str = "passage") -> int:
    """Put the passages of ``delivery`` in the place of what it held before; returns the new version.

    An empty delivery takes its earlier counts out. Raises :class:`~..sources.versioned.CommitConflict` where another writer
    committed meanwhile; the call can then be repeated."""
    version = VS.last_version(spark, state)
    tables, name = _tables(spark, state, version), f"delivery/{delivery}"
    own, total = (f"data/{uuid.uuid4().hex}" for _ in range(2))
    document_frequencies(passages, text_col).write.parquet(f"{state}/{own}")
    parts = _read(spark, state, own)
    if TOTAL in tables:
        parts = parts.unionAll(_read(spark, state, tables[TOTAL]))
    if name in tables:
        parts = parts.unionAll(_read(spark, state, tables[name]).select("token", -F.col("df")))
    parts.groupBy("token").agg(F.sum("df").alias("df")).where("df <> 0").write.parquet(f"{state}/{total}")
    return VS.write_commit(spark, state, version + 1, [_entry(name, own), _entry(TOTAL, total)])


def current_idf(spark: SparkSession, state: str, version: int | None = None) -> DataFrame:
    """The idf model (token, df, idf) of all deliveries that stand, equal to a fit over their passages; empty without any."""
    version = VS.last_version(spark, state) if version is None else version
    folder = _tables(spark, state, version).get(TOTAL)
    return idf_model(_read(spark, state, folder) if folder else spark.createDataFrame([], "token STRING, df BIGINT"))
