"""Helpers shared by the operators: table access, scratch tables, packed rows, text blocks."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

SPACE_RX = r"[\x20\x09-\x0D]"
WORD_RX = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage ends here
    and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value whose size the caller bounds; the result, called in a task, gives it back."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame, carry: list[str] | None) -> list[str]:
    """The input columns that a result keeps: all, or those named."""
    return [c for c in docs.columns if carry is None or c in carry]


def packed(docs: DataFrame, columns: list[str], text: str | None = None, **extra: Column) -> DataFrame:
    """The input ``columns`` as one struct ``row`` beside the operator's own columns, so that no column
    name of the input can meet one of the operator's. The column ``text`` stands apart as ``t``."""
    inner = [col(c).alias(c) for c in columns if c != text] or [F.lit(True).alias("_")]
    apart = [] if text is None else [col(text).alias("t")]
    return docs.select(F.struct(*inner).alias("row"), *apart, *[v.alias(k) for k, v in extra.items()])


def unpacked(df: DataFrame, columns: list[str], results: dict[str, Column], text: str | None = None) -> DataFrame:
    """Input columns back, in their order, then the results. An input column named like a result (in
    any letter case) gives way to the result."""
    taken = {k.lower() for k in results}
    return df.select(*[F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in results.items()])


def row_blocks(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Cut rows 0..n into runs whose sizes sum to ``most`` at the most (one row may exceed it)."""
    at, total = 0, 0
    for i, s in enumerate(sizes):
        if i > at and total + s > most:
            yield at, i
            at, total = i, 0
        total += s
    if at < len(sizes):
        yield at, len(sizes)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches re-cut so that each holds ``most`` bytes of text, or one longer row."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for a, b in row_blocks(sizes.tolist(), most):
            yield batch.slice(a, b - a)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array], keep: list[str]) -> pa.RecordBatch:
    """The columns ``keep`` of a batch and new ones."""
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *columns.values()], names=[*keep, *columns])


def map_texts(rows: DataFrame, keep_text: bool, results: dict[str, T.DataType], block_bytes: int | Callable[[Any], int],
              score: Callable[..., dict[str, pa.Array]], state: Callable[[], Any] = lambda: None, beside: str | None = None) -> DataFrame:
    """Map whole texts (column ``t``) in blocks of bounded size, in Arrow batches: ``score`` gets the texts
    of a block, the task's state and, if named, the column ``beside``, and gives the columns ``results``."""
    keep = [c for c in rows.columns if keep_text or c != "t"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = state()
        most = block_bytes(held) if callable(block_bytes) else block_bytes
        for batch in text_blocks(batches, "t", most):
            more = [] if beside is None else [batch.column(beside)]
            yield with_columns(batch, score(batch.column("t"), held, *more), keep)

    return rows.mapInArrow(run, T.StructType([*[rows.schema[c] for c in keep], *[T.StructField(k, v) for k, v in results.items()]]))
