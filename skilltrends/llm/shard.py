"""Operator 2. Sharding: a Feistel permutation with cycle walking over global row numbers.

Rows get gapless global numbers 0..N-1 without a global sort: a digest of (id, size, crc) puts
each row into one of 4096 buckets, the bucket counts give each bucket's first number, and a
window numbers the rows of a bucket. The permutation of that number is the row's place in the
shuffled order; place mod shards is the shard, place div shards the slot. Shard sizes in rows
differ by one at most (law ``rows``). ``row_number_at`` inverts the permutation, so the row in
any (shard, slot) can be found without the table.

Defined results: a null text counts no bytes (size 8, CRC-32 of nothing, 0); a null id is a
value like any other; rows equal in id, size and CRC are numbered next to each other in any
order; an empty table gives an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import feistel
from .common import carried, col, packed, unpacked

SHARDS, SEED, HEX_DIGITS = 24, 20240607, 3


def numbered(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with a column ``number`` (0..N-1), and N. Order: bucket, then ``keys``."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]))
    rows = rows.withColumn("bucket", F.substring(digest, 1, HEX_DIGITS))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    # 16 ** HEX_DIGITS rows at the most, whatever the input: one small task, safe to broadcast
    found = sorted((r["bucket"], r["n"]) for r in counts.collect())
    firsts, total = [], 0
    for b, n in found:
        firsts.append((b, total))
        total += n
    first = rows.sparkSession.createDataFrame(firsts, "b string, first long")
    inside = Window.partitionBy("bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    rows = rows.withColumn("place", F.row_number().over(inside))
    return (rows.join(F.broadcast(first), F.col("bucket") == F.col("b"))
            .withColumn("number", F.col("first") + F.col("place") - 1)
            .drop("b", "first", "place", "bucket")), total


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with size, text_crc32, law, shard, slot, grown_shard. ``carry``: the input
    columns to keep (default: all)."""
    text = F.coalesce(col(text_col), F.lit(""))
    columns = carried(docs, carry)
    rows = packed(docs, columns, id=col(id_col), size=(F.octet_length(text) + 8).cast("long"),
                  crc=F.crc32(F.encode(text, "UTF-8")))
    rows, total = numbered(rows, ["id", "size", "crc"])
    passes = feistel.longest_walk(docs.sparkSession, total, seed)
    rows = rows.withColumn("to", feistel.permute(F.col("number"), total, seed, passes))
    return unpacked(rows, columns, {
        "size": F.col("size"), "text_crc32": F.col("crc"), "law": F.lit("rows"),
        "shard": (F.col("to") % n_shards).cast("int"),
        "slot": F.floor(F.col("to") / n_shards).cast("long"),
        "grown_shard": F.lit(None).cast("int")})


def row_number_at(spark: SparkSession, shard: Column, slot: Column, total: int,
                  n_shards: int = SHARDS, seed: int = SEED) -> Column:
    """The global row number that sits in a (shard, slot)."""
    passes = feistel.longest_walk(spark, total, seed, inverse=True)
    return feistel.permute(slot * n_shards + shard, total, seed, passes, inverse=True)
