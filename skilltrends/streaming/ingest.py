"""Incremental ingestion: delivered JSON-lines files flow to the clean layer, once for each version of a file.

A pass lists the landing folder (path, modification time, size; by Spark's reader, no content), compares
it with the sink's log (:mod:`..sources.versioned`) and takes what is new *or has changed*: a day file
delivered again under its own path replaces the rows it brought before. The rows are transformed by the
caller's function and written by day and delivered file; one commit then makes them visible and lets go of
what they replace. A pass that dies is made again by the next one; a rerun without deliveries does nothing.

A delivery (a day file ``<prefix>_DD_MM_YYYY.json``, or a folder of that name with part files) is named by its
path below the landing folder, so equal file names of two source folders are two deliveries. Parts may
land at any time; when a part comes, parts that are no longer in the folder go. A delivery may also come
again in a folder with a higher *delivery number* (``7`` or ``d7``, right above the day file; no such
folder is number 0): the highest number stands, lower ones go in the same commit and are not taken
when they arrive later. An empty file is no delivery; one with blank lines only is a delivery without rows. A changed
file of the same size and modification time (in milliseconds) is not seen.

``available_now=True`` makes passes until nothing is left and stops - the batch form of a file-arrival
trigger. Otherwise a stream's clock (``processingTime``) starts a pass in each micro-batch.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versioned as VS
from ..sources.jsonl import TS_NTZ_FORMAT
from ..sources.sinks import DELIVERY_PARTITIONS, write_daily


DELIVERY_RX = r"([^/=]+_\d{1,2}_\d{1,2}_\d{4}\.json)"
NUMBER_RX, DIGITS = r"(^|/)d?(\d{1,20})/$", 20
RETRIES = 5


def path_below(spark: SparkSession, landing: str, path_col: str) -> Column:
    """A landed file's path below the landing folder."""
    path = F.regexp_replace(path_col, "^([^:/]+):/+", "$1:/")
    root = re.sub("^([^:/]+):/+", r"\1:/", VS.hadoop_path(spark, landing)[1].toUri().toString()).rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def delivery_of(path: Column) -> tuple[Column, Column]:
    """(key, number): the delivery's path without its number, and the number, as text of equal length. A
    file without a day name is a delivery of its own."""
    folder, name = (F.regexp_extract(path, "^(|.*?/)[^/]*?" + DELIVERY_RX, i) for i in (1, 2))
    key = F.when(name == "", path).otherwise(F.concat(F.regexp_replace(folder, NUMBER_RX, "$1"), name))
    return key, F.lpad(F.regexp_extract(folder, NUMBER_RX, 2), DIGITS, "0")


def delivery_id(path: Column) -> Column:
    """What the rows of a landed file are partitioned by: the end of its name, to be read, and a digest."""
    return F.concat_ws("~", F.right(F.regexp_extract(path, "([^/]*)$", 1), F.lit(32)), F.md5(path))


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """(path, mtime, size, key, number, at) of every file below ``landing``; ``at`` is its full path."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(VS.literal_path(landing))
             .select(F.col("_metadata.file_path").alias("file_path"), F.col("path").alias("at"),
                     F.unix_millis("modificationTime").alias("mtime"), F.col("length").alias("size")))
    files = files.withColumn("path", path_below(spark, landing, "file_path"))
    key, number = delivery_of(F.col("path"))
    return files.select("path", "mtime", "size", key.alias("key"), number.alias("number"), "at")


def changes(spark: SparkSession, landing: str, sink: str, version: int) -> DataFrame:
    """What a pass has to do: (key, path, mtime, size, number, at, action). ``take``: read the file; ``let go``:
    its rows are replaced or its part is gone; ``note``: a lower number that came late."""
    now = landed(spark, landing).withColumn("here", F.lit(True))
    then = VS.state(spark, sink, version).select("path", *[F.col(c).alias(f"old_{c}") for c in ("mtime", "size", "key", "number", "files")])
    both = now.join(then, "path", "full_outer").withColumns({
        "key": F.coalesce("key", "old_key"), "number": F.coalesce("number", "old_number"), "here": F.coalesce("here", F.lit(False))})
    new = F.col("here") & ~(F.col("mtime").eqNullSafe(F.col("old_mtime")) & F.col("size").eqNullSafe(F.col("old_size")))
    both = both.withColumn("new", new)
    of_key = both.groupBy(F.col("key").alias("k")).agg(F.max("number").alias("newest"), F.max("new").alias("touched")).filter("touched")
    both = both.join(of_key, F.col("key") == F.col("k"))
    action = (F.when(F.col("new") & (F.col("number") == F.col("newest")), "take")
              .when((F.size("old_files") > 0) & (~F.col("here") | (F.col("number") < F.col("newest"))), "let go")
              .when(F.col("new"), "note"))
    return both.withColumn("action", action).filter("action IS NOT NULL").select(
        "key", "path", F.coalesce("mtime", "old_mtime").alias("mtime"), F.coalesce("size", "old_size").alias("size"), "number", "at", "action")


def by_delivery(rows: list, most: int | None) -> Iterator[list]:
    """Changes in lists of about ``most``; those of a delivery stay together."""
    batch: list = []
    for i, r in enumerate(rows):
        if batch and most and len(batch) >= most and r.key != rows[i - 1].key:
            yield batch
            batch = []
        batch.append(r)
    if batch:
        yield batch


def take(spark: SparkSession, landing: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], sink: str,
         fmt: str, batch: list, version: int) -> int:
    """Write the rows of the files to be taken, then commit: the batch's files get theirs, the others none."""
    paths = [VS.literal_path(r.at) for r in batch if r.action == "take"]
    files: dict[str, list[str]] = {}
    if paths:
        folder = f"commit={uuid.uuid4().hex}"
        rows = (spark.read.schema(schema).option("timestampNTZFormat", TS_NTZ_FORMAT).option("mode", "PERMISSIVE").json(paths)
                .withColumn("source_file", F.col("_metadata.file_path")))
        rows = rows.withColumn("delivery", delivery_id(path_below(spark, landing, "source_file")))
        write_daily(transform(rows), f"{sink}/data/{folder}", fmt, DELIVERY_PARTITIONS)
        for f in VS.files_below(spark, f"{sink}/data/{folder}"):
            files.setdefault(f.split("/")[-2][-32:], []).append(f"{folder}/{f}")
    entries = [{"path": r.path, "mtime": r.mtime, "size": r.size, "key": r.key, "number": r.number,
                "files": files.get(hashlib.md5(r.path.encode()).hexdigest(), []) if r.action == "take" else []} for r in batch]
    return VS.write_commit(spark, sink, version, entries)


def one_pass(spark: SparkSession, landing: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], sink: str,
             fmt: str = "parquet", max_files: int | None = None) -> list[int]:
    """Take all that is new; returns the versions committed. Where another writer commits first, the rest of the
    changes is worked out again."""
    made: list[int] = []
    for _ in range(RETRIES):
        version = VS.last_version(spark, sink)
        rows = sorted(changes(spark, landing, sink, version).collect(), key=lambda r: (r.key, r.path))  # a row per landed file that changed
        try:
            for batch in by_delivery(rows, max_files):
                version = take(spark, landing, schema, transform, sink, fmt, batch, version + 1)
                made.append(version)
            return made
        except VS.CommitConflict:
            continue
    raise VS.CommitConflict(f"{sink}: {RETRIES} conflicts in a row")


def ingest(spark: SparkSession, landing: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame],
           sink: str, checkpoint: str | None = None, fmt: str = "parquet", available_now: bool = True,
           max_files_per_trigger: int | None = None, every: str = "1 minute"):
    """Ingest what is there and return the versions committed, or (``available_now=False``) start a stream that
    makes a pass ``every`` so often, with its clock's checkpoint in ``checkpoint``, and return it.

    Each landed row carries ``source_file`` (its file path) for date stamping and ``delivery``; ``transform``
    must keep ``delivery`` and add year, month, day. Read the sink with :func:`..sources.versioned.read_live`."""
    def run(*_) -> list[int]:
        return one_pass(spark, landing, schema, transform, sink, fmt, max_files_per_trigger)

    if available_now:
        return run()
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (clock.writeStream.foreachBatch(lambda batch, batch_id: run() and None).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())
