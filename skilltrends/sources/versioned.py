"""A sink whose live files a commit log names.

Data files lie below ``data/commit=<id>`` and are never changed. ``_log`` holds one JSON-lines file per commit,
``<version>.json``: an entry for each delivered file (path, modification time, size, delivery key and number)
with the data files that hold its rows now, or none. The last entry of a path stands. A commit file gets its
name by one rename that fails where the version exists, so a commit is there whole or not at all, two writers can't make
the same version, and a reader, who takes the files that one version names, sees a delivery before or after it
is replaced and never both. A run that dies before its commit leaves files that no version names.

Nothing lists the sink: readers and writers read the log, which a snapshot shortens every
``SNAPSHOT_EVERY`` commits. ``vacuum`` removes the data files that no recent version names."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_EVERY = 20
#: One delivered file: where, when and how large it was, the delivery it belongs to, and its rows' files.
ENTRY = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("mtime", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("number", T.StringType()), T.StructField("files", T.ArrayType(T.StringType()))])


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def hadoop_path(spark: SparkSession, path: str):
    """A path with its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, fs.makeQualified(p)


def literal_path(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def log_files(spark: SparkSession, sink: str) -> tuple[list[int], list[int]]:
    """Versions with a commit file, and versions with a snapshot."""
    fs, log = hadoop_path(spark, f"{sink}/_log")
    names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
    commits = sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d{20})\.json", n)))
    return commits, sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d{20})\.snapshot", n)))


def last_version(spark: SparkSession, sink: str) -> int:
    commits, _ = log_files(spark, sink)
    return commits[-1] if commits else 0


def state(spark: SparkSession, sink: str, version: int | None = None) -> DataFrame:
    """The entries that stand at ``version`` (default: the last), one per delivered file."""
    commits, snapshots = log_files(spark, sink)
    version = (commits[-1] if commits else 0) if version is None else version
    base = max((s for s in snapshots if s <= version), default=0)
    names = [f"{v:020d}.json" for v in commits if base < v <= version] + ([f"{base:020d}.snapshot"] if base else [])
    if not names:
        return spark.createDataFrame([], ENTRY)
    entries = spark.read.schema(ENTRY).json([literal_path(f"{sink}/_log/{n}") for n in names])
    made = F.regexp_extract("_metadata.file_path", r"(\d{20})\.(json|snapshot)", 1)
    return entries.groupBy("path").agg(F.max_by(F.struct(*ENTRY.names[1:]), made).alias("e")).select("path", "e.*")


def write_commit(spark: SparkSession, sink: str, version: int, entries: list[dict]) -> int:
    """Commit ``entries`` as ``version``, or raise :class:`CommitConflict` where it exists."""
    fs, log = hadoop_path(spark, f"{sink}/_log")
    fs.mkdirs(log)
    jvm = spark._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(log, f".{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # never over an existing file
    try:
        context.rename(tmp, jvm.org.apache.hadoop.fs.Path(log, f"{version:020d}.json"), plain)
    except Exception as e:
        fs.delete(tmp, False)
        if "FileAlreadyExists" in str(e):
            raise CommitConflict(f"version {version} of {sink}") from e
        raise
    if version % SNAPSHOT_EVERY == 0:
        snapshot(spark, sink, version)
    return version


def snapshot(spark: SparkSession, sink: str, version: int) -> None:
    """The state of a version as a folder of its own, put in place by one rename."""
    fs, log = hadoop_path(spark, f"{sink}/_log")
    tmp = f"{sink}/_log/.{uuid.uuid4().hex}.tmp"
    state(spark, sink, version).write.json(tmp)
    fs.rename(hadoop_path(spark, tmp)[1], spark._jvm.org.apache.hadoop.fs.Path(log, f"{version:020d}.snapshot"))


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Data files of one commit's folder."""
    fs, root = hadoop_path(spark, folder)
    if not fs.exists(root):
        return []
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        path = files.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append(path.toString().removeprefix(root.toString()).lstrip("/"))
    return sorted(found)


def read_live(spark: SparkSession, sink: str, schema: T.StructType | None = None, version: int | None = None,
              fmt: str = "parquet") -> DataFrame:
    """The rows that stand at ``version`` (default: the last), with the day columns. An empty sink needs ``schema``."""
    files = [r[0] for r in state(spark, sink, version).select(F.explode("files")).collect()]
    if not files:
        if schema is None:
            raise ValueError(f"{sink} has no rows; give a schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).option("basePath", f"{sink}/data")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([literal_path(f"{sink}/data/{f}") for f in sorted(files)]).drop("commit", "delivery")


def vacuum(spark: SparkSession, sink: str, keep: int = 2) -> int:
    """Remove the data files that none of the last ``keep`` versions names; returns how many. Readers of older
    versions lose them."""
    last = last_version(spark, sink)
    kept = [state(spark, sink, v).select(F.explode("files").alias("f")) for v in range(max(1, last - keep + 1), last + 1)]
    if not kept:
        return 0
    commits, _ = log_files(spark, sink)
    every = spark.read.schema(ENTRY).json([literal_path(f"{sink}/_log/{v:020d}.json") for v in commits]).select(F.explode("files").alias("f")).distinct()
    for k in kept:
        every = every.join(k, "f", "left_anti")
    gone = [r.f for r in every.collect()]
    fs, root = hadoop_path(spark, f"{sink}/data")
    return sum(bool(fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f), False)) for f in gone)
