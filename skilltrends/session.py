"""Session construction and shared-storage helpers.

Lineage is cut with ``DataFrame.checkpoint()`` or by writing a table under the
folder named by ``spark.checkpoint.dir``, which must be storage that all executors share.
Tests and the benchmark set a folder of their own where the setting is absent.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CONF_KEY = "spark.checkpoint.dir"
#: Scratch paths made in the innermost open scope; None outside of any.
_MADE: ContextVar[list[str] | None] = ContextVar("scratch paths", default=None)


def build_session(master: str | None = None, app: str = "skilltrends",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC clock, UI off. Reuses an active session if any."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # remove checkpoint files of datasets that are no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, executor_cores_total: int,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on a cluster with
    ``executor_cores_total`` cores (e.g. 100 TB on 1000 executors x 8 cores).

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` each (they fit
    executor memory with room for spill); at least two tasks per core keep the cluster
    busy; AQE coalesces small partitions and splits skewed ones at runtime."""
    shuffle_parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # runtime broadcast only for sides AQE has measured small
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where neither is set this
    raises: a folder made here would be local to one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get(_CONF_KEY, None) or sc.getConf().get(_CONF_KEY, None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at storage that all executors share")
    sc.setCheckpointDir(configured)
    # the context appends a unique sub-folder; use what it reports
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path below the checkpoint folder (not created here)."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the scratch tables that the block makes when it ends, also by an error. A result that reads them has to be
    written elsewhere or collected inside the block. Gives the list of their paths. A scope inside another removes its own; other
    threads' tables are not touched. A run that is killed leaves its tables, all below the checkpoint folder."""
    from .sources.versioned import hadoop_path

    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)


def measured(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the checkpoint folder and read back, so that joins plan with its real size. A
    table made from Python rows has no known size: the planner would broadcast the other side."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
