"""Session settings the plans rely on, and frames written to the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Skewed join partitions are split at run time even where the split costs an
# extra shuffle further up: one student or course may hold a third of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# A side of a join goes through the driver when it is broadcast. Its size is at first estimated from
# compressed files, and may be a hundred times as much in memory, as of repeated rows: only small
# estimates count. The cluster's own limit holds for sizes that a run has measured.
ESTIMATED = "spark.sql.autoBroadcastJoinThreshold"
MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"
SMALL_ESTIMATE = "256k"

# What one task reads of a shuffle, unless the cluster says so: rows of codes and dates take
# some twenty times their compressed size in a task's memory.
TOGETHER = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
READ_TOGETHER = "16m"

# What a written frame was shuffled for is read from its files from then on: the shuffles go when it is written,
# not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders written within the innermost open block of ``scratch``.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the run-time skew handling, broadcast by measured sizes, and small tasks of a shuffle.

    Parallelism stays the cluster's, and broadcasts stay off where it turns them off.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(ESTIMATED) != "-1":
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, spark.conf.get(ESTIMATED))
        spark.conf.set(ESTIMATED, SMALL_ESTIMATE)
    if spark.conf.get(TOGETHER, None) is None:
        spark.conf.set(TOGETHER, READ_TOGETHER)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    return folder


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _write(df: DataFrame, path: str) -> None:
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO)
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written to the shared folder for the time of the block; its files go afterwards."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    try:
        _write(df, path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete(spark, path)


def materialized(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a frame that is read several times: the plan runs once, a lost executor
    re-reads files, and joins know the frame's true size. The files go with the
    ``scratch`` block around the call, or by ``discard``; without either they stay
    until the folder is cleaned.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    _write(df, path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing reads any more."""
    for df in frames:
        path = df.__dict__.pop("_written_to", None)
        if path is not None:
            _delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Frames materialized in the block go at its end, also when it fails.

    The block's ``keep`` writes a frame that outlasts it: the frame belongs to the
    block around this one, if there is one.
    """
    outer, token = _WRITTEN.get(), _WRITTEN.set([])

    def keep(df: DataFrame) -> DataFrame:
        own = _WRITTEN.set(outer)
        try:
            return materialized(df)
        finally:
            _WRITTEN.reset(own)

    try:
        yield keep
    finally:
        written = _WRITTEN.get() or []
        _WRITTEN.reset(token)
        for path in written:
            _delete(spark, path)
