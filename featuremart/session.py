"""Session defaults and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables bucketed by customer join by customer and date where they lie
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}
# fixed at start; recording the Python call site of every column costs more than planning itself
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


def build_session(app: str = "featuremart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs assume, where neither ``conf`` nor the submit says otherwise.

    Adaptive execution re-plans joins from measured sizes, splits skewed join
    partitions and merges small ones.  Dynamic partition overwrite makes a re-run of
    one snapshot replace only that snapshot.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    given = session.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in conf and not given.contains(key):
            session.conf.set(key, value)
    return session


def ensure_shared_folder(spark: SparkSession) -> SparkSession:
    """Give a local session without a configured folder one of its own; clusters must name theirs."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written intermediates, below the session's checkpoint folder."""
    base = _RUN.get() or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    system, place = file_system(spark, path)
    system.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for all intermediates written inside the block; it is removed at the end.

    Results must be written elsewhere before the block ends.
    """
    folder = shared_folder(spark, "run")
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        removed(spark, folder)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside the block; what it was before is put back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialise(df: DataFrame, name: str = "intermediate") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    For results that several actions read: columns and filters still reach the scan, and
    the data survives the loss of executors.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
