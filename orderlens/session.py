"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Joins on hot keys rely on AQE's skew handling.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# The most that one task of a table query reads or takes from a shuffle, so that its sorts and hash tables stay small, and the
# longest method made of its columns.
TABLE_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.codegen.hugeMethodLimit": "8000",  # the JVM never compiles a longer method: wide stages go by one method an expression instead
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def small_tasks(spark: SparkSession) -> SparkSession:
    """Smaller tasks, where the session has not been given sizes of its own."""
    for key, value in TABLE_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "orderlens", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def use_local_folder(spark: SparkSession) -> SparkSession:
    """For tests and trials in local mode: a scratch folder of this machine where the session names none."""
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-cluster"):
        if spark.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="orderlens-"))
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and reuse: a reliable checkpoint, which keeps the placement of the rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_SCOPES: list[list[str]] = []  # folders of the tables that open scopes have to remove


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder, for frames that several scans read in part."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, in whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `stored` writes inside are removed at the end, so what is made of them has to be written before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query inside has shuffled is removed as soon as it ends, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
