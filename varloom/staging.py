"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_root: list[str] = []
_scopes: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="varloom-"))
    return _local_root[0]


def staging_path(spark: SparkSession) -> str:
    """A fresh path in the staging folder."""
    return f"{staging_root(spark)}/staged-{uuid.uuid4().hex}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions inside remove their shuffle files as they end, instead of when the driver next collects its garbage.

    For actions whose result is stored or small: nothing reads those files again,
    and a build of many steps would hold the exchanges of all of them at once.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives the loss of executors, and lets later size and
    skew checks read single columns instead of recomputing the plan.
    """
    path = staging_path(df.sparkSession)
    if _scopes:
        _scopes[-1].append(path)
    with short_lived_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in any store that Spark reaches; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, so write what depends on them before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_path(spark, path)
