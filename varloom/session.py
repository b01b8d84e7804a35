"""Session settings this package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Two score merges on the variant key and on variant key + gene then share
    # one shuffle of the wide table.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Keep input order when a task writes a few subshards: no sort on them.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Rows that a partition of a shuffle gets on average, at most: about 150 MB of the long table in a sort.
ROWS_PER_PARTITION = 400_000

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with, before adaptive execution joins small ones."""
    return int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def fit_shuffles(spark: SparkSession, rows: int) -> int:
    """Let shuffles of tables of about ``rows`` rows start with enough partitions; returns their number.

    A fixed number makes a task's memory grow with the input, and then its
    spills. Adaptive execution joins what turns out small, so the setting costs
    small tables nothing. Never below ``spark.sql.shuffle.partitions``.
    """
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))
    spark.conf.set(_INITIAL, str(number))
    return number


def build_session(app: str = "varloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
