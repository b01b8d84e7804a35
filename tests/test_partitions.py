"""Shuffles start with partitions in proportion to the rows, whatever the session's fixed number."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from fixture_tables import fixture
from test_queries import SF_DIR
from varloom.operators.joins import heavy_keys
from varloom.session import fit_shuffles, shuffle_partitions


@pytest.fixture
def small_partitions(spark, monkeypatch):
    monkeypatch.setattr("varloom.session.ROWS_PER_PARTITION", 100)
    yield
    monkeypatch.undo()
    fit_shuffles(spark, 0)


def test_partitions_follow_the_rows(spark, small_partitions):
    assert fit_shuffles(spark, 10) == shuffle_partitions(spark) == 8
    assert fit_shuffles(spark, 6001) == shuffle_partitions(spark) == 61


def test_heavy_keys_are_measured_by_the_fitted_number(spark, small_partitions, monkeypatch):
    monkeypatch.setattr("varloom.operators.joins.MIN_HEAVY_ROWS", 10)
    # A tenth of the rows has one key: less than twice the share of one partition of eight, more than of one of 20.
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    fit_shuffles(spark, 0)
    assert not heavy_keys(df, ["k"])
    fit_shuffles(spark, 2100)
    assert heavy_keys(df, ["k"]).splits


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_entries_meet_their_sites_without_another_exchange(spark, small_partitions, tmp_path):
    for table in ("supplier", "part", "orders", "lineitem"):
        shutil.copy(f"{SF_DIR}/{table}.parquet", tmp_path / f"{table}.parquet")
    blocks = fixture(spark, str(tmp_path), "csq_blocks")
    partitions = shuffle_partitions(spark)
    assert partitions > 50
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and f", {partitions})" in plan and "RoundRobin" not in plan
