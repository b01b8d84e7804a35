"""What the search for heavy keys, the overlap join and the domain flags exchange and store."""

import random

import pytest
from pyspark.sql import functions as F

import varloom as v
from varloom.operators import intervals, joins, scores
from vcf_cases import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_search_for_heavy_keys_shuffles_no_rows(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 5 > 0, F.when(F.col("id") % 5 == 1, F.lit(-1)).otherwise(F.col("id"))).alias("k"))
    found = joins._frequent_hashes(df, ["k"], 8)
    assert "hashpartitioning" not in plan(found)
    hot = df.where("k = -1").select(F.xxhash64("k")).first()[0]
    assert {r["item"]: r["count"] for r in found.first().top if r["count"] > 1000} == {hot: 10_000, None: 10_000}


def test_heavy_keys_of_skewed_tables_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 100)
    rng = random.Random(5)
    counts = {k: rng.choice([1, 3, 40, 15_000]) for k in range(12)} | {k: 1 for k in range(100, 6100)}
    df = spark.createDataFrame([(k, n) for k, n in counts.items()], "k long, n int").select("k", F.explode(F.sequence(F.lit(1), "n"))).repartition(7)
    limit = 2 * sum(counts.values()) / 8
    wanted = {r.h for r in df.select(F.xxhash64("k").alias("h"), "k").distinct().collect() if counts[r.k] >= limit}
    assert set(joins.heavy_keys(df, ["k"]).splits) == wanted


@pytest.mark.parametrize("longest", [94, 5_000_000])
def test_intervals_visit_even_levels_only(spark, longest):
    spans = spark.range(longest // 50, longest + 1, longest // 50).selectExpr("id * 77 as _start", "id * 78 as _end")
    placed = spans.withColumn("_own", F.expr(intervals.even_level("_start", "_end")))
    assert intervals.in_bins(placed).count() <= 2 * spans.count()
    assert placed.where("_own % 2 = 1 or shiftleft(1L, _own) < _end - _start").count() == 0
    assert placed.select("_own").distinct().count() <= 4


@pytest.mark.parametrize("least", [10, joins.MIN_HEAVY_ROWS])
def test_domain_flags_are_stored_nowhere_and_split_hot_residues(spark, monkeypatch, least):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", least)
    stored = []
    monkeypatch.setattr(scores, "staged", lambda df, keep=scores.staged: stored.append(df.columns) or keep(df))
    df = spark.range(600).selectExpr("concat('v', if(id % 3 = 0, 0, id % 90)) AS id", "concat('g', id % 2) AS region", "if(id % 4 > 0, '7-90', cast(id AS string)) AS protein_position")
    domains = spark.createDataFrame([("g0", 5, 9, True, False), ("g0", 80, 95, False, True), ("g1", 1, 3, True, True), ("g1", 90, 90, True, False)],
                                    "region string, domain_start int, domain_end int, a boolean, b boolean")
    found = v.domain_overlap(df, domains, ["a", "b"])
    assert stored == [["id", "region", "residue"]]
    hit = "array_contains(transform(split(split(protein_position, '/')[0], '-'), x -> cast(x AS int) BETWEEN domain_start AND domain_end), true)"
    flags = df.join(domains, "region").where(hit).groupBy("id", "region").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    assert rows(found) == rows(df.join(flags, ["id", "region"], "left").na.fill(False, ["a", "b"]).select(found.columns))
