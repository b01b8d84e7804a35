import pytest
from pyspark.sql import functions as F

from vcf_cases import rows
from varloom.operators import joins
from varloom.operators.joins import (
    balanced_join, balanced_membership, heavy_keys, join_variants, lookup_join, measured_bytes, membership_join,
)


@pytest.fixture(autouse=True)
def small_counts_are_heavy(monkeypatch):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 100)


@pytest.fixture(scope="module")
def left(spark):
    """A third of the rows on key (a, 1), a sixth with a null key, the rest spread."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 6 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("name"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).cast("long").alias("n"),
        F.col("id").alias("v"))


@pytest.fixture(scope="module")
def right(spark):
    """Keys of the left side, some missing, some twice, plus null keys."""
    keys = spark.range(700).where("id % 4 <> 0").select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"))
    many = keys.withColumn("n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    hot = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("zzz", 1)], "name string, n long")
    return many.union(hot).withColumn("score", F.xxhash64("name", "n") % 100)


def test_heavy_keys_finds_the_hot_key_and_nulls(left):
    heavy = heavy_keys(left, ["name", "n"])
    assert len(heavy.splits) == 1 and heavy.null_splits == 1 and set(heavy.splits.values()) == {8}  # a third of 8 partitions, in half shares
    only_nulls = heavy_keys(left.withColumn("name", F.lit(None).cast("string")), ["name", "n"])
    assert not only_nulls.splits and only_nulls.null_splits == 16


def test_few_rows_are_never_heavy(left, monkeypatch):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 10_000)
    assert not heavy_keys(left, ["name", "n"])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_left_key(left, right, how):
    got = balanced_join(left, right, ["name", "n"], how)
    assert "_ls" in got._jdf.queryExecution().toString()
    assert rows(got) == rows(left.join(right, ["name", "n"], how).select(got.columns))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_right_key(left, right, how):
    """The many-rows side on the right: matches meet once, misses stay single."""
    fewer = right.where("name <> 'k5'")
    got = balanced_join(fewer, left.withColumnRenamed("v", "w"), ["name", "n"], how)
    assert "_rs" in got._jdf.queryExecution().toString()
    wanted = fewer.join(left.withColumnRenamed("v", "w"), ["name", "n"], how)
    assert rows(got) == rows(wanted.select(got.columns))


def test_both_sides_hot(spark):
    a = spark.range(400).select(F.when(F.col("id") % 2 == 0, "x").otherwise(F.col("id").cast("string")).alias("k"), "id")
    b = a.withColumnRenamed("id", "other").where("other < 300")
    got = balanced_join(a, b, ["k"], "left")
    assert rows(got) == rows(a.join(b, "k", "left").select(got.columns))


def test_identical_rows_keep_their_number(spark):
    a = spark.range(1000).select(F.lit("x").alias("k"), F.lit(1).alias("v"))
    b = spark.createDataFrame([("x", 7), ("y", 8)], "k string, s int")
    assert balanced_join(a, b, ["k"], "left").count() == 1000
    assert balanced_join(b, a, ["k"], "left").count() == 1001


def test_all_left_keys_null(left, right):
    nulls = left.withColumn("name", F.lit(None).cast("string"))
    got = balanced_join(nulls, right, ["name", "n"], "left")
    assert got.count() == 6000 and got.where("score is not null").count() == 0


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_membership(left, right, how):
    got = balanced_membership(left, right, ["name", "n"], how)
    assert rows(got) == rows(left.join(right, ["name", "n"], how).select(got.columns))


@pytest.mark.parametrize("max_bytes", [0, joins.MAX_BROADCAST_BYTES])
def test_lookup_is_the_same_broadcast_or_not(left, right, max_bytes):
    got = lookup_join(left, right, ["name", "n"], "left", max_bytes)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (max_bytes > 0)
    assert rows(got) == rows(left.join(right, ["name", "n"], "left").select(got.columns))
    kept = membership_join(left, right, "name", max_bytes)
    assert rows(kept) == rows(left.join(right, "name", "left_semi").select(kept.columns))


def test_measured_bytes_counts_text(spark):
    small = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    assert measured_bytes(small) == 2 * 3 * 16 + 2
    assert measured_bytes(small.where("n > 5")) == 0


def test_key_types_must_agree(spark, left):
    other = left.withColumn("n", F.col("n").cast("int"))
    with pytest.raises(TypeError, match="join key 'n'"):
        balanced_join(left, other, ["n"])


def test_join_variants_checks_types(spark):
    a = spark.createDataFrame([("chr1", 5, "A", "T", "x")], "CHROM string, POS long, REF string, ALT string, c string")
    b = a.select("CHROM", F.col("POS").cast("int").alias("POS"), "REF", "ALT")
    with pytest.raises(TypeError, match="POS"):
        join_variants(a, b)
    assert join_variants(a, a.drop("c")).count() == 1
    assert join_variants(a, a.drop("c"), "left_anti").count() == 0
    assert join_variants(a, a.drop("c"), "outer").count() == 1
