"""What the physical plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

import varloom as v
from varloom.functions.keys import VARIANT_KEY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def sites(spark):
    columns = ["CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "AC", "AN", "AF", "CSQ", "ANN"]
    return spark.createDataFrame([("chr1", "1", "A", "T", "1", "PASS", "1", "2", "0.1", "T|a|b", "T|x")], columns)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.createDataFrame(
        [("chr1", 1, "A", "T", "chr1:1:A:T", "g", "t1", "missense_variant", 5, 0.1, "z")],
        "chrom string, pos long, ref string, alt string, id string, region string, feature string, "
        "consequence string, dist_to_tss long, af double, other string").write.parquet(path)
    return spark.read.parquet(path)


def test_conversion_has_no_shuffle_and_splits_each_entry_once(sites):
    long = v.convert_annotations(sites, ["allele", "consequence", "gene"], max_af=0.5, with_ann=False)
    text = plan(long)
    assert "Exchange" not in text and "Python" not in text
    assert text.count("lambdafunction(split(") == 1
    # The site filter runs below the expansion.
    assert optimized(long).rindex("Filter") > optimized(long).index("Generate")


def test_filters_and_columns_reach_the_scan(table):
    text = plan(v.query_filter(table, "pos > 5").select("id"))
    assert "PushedFilters: [IsNotNull(pos), GreaterThan(pos,5)]" in text
    assert "ReadSchema: struct<pos:bigint,id:string>" in text


def test_keep_first_limits_groups_before_the_shuffle(table):
    text = plan(v.keep_first(table, ["id", "feature"], [F.asc_nulls_last("dist_to_tss")]))
    assert text.index("Exchange hashpartitioning") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_distinct_merges_copies_before_the_shuffle(table):
    text = plan(v.distinct_rows(table))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_unique_rows_are_not_shuffled(table):
    assert "Exchange" not in plan(v.distinct_rows(table, rare_copies=True))
    assert "Exchange" not in plan(v.keep_first(table, ["id", "feature"], [F.asc("dist_to_tss")], rare_copies=True))


def test_row_features_do_not_shuffle(table):
    df = v.one_hot(table, "consequence", "&", ["missense_variant"])
    df = v.with_maf_cohort(v.length_flags(v.with_region(df.withColumn("gene", F.col("region")))))
    assert "Exchange" not in plan(df)


def test_two_score_merges_share_the_shuffle_of_the_wide_table(spark, table):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = table.select(*VARIANT_KEY, F.lit(1.0).alias("s"))
        two = table.select(*VARIANT_KEY, "region", F.lit(2.0).alias("u"))
        merged = v.merge_scores(table, one, VARIANT_KEY)
        merged = v.merge_scores(merged, two, [*VARIANT_KEY, "region"])
        assert plan(merged).count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookups_read_only_what_they_need(table):
    genes = v.filter_genes(table.withColumnRenamed("region", "gene"), table.select(F.col("region").alias("gene")))
    assert "BroadcastHashJoin" in plan(genes) and "LeftSemi" in plan(genes)


def test_bucketed_merges_exchange_nothing(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('chr', id % 5) as chrom", "id % 700 as pos", "'A' as ref", "'T' as alt", "concat('g', id % 3) as region", "id as own")
    left = v.store_bucketed(rows, "plans_left", VARIANT_KEY, 4, str(tmp_path / "left"))
    one = v.store_bucketed(rows.groupBy(*VARIANT_KEY).agg(F.max("own").alias("score")), "plans_one", VARIANT_KEY, 4, str(tmp_path / "one"))
    two = v.store_bucketed(rows.groupBy(*VARIANT_KEY, "region").agg(F.min("own").alias("other")), "plans_two", VARIANT_KEY, 4, str(tmp_path / "two"))
    merged = v.merge_bucketed(v.merge_bucketed(left, one, VARIANT_KEY), two, [*VARIANT_KEY, "region"])
    text = plan(merged)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2 and "Bucketed: true" in text
    wanted = rows.join(one, VARIANT_KEY, "left").join(two, [*VARIANT_KEY, "region"], "left").select(*merged.columns)
    assert merged.exceptAll(wanted).count() == 0 and merged.count() == 3000
    with pytest.raises(ValueError, match="already present"):
        v.merge_bucketed(left, two.withColumnRenamed("other", "own"), [*VARIANT_KEY, "region"])
    with pytest.raises(ValueError, match="not a bucketed"):
        v.merge_bucketed(left, rows, VARIANT_KEY)
    other = v.store_bucketed(rows.select(*VARIANT_KEY, F.col("own").alias("x")), "plans_other", VARIANT_KEY, 8, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="buckets differ"):
        v.merge_bucketed(left, other, VARIANT_KEY)


def test_watched_counts_need_no_scan_of_their_own(spark, table, tmp_path):
    from varloom.operators.coverage import WatchedGap
    from varloom.operators.validate import NullKeyError, WatchedKeys

    raw = spark.createDataFrame([("A,T", "x"), ("A", None), ("A", "."), ("A", "y")], "ALT string, CSQ string")
    raw.write.parquet(str(tmp_path / "raw"))
    gap, keys = WatchedGap(), WatchedKeys(["ALT", "CSQ"])
    passing = keys.watch(gap.watch(spark.read.parquet(str(tmp_path / "raw"))))
    assert plan(passing).count("FileScan") == 1 and plan(passing).count("CollectMetrics") == 2
    passing.write.parquet(str(tmp_path / "out"))
    assert gap.counts() == {"n_sites": 4, "n_unannotated": 2, "n_multiallelic": 1}
    with pytest.raises(NullKeyError, match="'CSQ': 1"):
        keys.check()
