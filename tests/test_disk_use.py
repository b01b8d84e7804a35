"""What builds leave on disk while they run: shuffle files, and exchanges and copies of the wide table."""

import os
import time

import pytest
from pyspark.sql import functions as F

import varloom as v
from test_incremental import config, publish, references  # noqa: F401
from varloom import run_pipeline
from varloom.functions.keys import VARIANT_KEY
from varloom.operators import joins
from varloom.operators.scores import first_per_transcript
from varloom.plans import incremental
from varloom.sources.sinks import write_table
from varloom.staging import staged
from vcf_cases import rows

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    roots = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for root in roots for _, _, names in os.walk(root) for name in names if name.startswith("shuffle_")}


def test_staged_tables_leave_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    found = staged(spark.range(5000).repartition(4, "id"))
    write_table(spark.range(5000).repartition(4, "id"), str(tmp_path / "stage"))
    joins.heavy_keys(spark.range(20_000).repartition(4, "id"), ["id"])
    # Files go shortly after the action.
    until = time.time() + 30
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert found.count() == spark.read.parquet(str(tmp_path / "stage")).count() == 5000 and spark.conf.get(CLEANUP) == setting


@pytest.fixture(scope="module")
def annotations(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("disk") / "t")
    spark.range(400).selectExpr(
        "concat('chr', id % 3) AS chrom", "id % 70 AS pos", "'A' AS ref", "'T' AS alt", "0.5D AS af",
        "if(id % 5 < 2, null, concat('g', id % 11)) AS gene", "concat('t', id % 6) AS feature", "'lncRNA' AS biotype", "'1' AS strand",
        "'3/30' AS cds_position", "'missense_variant' AS consequence", "'HC' AS lof").write.parquet(path)
    return spark.read.parquet(path)


def test_genes_too_many_to_broadcast_cost_one_exchange_of_the_wide_table(spark, annotations, monkeypatch):
    genes = spark.range(9).select(F.concat(F.lit("g"), "id").alias("gene"))
    tss = spark.range(9).selectExpr("concat('g', id) AS region", "id AS tss", "'+' AS strand_right", "id * 3 AS gene_length")

    def build():
        return v.process_vep(annotations, tss, genes=genes, biotypes=["lncRNA"], consequence_sep="&", vocabulary=["missense_variant"])

    wanted, counted = rows(build()), []
    monkeypatch.setattr(joins, "is_broadcastable", lambda df, max_bytes: False)
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 100)
    monkeypatch.setattr(joins, "heavy_keys", lambda df, on, find=joins.heavy_keys: counted.append(df) or find(df, on))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = build()
        text = plan(found)
        # The wide table by gene, the genes, their starts; the distinct and the second join need none.
        assert text.count("Exchange") == 3 and text.count("SortMergeJoin") == 2
        assert not [df.columns for df in counted if "Exchange" in plan(df) or "lof" in df.columns and "Aggregate" in plan(df)]
        assert rows(found) == wanted and len(wanted) > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_semi_join_of_null_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 10)
    left = spark.createDataFrame([(None if n % 2 else n % 7, n) for n in range(300)], "k long, n int")
    right = spark.createDataFrame([(2,), (3,), (None,)], "k long")
    found = joins.balanced_membership(left, right, ["k"])
    assert rows(found) == rows(left.where("k in (2, 3)"))
    assert joins.balanced_membership(left, right, ["k"], "left_anti").count() == 300 - found.count()


def test_counting_another_table_changes_no_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 10)
    left = spark.createDataFrame([(None if n % 9 == 0 else n % 3 * (n % 2), n) for n in range(300)], "k long, n int")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "d")], "k long, s string")
    wanted = rows(left.join(right, ["k"], "left").select("k", "n", "s"))
    for counted in (left, left.select("k").limit(0), left.selectExpr("k + 1 AS k"), left.dropna()):
        assert rows(joins.balanced_join(left, right, ["k"], counted=counted)) == wanted


def test_first_rows_of_keys_that_occur_once_are_not_shuffled(spark, annotations):
    table = staged(v.add_variant_id(annotations, "id").withColumn("dist_to_tss", F.col("pos") - 30).dropDuplicates(["id", "feature"]))
    assert "Exchange" not in plan(first_per_transcript(table)) and rows(first_per_transcript(table)) == rows(table)
    twice = staged(table.unionByName(table.where("pos < 9").withColumn("dist_to_tss", F.lit(-50).cast("long"))))
    wanted = v.keep_first(twice, ["id", "feature"], [F.asc_nulls_last("dist_to_tss")])
    assert rows(first_per_transcript(twice)) == rows(wanted) and wanted.where("dist_to_tss = -50").count() > 0


def test_later_runs_compare_fingerprints_before_they_move_rows(spark, references, tmp_path, monkeypatch):  # noqa: F811
    stored = []
    monkeypatch.setattr(incremental, "staged", lambda df, keep=staged: stored.append(df) or keep(df))
    step = config(references, tmp_path, "stepwise", incremental=True)
    for number in range(2):
        stored.clear()
        publish(spark, tmp_path, number)
        found = run_pipeline(spark, step)
        # Rows with a copy are few: left out by a broadcast, not by an exchange of all.
        wide = [df for df in stored if "_row_a" in df.columns and len(df.columns) > 2]
        assert len(wide) == number and not any("Exchange hashpartitioning" in plan(df) for df in wide)
        assert "gpn_score" not in {c for df in stored if "feature" in df.columns for c in df.columns}
    assert rows(found) == rows(run_pipeline(spark, config(references, tmp_path, "whole")).select(*found.columns))
    assert set(VARIANT_KEY) <= set(spark.read.parquet(f"{step.outdir}/first_rows").columns)


def test_stages_that_others_read_are_zstd(spark, references, tmp_path):  # noqa: F811
    publish(spark, tmp_path, 0)
    step = config(references, tmp_path, "features")
    run_pipeline(spark, step)
    stages = ("vep_processed", "first_rows", "conservation", "pre_deleteriousness")
    assert {name: {f.name.split(".")[-2] for f in (tmp_path / "features" / name).glob("part-*")} for name in (*stages, "final")} == {
        **dict.fromkeys(stages, {"zstd"}), "final": {"snappy"}}
