"""Results that must not depend on sizes, run history or start-up."""

import os
import subprocess
import sys
import zipfile

import pytest

from vcf_cases import rows, vcf_text, write_vcf
from varloom import convert_release, join_variants, lookup_join, read_published, staging
from varloom.functions.text import to_number
from varloom.operators.joins import measured_bytes
from varloom.sources.bgzf import read_bgzf_lines, write_bgzf
from varloom.sources.vcf import discover_files, input_location
from varloom.staging import staging_scope
from pyspark.sql import functions as F

RECORD = "chr1\t{}\t.\tA\tG\t9\tPASS\tAC=1;AN=9;AF=0.01;CSQ=G|missense|G1|c.1|0.1;ANN=G|x|HIGH|N"


@pytest.mark.parametrize("split", [40, 1 << 20])
@pytest.mark.parametrize("text", [b"a\r\nb\rc\n\nd\xff\n", b"a\nb", b"one\r\n\r\ntwo\r", b"\n\n", b"x\r\n" * 50])
def test_both_readers_cut_lines_alike(spark, tmp_path, text, split):
    from varloom.sources.bgzf import as_member

    (tmp_path / "s-1" / "t-1").mkdir(parents=True)
    path = tmp_path / "s-1" / "t-1" / "f.vcf.gz"
    path.write_bytes(b"".join(as_member(text[i:i + 7]) for i in [*range(0, len(text), 7), len(text)]))
    files = discover_files(spark, str(path))
    lines = read_bgzf_lines(files, split).select(F.hex("value")).collect()
    whole = spark.read.text(str(path)).select(F.hex("value")).collect()
    assert sorted(lines) == sorted(whole)


def test_written_bgzf_is_read_in_ranges(spark, tmp_path):
    df = spark.range(5000).selectExpr("concat('line ', id) AS value")
    write_bgzf(df.coalesce(1), str(tmp_path / "s" / "t"), member=1000).count()
    files = discover_files(spark, f"{tmp_path}/s/t/*.gz")
    assert read_bgzf_lines(files, 3000).select("value").exceptAll(df).count() == 0
    assert read_bgzf_lines(files, 3000).count() == 5000


def test_bgzf_files_are_written_while_rows_come(tmp_path):
    import gzip

    import pandas as pd

    from varloom.sources import bgzf

    def batches():
        for k in range(6):
            yield pd.DataFrame({"value": [f"line {k} {i}" for i in range(500)], "folder": f"f{k // 2}"})
            # The files of earlier folders are whole, whatever is still to come.
            assert len(list(tmp_path.glob("*/*.vcf.gz"))) == k // 2

    paths = [p for frame in bgzf._write_files(batches(), str(tmp_path), 1000) for p in frame["path"]]
    texts = [gzip.open(p, "rt").read().splitlines() for p in paths]
    assert texts == [[f"line {k} {i}" for k in (2 * f, 2 * f + 1) for i in range(500)] for f in range(3)]
    assert sorted(str(p) for p in tmp_path.glob("*/*")) == sorted(paths)


@pytest.mark.parametrize("max_bytes", [0, 1 << 27])
def test_lookup_join_accepts_the_same_whatever_the_size(spark, max_bytes):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    with pytest.raises(TypeError):
        lookup_join(left, spark.createDataFrame([(1, 5)], "k bigint, y int"), ["k"], max_bytes=max_bytes)
    with pytest.raises(ValueError):
        lookup_join(left, spark.createDataFrame([(1, 5)], "k int, y int"), ["k"], "full", max_bytes)
    good = lookup_join(left, spark.createDataFrame([(1, 5)], "k int, y int"), ["k"], max_bytes=max_bytes)
    assert rows(good) == [(1, "a", 5), (2, "b", None)]


def test_nested_and_binary_cells_are_measured(spark):
    wide = spark.range(10).select(F.array_repeat(F.lit("x" * 1000), 100).alias("a"), F.lit(b"y" * 5000).alias("b"),
                                  F.create_map(F.lit("k"), F.lit("z" * 300)).alias("m"))
    assert measured_bytes(wide) > 10 * (100_000 + 5_000 + 300)


def test_a_number_does_not_end_in_a_line_break(spark):
    df = spark.createDataFrame([("12\n",), ("12",), ("1.5\r",)], "x string")
    found = df.select(to_number(F.col("x"), "int").alias("i"), to_number(F.col("x"), "double").alias("d")).collect()
    assert [tuple(r) for r in found] == [(None, None), (12, 12.0), (None, None)]


def release(root, subshard, *positions):
    write_vcf(root / "vcf", "shard-1", subshard, vcf_text([RECORD.format(p) for p in positions]))


def schema_lines(spark, out):
    return [r.value for r in spark.read.text(f"{out}/pipeline_info/schema.tsv").collect()]


def test_a_rerun_leaves_the_release_alone(spark, tmp_path):
    release(tmp_path, "subshard-1", 10, 20)
    out = str(tmp_path / "out")
    convert_release(spark, str(tmp_path / "vcf"), out)
    before = schema_lines(spark, out)
    assert len(before) == 15
    groups = convert_release(spark, str(tmp_path / "vcf"), out)
    assert schema_lines(spark, out) == before and groups.count() == 1
    release(tmp_path, "subshard-2", 30)
    convert_release(spark, str(tmp_path / "vcf"), out)
    assert rows(read_published(spark, out).select("POS").distinct()) == [(10,), (20,), (30,)]
    lists = spark.read.text(f"{out}/pipeline_info/columns")
    assert lists.where("subshard = 'subshard-2'").count() == len(before) and lists.where("value = 'hgvsc'").count() == 2


def test_a_run_with_other_options_is_refused(spark, tmp_path):
    release(tmp_path, "subshard-1", 10)
    out = str(tmp_path / "out")
    convert_release(spark, str(tmp_path / "vcf"), out)
    release(tmp_path, "subshard-2", 30)
    for other in ({"with_ann": False}, {"max_af": 0.5}, {"region": "chr1:1-5"}):
        with pytest.raises(ValueError, match="differ"):
            convert_release(spark, str(tmp_path / "vcf"), out, **other)
    assert read_published(spark, out).select("POS").distinct().count() == 1


def test_a_mended_mismatch_leaves_no_variants_file(spark, tmp_path):
    from varloom import SchemaMismatch

    release(tmp_path, "subshard-1", 10)
    bad = write_vcf(tmp_path / "vcf", "shard-1", "subshard-2", vcf_text([RECORD.format(30)], "Allele|Other"))
    out = tmp_path / "out"
    with pytest.raises(SchemaMismatch):
        convert_release(spark, str(tmp_path / "vcf"), str(out))
    assert (out / "pipeline_info/schema_variants.tsv").exists()
    bad.unlink()
    release(tmp_path, "subshard-2", 30)
    convert_release(spark, str(tmp_path / "vcf"), str(out))
    assert not (out / "pipeline_info/schema_variants.tsv").exists()


def test_right_and_outer_joins_split_heavy_keys(spark, monkeypatch):
    from varloom.operators import joins

    monkeypatch.setattr(joins, "MIN_HEAVY_ROWS", 50)
    key = "'chr1' AS CHROM, if(id < 300, 1, id) AS POS, 'A' AS REF, 'G' AS ALT"
    left = spark.range(400).selectExpr(*[x for x in key.split(", ", 1)][:1], *key.split(", ", 1)[1].rsplit(", ", 2)[:1],
                                       "'A' AS REF", "'G' AS ALT", "id AS l")
    right = spark.range(350, 450).selectExpr("'chr1' AS CHROM", "if(id < 360, 1, id) AS POS", "'A' AS REF", "'G' AS ALT", "id AS r")
    for how in ("right", "outer"):
        wanted = left.join(right, ["CHROM", "POS", "REF", "ALT"], how)
        assert rows(join_variants(left, right, how)) == rows(wanted)


@pytest.mark.parametrize("path,wanted", [
    ("/a/b", ("/a/b", True)), ("file:/a/b", ("/a/b", True)), ("file:///a/b", ("/a/b", True)), ("s3a://bucket/k", ("s3://bucket/k", True)),
    ("s3n://bucket/k", ("s3://bucket/k", True)), ("hdfs://host:8020/x", ("hdfs://host:8020/x", True)), ("dbfs:/x", ("dbfs:/x", False)),
    ("wasbs://c@acct/x", ("wasbs://c@acct/x", False)),
])
def test_locations_as_clusters_write_them(path, wanted):
    assert input_location(path) == wanted


def test_a_scope_removes_what_was_staged_in_it(spark, checkpoint_dir):
    before = set(checkpoint_dir.glob("staged-*"))
    with staging_scope(spark):
        staging.staged(spark.range(3))
        assert len(set(checkpoint_dir.glob("staged-*")) - before) == 1
    assert set(checkpoint_dir.glob("staged-*")) == before


def test_the_package_runs_from_a_zip(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = tmp_path / "varloom.zip"
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "varloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    script = os.path.join(root, "run_varloom.py")
    copied = tmp_path / "run_varloom.py"
    copied.write_text(open(script).read())
    done = subprocess.run([sys.executable, str(copied), "--help"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(target)},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "list-fields" in done.stdout


def test_published_files_follow_the_coordinates(spark, tmp_path):
    """One file read in many ranges: names, bounds in the footers and rows are in order, and a filter on POS passes over files."""
    import glob

    import pyarrow.parquet as pq

    from varloom.sources.bgzf import as_member

    text = vcf_text([f"chr1\t{pos}\t.\tA\tG\t9\tPASS\tAC=1;CSQ=G|x|g|h|0" for pos in range(1000, 5000)]).encode()
    folder = tmp_path / "vcf" / "shard-1" / "subshard-1"
    folder.mkdir(parents=True)
    (folder / "a.annotated.vcf.gz").write_bytes(b"".join(as_member(text[i:i + 3000]) for i in range(0, len(text), 3000)) + as_member(b""))
    convert_release(spark, str(tmp_path / "vcf"), str(tmp_path / "out"), with_ann=False, split_bytes=4000, rows_per_file=150)
    files = sorted(glob.glob(str(tmp_path / "out" / "annotations" / "*" / "*" / "*" / "*.parquet")))
    bounds, rows_of = [], []
    for file in files:
        own = pq.read_table(file)["POS"].to_pylist()
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("POS")
        stats = [meta.row_group(k).column(column).statistics for k in range(meta.num_row_groups)]
        bounds.append((min(s.min for s in stats), max(s.max for s in stats)))
        assert bounds[-1] == (own[0], own[-1]) and own == sorted(own) and len(own) <= 150
        rows_of += own
    assert rows_of == list(range(1000, 5000)) and len(files) >= 27
    assert sum(low <= 2010 and high >= 2000 for low, high in bounds) <= 2
    found = read_published(spark, str(tmp_path / "out")).where("POS between 2000 and 2010")
    assert found.count() == 11 and "PushedFilters: [IsNotNull(POS), GreaterThanOrEqual(POS,2000), LessThanOrEqual(POS,2010)]" in \
        found._jdf.queryExecution().executedPlan().toString()
