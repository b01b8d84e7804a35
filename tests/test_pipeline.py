"""The build from VCF files to the filled feature table, through every stage."""

import random

import pytest

from vcf_cases import rows, vcf_text, write_vcf
from varloom import FeatureConfig, convert_release, run_pipeline, staging
from varloom.__main__ import main

SUBFIELDS = ("Allele|Consequence|Gene|Feature|BIOTYPE|STRAND|CDS_position|Amino_acids|LoF|SpliceAI_pred|"
             "Protein_position|AF")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    write_vcf(root / "vcf", "shard-1", "subshard-1", vcf_text([
        # A start-lost SNV on two transcripts of one gene, one of them twice.
        "chr1\t201\t.\tA\tG\t9\tPASS\tAC=1;AN=9;AF=0.01;CSQ="
        "G|start_lost|ENSG1|T1|protein_coding|1|1/30|M/V|HC|S&0.1&0.7&.&0&1||,"
        "G|start_lost&splice_region_variant|ENSG1|T2|protein_coding|1|1/30|M/V||||,"
        "G|start_lost|ENSG1|T1|protein_coding|1|1/30|M/V|HC|S&0.1&0.7&.&0&1||",
        "chr1\t301\t.\tA\tGT\t9\tPASS\tAC=1;AN=9;CSQ=G|missense_variant|ENSG1|T1|lncRNA|1|10-12/40|A/R|LC||5/9|",
    ], SUBFIELDS))
    write_vcf(root / "vcf", "shard-1", "subshard-2", vcf_text([
        "chr2\t50\t.\tC\tT\t.\tPASS\tAC=2;AN=9;AF=0.2;CSQ=T|intron_variant|ENSG2|T9|protein_coding|-1||||||0.3",
        "chr2\t60\t.\tC\tT\t.\tPASS\tAC=2;AN=9;AF=0.2;CSQ=T|intron_variant|ENSG3|T8|protein_coding|-1||||||",
    ], SUBFIELDS))
    random.seed(1)
    base = "".join(random.choices("CG", k=200))
    chr1 = base + "ATG" + "C" * 6 + "ATG" + "C" * 300            # position 201 starts at offset 200
    (root / "genome.fa").write_text(f">chr1\n{chr1}\n>chr2\n{'ACGT' * 100}\n")
    (root / "genes.gtf").write_text("".join(
        f'{c}\tX\tgene\t{s}\t{e}\t.\t{d}\t.\tgene_id "{g}.1"; gene_type "protein_coding";\n'
        for c, s, e, d, g in [("chr1", 101, 400, "+", "ENSG1"), ("chr2", 10, 90, "-", "ENSG2")]))
    (root / "matrix.sij").write_text("A R M V\n4\n-1 5\n-1 -2 6\n0 -3 1 4\n")
    spark.createDataFrame([("ENSG1",), ("ENSG2",)], "gene_id string").write.parquet(str(root / "genes"))
    spark.createDataFrame([("1", 201, "A", "G", -2.5), ("2", 50, "C", "A", 1.0)],
                          "chrom string, pos int, ref string, alt string, gpn_score double") \
        .write.parquet(str(root / "conservation"))
    spark.createDataFrame([("1", 201, "A", "G", "ENSG1", 20.0), ("1", 201, "A", "G", "ENSG9", 9.0)],
                          ["#Chrom", "Pos", "Ref", "Alt", "GeneID", "PHRED"]).write.parquet(str(root / "scores"))
    return root


def test_from_vcf_to_features(spark, inputs, tmp_path):
    convert_release(spark, str(inputs / "vcf"), str(tmp_path / "long"))
    final = run_pipeline(spark, FeatureConfig(
        outdir=str(tmp_path / "features"), gtf=str(inputs / "genes.gtf"), published=str(tmp_path / "long"),
        substitution_matrix=str(inputs / "matrix.sij"), fasta=str(inputs / "genome.fa"),
        gene_list=str(inputs / "genes"), biotypes=["protein_coding", "lncRNA"], sanity_check=True,
        conservation=str(inputs / "conservation"), deleteriousness=str(inputs / "scores"),
        deleteriousness_columns=["phred"],
        fill={"phred": [0], "gpn_score": [0], "blosum62": [-4], "af": [0]},
        keep=["id", "feature", "af", "phred", "gpn_score", "blosum62", "next_in_frame_relative",
              "relative_cds_position", "spliceai_delta_score", "loftee_hc", "dist_to_tss", "is_insertion"]))
    got = {(r.id, r.feature): r for r in final.collect()}
    assert set(got) == {("chr1:201:A:G", "T1"), ("chr1:201:A:G", "T2"), ("chr1:301:A:GT", "T1"), ("chr2:50:C:T", "T9")}
    first = got["chr1:201:A:G", "T1"]
    assert first.next_in_frame_relative == pytest.approx(9 / 30) and first.phred == 20.0 and first.phred_is_na == 0
    assert (first.gpn_score, first.blosum62, first.loftee_hc, first.dist_to_tss) == (-2.5, 1.0, 1, 101)
    assert first.spliceai_delta_score == pytest.approx(0.7) and first.relative_cds_position == pytest.approx(0.03)
    assert (first.consequence_start_lost, first.consequence_splice_region_variant) == (1, 0)
    assert got["chr1:201:A:G", "T2"].consequence_splice_region_variant == 1
    second = got["chr1:301:A:GT", "T1"]
    assert (second.af, second.af_is_na, second.phred, second.phred_is_na, second.is_insertion) == (0.0, 1, 0.0, 1, 1)
    assert second.relative_cds_position == pytest.approx(0.3) and second.next_in_frame_relative is None
    assert got["chr2:50:C:T", "T9"].dist_to_tss == 40
    assert {t for _, t in final.dtypes} <= {"string", "float", "tinyint", "bigint", "int"}
    meta = spark.read.parquet(str(tmp_path / "features/variant_metadata"))
    assert meta.count() == 4 and meta.columns == ["id", "chrom", "pos", "ref", "alt"]


def test_one_row_per_transcript_with_any_scores(spark, inputs, tmp_path):
    """Repeated rows go whether or not a conservation table is given, and further scores can be asked for."""
    convert_release(spark, str(inputs / "vcf"), str(tmp_path / "long"))
    spark.createDataFrame([("chr1", 201, "A", "G", "N", "ENSG1", -0.5), ("chr1", 201, "A", "G", "N", "ENSG1", 0.2)],
                          "chrom string, pos long, ref string, alt string, gene string, gene_id string, promoterAI double") \
        .write.parquet(str(tmp_path / "promoter"))
    spark.createDataFrame([("chr1:201:A:G", 3)], "id string, mac_cohort int").write.parquet(str(tmp_path / "counts"))
    final = run_pipeline(spark, FeatureConfig(
        outdir=str(tmp_path / "features"), gtf=str(inputs / "genes.gtf"), published=str(tmp_path / "long"),
        deleteriousness=str(inputs / "scores"), deleteriousness_columns=["phred"],
        extra_scores=[{"kind": "promoter", "path": str(tmp_path / "promoter")},
                      {"kind": "cohort_maf", "path": str(tmp_path / "counts"), "n_samples": 10}]))
    found = final.select("id", "feature", "promoterai", "maf_cohort").collect()
    assert len({(r.id, r.feature) for r in found}) == len(found) == 5
    assert {(r.feature, r.promoterai, r.maf_cohort) for r in found if r.id == "chr1:201:A:G"} == {("T1", -0.5, 0.15), ("T2", -0.5, 0.15)}


def test_command_line(spark, inputs, tmp_path, capsys):
    main(["convert", "--annotation-root", str(inputs / "vcf"), "--outdir", str(tmp_path / "out"),
          "--max-af", "0.1", "--packed-ann", "--region", "chr1:1-250"])
    table = spark.read.parquet(str(tmp_path / "out/annotations"))
    assert rows(table.select("POS").distinct()) == [(201,)] and "ANN" in table.columns and "rank" not in table.columns
    main(["list-fields", str(inputs / "vcf/shard-1/subshard-1/*.gz")])
    assert capsys.readouterr().out.split()[-2:] == ["protein_position", "af_2"]


def test_staging_uses_the_configured_folder(spark, checkpoint_dir):
    before = set(checkpoint_dir.glob("staged-*"))
    assert staging.staged(spark.range(3)).count() == 3
    assert len(set(checkpoint_dir.glob("staged-*")) - before) == 1


def test_staging_needs_a_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(Cluster)
    Cluster.sparkContext.master = "local[2]"
    assert staging.staging_root(Cluster) == staging.staging_root(Cluster)
