"""Readers, writers and the file-level plans, on small hand-written files."""

import gzip

import pytest
from pyspark.sql import functions as F

from vcf_cases import rows, vcf_text, write_vcf
from varloom import (
    SchemaMismatch, concat_annotations, convert_annotations, convert_release, discover_files, list_fields,
    read_all_string_tsv, read_fasta_chunks, read_field_names, read_gene_list, read_gtf, read_published, read_sites,
    read_substitution_matrix, tss_table, write_annotations,
)
from varloom.functions.names import table_columns
from varloom.sources.sinks import write_column_list
from varloom.sources.vcf import subfield_names, vcf_glob

RECORDS = [
    "chr1\t100\trs1\tA\tG\t50.5\tPASS\tAC=3;AN=10;AF=0.3;CSQ=G|missense_variant|ENSG1|c.1A>\"G|0.01,G||||;ANN=G|x|LOW|N1,G|y|HIGH",
    "chr1\t200\t.\tC\t*\t.\tPASS\tAC=1;AN=10;AF=0.1;CSQ=*|missense_variant|ENSG1||",
    "chr1\t300\t.\tC\tT,*\t.\tPASS\tAC=1,1;AN=10;AF=0.1,0.1;CSQ=T|stop_gained|ENSG1||",
    "chr2\t400\t.\tG\tT\t.\tLowQual\tAC=.;AN=10;CSQ=T|stop_gained|ENSG2|c.2G>T|.",
    "chrUn_1\t500\t.\tG\tC\t9\tPASS\tMLEAC=4;AF=0.2,0.001;CSQ=C|intron_variant|ENSG3\tGT\t0/1\t1/1",
    "chr3\t600\t.\tG\tC\t9\tPASS\tAC=2;AN=10;AF=0.2",
]


@pytest.fixture(scope="module")
def release(tmp_path_factory):
    root = tmp_path_factory.mktemp("release")
    write_vcf(root, "shard-1", "subshard-1", vcf_text(RECORDS))
    write_vcf(root, "shard-1", "subshard-2", vcf_text(["chr5\t7\t.\tT\tC\t1\tPASS\tAC=1;AN=2;AF=0.9;CSQ=C|a|b|c|d"]), 3)
    write_vcf(root, "shard-2", "subshard-1", vcf_text(["chr6\t7\t.\tT\t*\t1\tPASS\tCSQ=*|a|b|c|d"]))
    return root


def test_discovery(spark, release):
    found = discover_files(spark, vcf_glob(str(release)))
    assert rows(found.select("shard", "subshard")) == [
        ("shard-1", "subshard-1"), ("shard-1", "subshard-2"), ("shard-2", "subshard-1")]
    assert discover_files(spark, vcf_glob(str(release), subshards="subshard-2")).count() == 1
    with pytest.raises(FileNotFoundError):
        discover_files(spark, vcf_glob(str(release), shards="shard-9"))


def test_headers(spark, release):
    fields = read_field_names(discover_files(spark, vcf_glob(str(release))), "CSQ")
    first = fields.where("shard = 'shard-1' and subshard = 'subshard-1'").orderBy("position")
    assert [r.name for r in first.collect()] == ["allele", "consequence", "gene", "hgvsc", "af_2"]
    assert fields.count() == 15
    path = vcf_glob(str(release), "shard-1", "subshard-1")
    listed = [r.name for r in list_fields(spark, path).orderBy("position").collect()]
    assert listed == table_columns(["allele", "consequence", "gene", "hgvsc", "af_2"])
    ann = [r.name for r in list_fields(spark, path, "ANN").orderBy("position").collect()]
    assert ann[-5:] == ["CSQ", "allele", "annotation", "annotation_impact", "gene_name"]
    with pytest.raises(ValueError, match="no BCSQ"):
        list_fields(spark, path, "BCSQ")


def test_subfield_listings():
    assert subfield_names("VEP. Format: A|B c|D") == ["A", "B c", "D"]
    assert subfield_names("Functional annotations: 'A | B | C'") == ["A", "B", "C"]
    assert subfield_names("nothing listed") == []


def test_sites_and_conversion(spark, release):
    sites = read_sites(spark, vcf_glob(str(release)))
    assert sites.count() == 8
    one = sites.where("POS = '500'").first()
    assert (one.CHROM, one.AC, one.AN, one.AF, one.ANN, one.shard, one.subshard) == (
        "chrUn_1", None, None, "0.2,0.001", None, "shard-1", "subshard-1")
    names = ["allele", "consequence", "gene", "hgvsc", "af_2"]
    long = convert_annotations(sites, names)
    assert long.columns[:17] == [
        "CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "AC", "AN", "AF", "ANN", *names, "ID", "annotation"]
    assert "gene_name" in long.columns and long.columns[-2:] == ["shard", "subshard"]
    # Two CSQ by two ANN entries at 100; '*' alleles, and 600 without CSQ, gone.
    counts = {r.POS: r["count"] for r in long.groupBy("POS").count().collect()}
    assert counts == {100: 4, 400: 1, 500: 1, 7: 1}
    at_100 = long.where("POS = 100 and consequence is not null and annotation = 'x'").first()
    assert (at_100.hgvsc, at_100.af_2, at_100.AF, at_100.QUAL, at_100.ID, at_100.gene_name) == (
        'c.1A>"G', "0.01", 0.3, 50.5, "chr1:100:A:G", "N1")
    off_list = long.where("POS = 500").first()
    assert (off_list.CHROM, off_list.ID, off_list.AF, off_list.hgvsc) == (None, None, None, None)
    packed = convert_annotations(sites, names, with_ann=False)
    assert packed.count() == 5 and "annotation" not in packed.columns
    swapped = convert_annotations(sites, ["allele", "annotation", "impact", "gene_name"], field="ANN")
    assert swapped.count() == 2 and swapped.columns[9] == "CSQ"


def test_site_limits(spark, release):
    sites = read_sites(spark, vcf_glob(str(release)))
    names = ["allele"]
    kept = convert_annotations(sites, names, max_af=0.19, with_ann=False)
    assert rows(kept.select("POS").distinct()) == [(400,)]        # no AF: kept
    assert convert_annotations(sites, names, max_ac=0, with_ann=False).select("POS").distinct().count() == 2
    assert rows(convert_annotations(sites, names, region="chr1:50-100", with_ann=False).select("POS").distinct()) == [(100,)]
    assert convert_annotations(sites, names, region=["chr5", "chr2:400"], with_ann=False).count() == 2
    with pytest.raises(ValueError, match="not a region"):
        convert_annotations(sites, names, region="chr1:x-y")


def test_release_is_published_and_resumed(spark, release, tmp_path):
    out = str(tmp_path / "out")
    groups = convert_release(spark, str(release), out, shards="shard-1", subshards="subshard-1")
    assert groups.count() == 1
    assert {r[0] for r in read_published(spark, out).select("subshard").distinct().collect()} == {"subshard-1"}
    convert_release(spark, str(release), out)
    published = read_published(spark, out)
    assert published.groupBy("shard", "subshard").count().count() == 2     # shard-2 has no surviving record
    before = published.count()
    convert_release(spark, str(release), out)                              # nothing new
    assert read_published(spark, out).count() == before == 7
    schema = spark.read.csv(f"{out}/pipeline_info/schema_hashes.tsv", sep="\t")
    assert schema.count() == 3 and schema.select("_c0").distinct().count() == 1
    log = [r.value for r in spark.read.text(f"{out}/pipeline_info/schema_check.log").collect()]
    assert log == ["3 files checked", "1 different column lists", "15 columns in the list that counts"]


def test_release_with_differing_headers_is_refused(spark, tmp_path):
    root = tmp_path / "bad"
    record = ["chr1\t1\t.\tA\tG\t1\tPASS\tCSQ=G|a|b|c|d"]
    for i in range(3):
        write_vcf(root, "shard-1", f"subshard-{i}", vcf_text(record))
    write_vcf(root, "shard-1", "subshard-9", vcf_text(record, "Allele|Consequence|Gene|HGVSc|AF|Extra"))
    with pytest.raises(SchemaMismatch, match="1 files with 16 columns, e.g. shard-1/subshard-9"):
        convert_release(spark, str(root), str(tmp_path / "out"))
    variants = spark.read.csv(str(tmp_path / "out/pipeline_info/schema_variants.tsv"), sep="\t").collect()
    assert [(r._c1, r._c2, r._c3) for r in variants] == [
        ("3", "15", "shard-1/subshard-0"), ("1", "16", "shard-1/subshard-9")]
    write_vcf(root, "shard-1", "subshard-9", "##fileformat=VCFv4.2\n#CHROM\tPOS\n")
    with pytest.raises(ValueError, match="no CSQ subfields"):
        convert_release(spark, str(root), str(tmp_path / "out2"))


def test_empty_output_keeps_the_schema(spark, release, tmp_path):
    sites = read_sites(spark, vcf_glob(str(release), "shard-2"))
    empty = convert_annotations(sites, ["allele", "consequence"])
    write_annotations(empty, str(tmp_path / "empty"))
    back = spark.read.parquet(str(tmp_path / "empty"))
    full = convert_annotations(read_sites(spark, vcf_glob(str(release))), ["allele", "consequence"])
    assert back.count() == 0 and back.dtypes == full.dtypes


def test_concat_checks_schemas(spark, tmp_path):
    frame = spark.createDataFrame([("chr1", 1, "x")], "CHROM string, POS long, allele string")
    for root in ("a", "b"):
        for sub in (1, 2):
            frame.toPandas().to_parquet(_made(tmp_path / root / "shard-1" / f"subshard-{sub}") / "annotations.parquet")
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    assert concat_annotations(spark, roots).count() == 4
    write_annotations(frame.withColumn("extra", F.lit(1)), str(tmp_path / "b/shard-2/subshard-7/annotations.parquet"))
    with pytest.raises(SchemaMismatch, match="shard-2/subshard-7"):
        concat_annotations(spark, roots)
    with pytest.raises(FileNotFoundError):
        concat_annotations(spark, [str(tmp_path / "none")])


def _made(folder):
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def test_text_tsv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('a\t.\t"x\n\t-\ty"\tz\n')
    got = read_all_string_tsv(spark, str(tmp_path / "t.tsv"), ["p", "q", "r"])
    assert rows(got) == [("a", None, '"x'), (None, "-", 'y"')]


def test_gene_list(spark, tmp_path):
    spark.createDataFrame([("g1",), ("g1",), ("g2",)], "region string").write.parquet(str(tmp_path / "g"))
    assert rows(read_gene_list(spark, str(tmp_path / "g"))) == [("g1",), ("g2",)]
    spark.createDataFrame([("g1",)], "other string").write.parquet(str(tmp_path / "h"))
    with pytest.raises(ValueError, match="no gene column"):
        read_gene_list(spark, str(tmp_path / "h"))


def test_column_list(spark, tmp_path):
    write_column_list(["CHROM", "POS"], spark, str(tmp_path / "c"))
    assert [r.value for r in spark.read.text(str(tmp_path / "c")).collect()] == ["CHROM", "POS"]


def test_substitution_matrix(spark, tmp_path):
    (tmp_path / "m.sij").write_text("# comment\n# more\n A  R  N  D\n 4\n-1.5 5\n-2 0  6\n-2 -2 1 6\n")
    got = {(r.ref_aa, r.alt_aa): r.blosum62 for r in read_substitution_matrix(spark, str(tmp_path / "m.sij")).collect()}
    assert len(got) == 16 and got["A", "R"] == got["R", "A"] == -1.5 and got["N", "N"] == 6 and got["R", "D"] == -2
    (tmp_path / "bad.sij").write_text("A R N\n4\n-1 5\n")
    with pytest.raises(ValueError, match="differ in number"):
        read_substitution_matrix(spark, str(tmp_path / "bad.sij"))


def test_gtf_and_tss(spark, tmp_path):
    def line(contig, feature, start, end, strand, gene, kind="protein_coding"):
        return (f'{contig}\tHAVANA\t{feature}\t{start}\t{end}\t.\t{strand}\t.\tgene_id "{gene}"; '
                f'gene_type "{kind}"; havana_gene "OTT"; note "a;b";')
    (tmp_path / "g.gtf").write_text("\n".join([
        "##description: test", line("chrX", "gene", 100, 200, "+", "ENSG1.4"),
        line("chrY", "gene", 90, 190, "+", "ENSG1.4_PAR_Y"), line("chrX", "transcript", 1, 2, "+", "ENSG1.4"),
        line("chr2", "gene", 50, 80, "-", "ENSG2.1"), line("chr2", "gene", 50, 80, "-", "ENSG3.1", "lncRNA")]) + "\n")
    gtf = read_gtf(spark, str(tmp_path / "g.gtf"))
    assert gtf.count() == 5
    assert rows(tss_table(gtf)) == [("ENSG1", 99, "+", 102), ("ENSG2", 80, "-", 32)]


@pytest.mark.parametrize("split, width, chunk, packed", [
    (97, 60, 64, False), (53, 7, 16, False), (500, 10_000, 32, False), (97, 60, 64, True)])
def test_fasta_chunks(spark, tmp_path, split, width, chunk, packed):
    """Contigs spread over many splits, lines shorter and longer than a chunk."""
    import random

    random.seed(split)
    contigs = {f"chr{i}": "".join(random.choices("ACGTacgtN", k=n)) for i, n in enumerate([1000, 1, 640, 333], 1)}
    text = "".join(
        f">{name} some description\n" + "".join(seq[i:i + width] + "\n" for i in range(0, len(seq), width))
        for name, seq in contigs.items())
    path = tmp_path / ("g.fa.gz" if packed else "g.fa")
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_fasta_chunks(spark, str(path), chunk).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = {(name, i // chunk): seq[i:i + chunk] for name, seq in contigs.items() for i in range(0, len(seq), chunk)}
    assert {(r.contig, r.chunk): r.seq for r in got} == expected and len(got) == len(expected)
