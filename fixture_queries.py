"""Every operator on the derived tables, each with a DuckDB statement to check it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import varloom as v
from fixture_tables import CSQ_RAW, fixture, with_tables
from varloom.functions.keys import VARIANT_KEY, contig_rank, with_chr, without_chr
from varloom.functions.names import sanitise_names
from varloom.functions.sequence import next_inframe_atg
from varloom.operators import scores as score_merges
from varloom.operators.expand import cast_fixed, expand_ann, expand_csq, null_tokens
from varloom.sources.bgzf import read_bgzf_lines, write_bgzf
from varloom.operators.start_lost import WINDOW, with_windows
from varloom.staging import short_lived_shuffles, staged, staging_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The column names written out, so that the checks do not take them from the code under test.
CSQ_NAMES = ["allele", "consequence", "gene", "feature", "biotype", "strand", "cds_position", "amino_acids", "lof",
             "spliceai_pred", "af_2"]
_ANN_NAMES = ["allele", "annotation", "annotation_impact", "gene_name", "gene_id", "feature_type", "feature_id",
              "transcript_biotype", "rank", "hgvs_c", "hgvs_p", "cdna_pos_cdna_length", "cds_pos_cds_length",
              "aa_pos_aa_length", "distance", "errors_warnings_info"]
LABELS = ["missense_variant", "splice_region_variant", "start_lost", "synonymous_variant"]
CHUNK = 32


def query(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a query with its check; ``tables`` are the derived tables the SQL names."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_tables(sql, list(tables)) if tables else sql.strip()
        return function

    return register


def _sites(spark: SparkSession, sf_dir: str, source: str = "variants") -> DataFrame:
    """Raw site records in the converter's upper-case columns."""
    df = fixture(spark, sf_dir, source)
    return df.select(*[F.col(c).alias(c.upper()) for c in df.columns if c != "k"])


# ── SQL pieces shared by several checks ────────────────────────────────────

_FIXED = """CASE WHEN chrom NOT LIKE 'chrUn%' THEN chrom END AS CHROM, CAST(pos AS bigint) AS POS, ref AS REF, alt AS ALT,
  TRY_CAST(nullif(qual, '.') AS double) AS QUAL, filter AS FILTER, TRY_CAST(nullif(ac, '.') AS int) AS AC,
  TRY_CAST(an AS int) AS AN, TRY_CAST(nullif(af, '.') AS double) AS AF"""
_FIXED_NAMES = "CHROM, POS, REF, ALT, QUAL, FILTER, AC, AN, AF"
_ID = "CHROM || ':' || CAST(POS AS varchar) || ':' || REF || ':' || ALT AS ID"
_CSQ_FIELDS = ", ".join(f"nullif(p[{i + 1}], '') AS {n}" for i, n in enumerate(CSQ_NAMES))
_ANN_FIELDS = {name: f"nullif(q[{i + 1}], '') AS {name}" for i, name in enumerate(_ANN_NAMES)}
_NO_STAR = "NOT list_contains(string_split(alt, ','), '*')"
_ANN_ENTRIES = "CASE WHEN ANN IS NULL THEN [NULL] ELSE string_split(ANN, ',') END"

_LONG = f"""
SELECT {_FIXED_NAMES}, ANN, {_CSQ_FIELDS}, {_ID} FROM (
  SELECT * EXCLUDE (e), string_split(e, '|') AS p FROM (
    SELECT {_FIXED}, nullif(ann, '.') AS ANN, unnest(string_split(csq, ',')) AS e
    FROM variants WHERE {_NO_STAR} AND csq IS NOT NULL) AS a) AS b"""


# ── Stage one: conversion ──────────────────────────────────────────────────


@query("site_filters", f"""
SELECT k, chrom, pos, ref, alt, ac, af FROM sites
WHERE {_NO_STAR} AND NOT coalesce(len([x for x in string_split(af, ',') if TRY_CAST(x AS double) > 0.05]) > 0, false)
  AND NOT coalesce(len([x for x in string_split(ac, ',') if TRY_CAST(x AS bigint) > 40]) > 0, false)""", ("sites",))
def site_filters(spark, sf_dir):
    sites = fixture(spark, sf_dir, "sites")
    return v.site_filters(sites, max_af=0.05, max_ac=40).select("k", "chrom", "pos", "ref", "alt", "ac", "af")


@query("region_filter", """
SELECT k, chrom, pos, ref, alt FROM sites
WHERE chrom = 'chr1' AND CAST(pos AS bigint) <= 100000 AND CAST(pos AS bigint) + length(ref) - 1 >= 20000""", ("sites",))
def region_filter(spark, sf_dir):
    return v.region_filter(fixture(spark, sf_dir, "sites"), "chr1:20000-100000").select("k", "chrom", "pos", "ref", "alt")


@query("variant_id_and_casts", f"SELECT {_FIXED_NAMES}, {_ID} FROM (SELECT {_FIXED} FROM sites) AS t", ("sites",))
def variant_id_and_casts(spark, sf_dir):
    return v.add_variant_id(cast_fixed(null_tokens(_sites(spark, sf_dir, "sites").drop("ANN"))))


@query("expand_csq", f"SELECT k, {_CSQ_FIELDS} FROM (SELECT k, string_split(e, '|') AS p FROM "
       "(SELECT k, unnest(string_split(csq, ',')) AS e FROM csq_blocks) AS a) AS b", ("csq_blocks",))
def csq_expansion(spark, sf_dir):
    return expand_csq(fixture(spark, sf_dir, "csq_blocks"), CSQ_NAMES, "csq")


@query("expand_ann", f"SELECT k, ANN, {', '.join(_ANN_FIELDS.values())} FROM (SELECT k, ANN, string_split(r, '|') AS q FROM "
       f"(SELECT k, ANN, unnest({_ANN_ENTRIES}) AS r FROM (SELECT k, nullif(ann, '.') AS ANN FROM sites) AS s) AS a) AS b",
       ("sites",))
def ann_expansion(spark, sf_dir):
    sites = fixture(spark, sf_dir, "sites").select("k", F.nullif("ann", F.lit(".")).alias("ANN"))
    return expand_ann(sites)


@query("convert_annotations", _LONG, ("variants",))
def convert_annotations(spark, sf_dir):
    return v.convert_annotations(_sites(spark, sf_dir), CSQ_NAMES, with_ann=False)


@query("convert_annotations_with_ann", f"""
SELECT {_FIXED_NAMES}, ANN, {', '.join(CSQ_NAMES)}, ID,
  {', '.join(t for n, t in _ANN_FIELDS.items() if n not in CSQ_NAMES)}
FROM (SELECT *, string_split(r, '|') AS q FROM (SELECT *, unnest({_ANN_ENTRIES}) AS r FROM ({_LONG}) AS l) AS x) AS y""",
       ("variants",))
def convert_annotations_with_ann(spark, sf_dir):
    return v.convert_annotations(_sites(spark, sf_dir), CSQ_NAMES)


@query("convert_ann_carry_csq", f"""
SELECT {_FIXED_NAMES}, CSQ, nullif(q[1], '') AS allele, nullif(q[2], '') AS annotation,
  nullif(q[3], '') AS annotation_impact, nullif(q[4], '') AS gene_name, {_ID}
FROM (SELECT *, string_split(r, '|') AS q FROM (SELECT {_FIXED}, csq AS CSQ, unnest(string_split(ann, ',')) AS r
  FROM variants WHERE {_NO_STAR} AND ann <> '.' AND NOT coalesce(TRY_CAST(af AS double) > 0.09, false)
    AND NOT (af LIKE '%,%')) AS a) AS b""", ("variants",))
def convert_ann_carry_csq(spark, sf_dir):
    # The multi-allelic sites all have one AF of 0.5, over the limit.
    names = sanitise_names(["Allele", "Annotation", "Annotation_Impact", "Gene_Name"])
    return v.convert_annotations(_sites(spark, sf_dir), names, field="ANN", max_af=0.09)


@query("query_filter", f"SELECT * FROM ({_LONG}) AS l WHERE TRY_CAST(af_2 AS double) < 0.04 AND AF < 0.03", ("variants",))
def query_filter(spark, sf_dir):
    long = v.convert_annotations(_sites(spark, sf_dir), CSQ_NAMES, with_ann=False)
    return v.query_filter(long, "try_cast(af_2 as double) < 0.04 and AF < 0.03")


@query("annotation_gap_counts", """
SELECT count(*) AS n_sites, count(*) FILTER (WHERE csq IS NULL) AS n_unannotated,
  count(*) FILTER (WHERE alt LIKE '%,%') AS n_multiallelic FROM variants""", ("variants",))
def annotation_gap_counts(spark, sf_dir):
    return v.annotation_gap(_sites(spark, sf_dir))


@query("variant_metadata", "SELECT DISTINCT id, chrom, pos, ref, alt FROM long_table", ("long_table",))
def variant_metadata(spark, sf_dir):
    return v.variant_metadata(fixture(spark, sf_dir, "long_table"))


@query("contig_order", """
SELECT chrom, CASE chrom WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrM' THEN 25
  ELSE CAST(substr(chrom, 4) AS int) END AS chrom_order, count(*) AS n FROM typed_sites GROUP BY chrom""", ("typed_sites",))
def contig_order(spark, sf_dir):
    sites = fixture(spark, sf_dir, "typed_sites")
    return sites.groupBy("chrom", contig_rank(F.col("chrom")).alias("chrom_order")).agg(F.count("*").alias("n"))


# ── Readers, on files Spark writes from the tables ─────────────────────────


@query("read_vcf", f"SELECT *, 'filter=' || coalesce(FILTER, '') AS shard, 'an=' || AN AS subshard FROM ({_LONG}) AS l",
       ("variants",))
def read_vcf(spark, sf_dir):
    """The sites as gzipped VCF text in two folder levels, read and converted."""
    sites = _sites(spark, sf_dir)
    tags = [F.when(F.col(t).isNotNull(), F.concat(F.lit(f"{t}="), F.col(t))) for t in ("AC", "AN", "AF", "CSQ", "ANN")]
    record = F.concat_ws("\t", "CHROM", "POS", F.lit("."), "REF", "ALT", "QUAL", "FILTER", F.concat_ws(";", *tags))
    path = staging_path(spark)
    lines = sites.select(record.alias("value"), F.col("FILTER").alias("filter"), F.col("AN").alias("an"))
    lines.write.partitionBy("filter", "an").option("compression", "gzip").text(path)
    read = v.read_sites(spark, f"{path}/*/*/*.gz")
    return v.convert_annotations(read, CSQ_NAMES, with_ann=False)


#: Keys in a subshard, so that there are more of them, not larger ones, as the tables grow.
SUBSHARD_KEYS = 20_000
_FOLDERS = f"'shard-' || CAST(length(ref) AS varchar) AS shard, 'subshard-' || CAST(k // {SUBSHARD_KEYS} AS varchar) AS subshard"


def _records(sites: DataFrame):
    """VCF record lines of raw sites (with their key K), with the columns that name their folder."""
    tags = [F.when(F.col(t).isNotNull(), F.concat(F.lit(f"{t}="), F.col(t))) for t in ("AC", "AN", "AF", "CSQ", "ANN")]
    record = F.concat_ws("\t", "CHROM", "POS", F.lit("."), "REF", "ALT", "QUAL", "FILTER", F.concat_ws(";", *tags))
    shard = F.concat(F.lit("shard-"), F.length("REF"))
    subshard = F.concat(F.lit("subshard-"), F.expr(f"K div {SUBSHARD_KEYS}"))
    return sites.select(record.alias("value"), shard.alias("shard"), subshard.alias("subshard"), "CHROM", F.col("POS").cast("long").alias("POS"))


def _release_files(spark: SparkSession, sf_dir: str) -> str:
    """The sites as bgzipped VCF files with headers, a folder for each shard and subshard."""
    variants = fixture(spark, sf_dir, "variants")
    records = _records(variants.select(*[F.col(c).alias(c.upper()) for c in variants.columns]))
    head = [f'##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequences. Format: {"|".join(CSQ_RAW)}">',
            "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    folders = records.select("shard", "subshard").distinct()
    headers = folders.select(F.posexplode(F.array(*map(F.lit, head))).alias("line", "value"), "shard", "subshard")
    lines = headers.unionByName(records.withColumn("line", F.lit(9)), allowMissingColumns=True)
    path = staging_path(spark)
    # A folder is one file, its header first, then its records in coordinate order.
    ordered = lines.repartition("shard", "subshard").sortWithinPartitions("shard", "subshard", "line", "CHROM", "POS").select("value", "shard", "subshard")
    with short_lived_shuffles(spark):
        write_bgzf(ordered, path, ("shard", "subshard")).count()
    return path


_LONG_K = _LONG.replace("SELECT CHROM,", "SELECT k, CHROM,", 1).replace("SELECT CASE WHEN chrom", "SELECT k, CASE WHEN chrom", 1)
_RELEASE = f"SELECT l.* EXCLUDE (k), {_FOLDERS} FROM ({_LONG_K}) AS l"


@query("read_bgzf", _RELEASE, ("variants",))
def read_bgzf(spark, sf_dir):
    """bgzipped files read in ranges of a few kilobytes."""
    files = v.discover_files(spark, f"{_release_files(spark, sf_dir)}/*/*/*.gz")
    read = v.read_sites(spark, [], lines=read_bgzf_lines(files, 20_000))
    return v.convert_annotations(read, CSQ_NAMES, with_ann=False)


@query("convert_release", _RELEASE, ("variants",))
def convert_release(spark, sf_dir):
    """Two runs of a release, one for each kind of subshard, then the published table."""
    root, out = _release_files(spark, sf_dir), staging_path(spark)
    for subshard in ("subshard-0", "subshard-*"):
        v.convert_release(spark, root, out, subshards=subshard, vcf_name="*.vcf.gz", with_ann=False, split_bytes=20_000)
    return v.read_published(spark, out)


_HEADER_VALUES = ", ".join(f"({i}, '{raw}', '{name}')" for i, (raw, name) in enumerate(zip(CSQ_RAW, CSQ_NAMES)))


@query("read_headers", f"""
SELECT f.shard, f.subshard, CAST(h.position AS int) AS position, h.raw, h.name
FROM (SELECT DISTINCT {_FOLDERS} FROM variants) AS f, (VALUES {_HEADER_VALUES}) AS h(position, raw, name)""", ("variants",))
def read_headers(spark, sf_dir):
    """Discovered files and the subfields that their headers name."""
    files = v.discover_files(spark, f"{_release_files(spark, sf_dir)}/*/*/*.gz")
    return v.read_field_names(files).drop("path")


@query("column_list", f"""
SELECT f.shard, f.subshard, c.name
FROM (SELECT DISTINCT {_FOLDERS} FROM variants) AS f,
  (VALUES {', '.join(f"('{c}')" for c in ["CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "AC", "AN", "AF", "ANN", *CSQ_NAMES])}) AS c(name)""",
       ("variants",))
def column_list(spark, sf_dir):
    """The column list that a release writes for each subshard."""
    root, out = _release_files(spark, sf_dir), staging_path(spark)
    v.convert_release(spark, root, out, vcf_name="*.vcf.gz", with_ann=False)
    return spark.read.text(f"{out}/pipeline_info/columns/*").select("shard", "subshard", F.col("value").alias("name"))


@query("region_scan_indexed", f"""
{_RELEASE} WHERE (CHROM = 'chr1' AND POS <= 100000 AND POS + length(REF) - 1 >= 20000) OR (CHROM = 'chrX' AND POS <= 60010 AND POS + length(REF) - 1 >= 60000)
  OR CHROM = 'chr7'""", ("variants",))
def region_scan_indexed(spark, sf_dir):
    """bgzipped files indexed, and only the ranges read that the regions need."""
    files = staged(v.discover_files(spark, f"{_release_files(spark, sf_dir)}/*/*/*.gz"))
    v.index_vcf(files, 200_000).count()
    read = v.read_regions(spark, files, ["chr1:20000-100000", "chrX:60,000-60,010", "chr7"])
    return v.convert_annotations(read, CSQ_NAMES, with_ann=False)


@query("observed_gap_counts", """
SELECT count(*) AS n_sites, count(*) FILTER (WHERE csq IS NULL) AS n_unannotated,
  count(*) FILTER (WHERE alt LIKE '%,%') AS n_multiallelic FROM variants""", ("variants",))
def observed_gap_counts(spark, sf_dir):
    """Counted in the pass that converts and writes a release, summed over its two runs."""
    root, out = _release_files(spark, sf_dir), staging_path(spark)
    for subshard in ("subshard-0", "subshard-*"):
        v.convert_release(spark, root, out, subshards=subshard, vcf_name="*.vcf.gz", with_ann=False)
    return spark.read.parquet(f"{out}/pipeline_info/coverage").agg(*[F.sum(c).alias(c) for c in ("n_sites", "n_unannotated", "n_multiallelic")])


_TABLE_COLUMNS = ["CHROM", "POS", "REF", "ALT", "QUAL", "FILTER", "AC", "AN", "AF", "ANN", *CSQ_NAMES]


@query("list_fields", f"""
SELECT f.shard, CAST(c.position AS int) AS position, c.name FROM (SELECT DISTINCT 'shard-' || CAST(length(ref) AS varchar) AS shard FROM variants) AS f,
  (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(_TABLE_COLUMNS))}) AS c(position, name)""", ("variants",))
def list_fields(spark, sf_dir):
    """The columns that the first file of each shard would get, from its header alone."""
    files = v.discover_files(spark, f"{_release_files(spark, sf_dir)}/*/*/*.gz")
    firsts = files.groupBy("shard").agg(F.min("path").alias("path")).collect()
    listed = [v.list_fields(spark, row.path).withColumn("shard", F.lit(row.shard)) for row in firsts]
    return reduce(DataFrame.unionByName, listed)


_COLUMN_LINES = ", chr(10), ".join(f"'{c}'" for c in _TABLE_COLUMNS)


@query("schema_report", f"""
SELECT 'schema' AS file, CAST(i AS int) AS line, CAST(i AS varchar) || chr(9) || name AS value FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(_TABLE_COLUMNS))}) AS c(i, name)
UNION ALL SELECT 'schema_hashes', CAST(row_number() OVER (ORDER BY name) - 1 AS int), md5(concat({_COLUMN_LINES}, chr(10))) || chr(9) || name || chr(9) || '{len(_TABLE_COLUMNS)}'
FROM (SELECT DISTINCT shard || '/' || subshard AS name FROM (SELECT {_FOLDERS} FROM variants) AS f) AS h
UNION ALL SELECT 'schema_check', 0, CAST(count(*) AS varchar) || ' files checked' FROM (SELECT DISTINCT {_FOLDERS} FROM variants) AS g
UNION ALL SELECT 'schema_check', 1, '1 different column lists' UNION ALL SELECT 'schema_check', 2, '{len(_TABLE_COLUMNS)} columns in the list that counts'""", ("variants",))
def schema_report(spark, sf_dir):
    """The report files of a release, line by line: canonical columns, sorted hashes, log."""
    root, out = _release_files(spark, sf_dir), staging_path(spark)
    v.convert_release(spark, root, out, vcf_name="*.vcf.gz", with_ann=False)
    # Each is one small file, so its lines come in order.
    line = F.row_number().over(Window.partitionBy("file").orderBy("at")) - 1
    parts = [spark.read.text(f"{out}/pipeline_info/{name}").select(F.lit(name.split(".")[0]).alias("file"), F.monotonically_increasing_id().alias("at"), "value")
             for name in ("schema.tsv", "schema_hashes.tsv", "schema_check.log")]
    return reduce(DataFrame.unionByName, parts).select("file", line.alias("line"), "value")


@query("empty_output", f"SELECT * FROM ({_RELEASE}) AS r WHERE CHROM = 'nowhere'", ("variants",))
def empty_output(spark, sf_dir):
    """A release of which no row is left is a table with all its columns."""
    root, out = _release_files(spark, sf_dir), staging_path(spark)
    v.convert_release(spark, root, out, vcf_name="*.vcf.gz", with_ann=False, region="nowhere:1-10")
    return v.read_published(spark, out)


@query("gene_list", "SELECT DISTINCT gene FROM genes_to_keep", ("genes_to_keep",))
def gene_list(spark, sf_dir):
    path = staging_path(spark)
    genes = fixture(spark, sf_dir, "genes_to_keep")
    genes.unionByName(genes).select(F.col("gene").alias("gene_id"), F.lit(1).alias("other")).write.parquet(path)
    return v.read_gene_list(spark, path)


@query("read_tsv", "SELECT chrom, pos, nullif(qual, '.') AS qual, nullif(af, '.') AS af, nullif(ann, '.') AS ann FROM sites",
       ("sites",))
def read_tsv(spark, sf_dir):
    path = staging_path(spark)
    names = ["chrom", "pos", "qual", "af", "ann"]
    fixture(spark, sf_dir, "sites").select(F.concat_ws("\t", *names)).write.text(path)
    return v.read_all_string_tsv(spark, path, names)


@query("concat_parquet", "SELECT * FROM long_table", ("long_table",))
def concat_parquet(spark, sf_dir):
    """One annotations.parquet per strand, in folders of two roots, stacked again."""
    path = staging_path(spark)
    long = fixture(spark, sf_dir, "long_table")
    long.where("strand = '1'").write.parquet(f"{path}/a/shard-1/subshard-1/annotations.parquet")
    long.where("strand = '-1'").write.parquet(f"{path}/b/shard-1/subshard-2/annotations.parquet")
    return v.concat_annotations(spark, [f"{path}/a", f"{path}/b"])


@query("read_gtf", """
SELECT gene_id, seqname, feature, CAST(start1 AS bigint) AS start1, CAST(end1 AS bigint) AS end1, strand, gene_type
FROM gtf_genes""", ("gtf_genes",))
def read_gtf(spark, sf_dir):
    path = staging_path(spark)
    attributes = F.format_string('gene_id "%s"; gene_type "%s"; level 2;', "gene_id", "gene_type")
    dot = F.lit(".")
    fixture(spark, sf_dir, "gtf_genes").select(F.concat_ws(
        "\t", "seqname", F.lit("TEST"), "feature", "start1", "end1", dot, "strand", dot, attributes)).write.text(path)
    return v.read_gtf(spark, path)


_TSS = """
SELECT region, tss, strand_right, gene_length FROM (
  SELECT string_split(gene_id, '.')[1] AS region, CASE WHEN strand = '+' THEN start1 - 1 ELSE end1 END AS tss,
    strand AS strand_right, end1 - start1 + 2 AS gene_length,
    row_number() OVER (PARTITION BY string_split(gene_id, '.')[1] ORDER BY seqname, start1) AS n
  FROM gtf_genes WHERE feature = 'gene' AND gene_type = 'protein_coding') AS g WHERE n = 1"""


_GTF_LINE = "CASE WHEN start1 % 2 = 0 THEN 'gene_biotype' ELSE 'gene_type' END"


@query("read_gtf_attributes", """
SELECT gene_id, seqname, feature, CAST(start1 AS bigint) AS start1, CAST(end1 AS bigint) AS end1, strand, gene_type,
  CASE WHEN start1 % 3 = 0 THEN 'basic' ELSE 'basic,x;y' END AS tag, CAST(start1 % 4 AS varchar) AS level,
  CASE WHEN start1 % 5 = 0 THEN NULL ELSE 'say "gene_id" ' || strand END AS note FROM gtf_genes""", ("gtf_genes",))
def read_gtf_attributes(spark, sf_dir):
    """Repeated tags, quoted semicolons and escaped quotes, the biotype under either name."""
    path = staging_path(spark)
    dot = F.lit(".")
    attributes = F.concat(
        F.format_string('gene_id "%s"; ', "gene_id"), F.expr(_GTF_LINE), F.format_string(' "%s"; level %d; tag "basic";', "gene_type", F.expr("start1 % 4")),
        F.when(F.expr("start1 % 3 = 0"), "").otherwise(' tag "x;y";'), F.when(F.expr("start1 % 5 = 0"), "").otherwise(
            F.format_string(' note "say \\"gene_id\\" %s";', "strand")))
    fixture(spark, sf_dir, "gtf_genes").select(F.concat_ws(
        "\t", "seqname", F.lit("TEST"), "feature", "start1", "end1", dot, "strand", dot, attributes)).write.text(path)
    return v.read_gtf(spark, path, ["tag", "level", "note"])


@query("tss_of_either_dialect", _TSS, ("gtf_genes",))
def tss_of_either_dialect(spark, sf_dir):
    path = staging_path(spark)
    dot = F.lit(".")
    attributes = F.concat(F.format_string('gene_id "%s"; ', "gene_id"), F.expr(_GTF_LINE), F.format_string(' "%s";', "gene_type"))
    fixture(spark, sf_dir, "gtf_genes").select(F.concat_ws(
        "\t", "seqname", F.lit("TEST"), "feature", "start1", "end1", dot, "strand", dot, attributes)).write.text(path)
    return v.tss_table(v.read_gtf(spark, path))


@query("read_fasta", """
SELECT contig, chunk // 3 AS chunk, string_agg(seq, '' ORDER BY chunk) AS seq FROM genome_chunks
GROUP BY contig, chunk // 3""", ("genome_chunks",))
def read_fasta(spark, sf_dir):
    """One FASTA file per contig in 32-base lines, read back as 96-base chunks."""
    path = staging_path(spark)
    _genome_lines(spark, sf_dir).write.partitionBy("contig").text(path)
    return v.read_fasta_chunks(spark, f"{path}/*/*.txt", 3 * CHUNK)


# ── Schema agreement and publishing ────────────────────────────────────────


@query("schema_hashes", """
SELECT md5(concat('CHROM', chr(10), 'POS', chr(10), 'REF', chr(10), 'ALT', chr(10), 'QUAL', chr(10), 'FILTER', chr(10),
    'AC', chr(10), 'AN', chr(10), 'AF', chr(10), 'ANN', chr(10), string_agg(name, chr(10) ORDER BY position), chr(10))) AS hash,
  shard || '/' || subshard AS name, CAST(10 + count(*) AS int) AS ncols
FROM header_fields GROUP BY shard, subshard""", ("header_fields",))
def schema_hashes(spark, sf_dir):
    return v.schema_hashes(fixture(spark, sf_dir, "header_fields"))


@query("schema_check", """
SELECT hash, count(*) AS n, max(ncols) AS ncols, min(name) AS example FROM schema_hash_lines GROUP BY hash""",
       ("schema_hash_lines",))
def schema_check(spark, sf_dir):
    groups, _report = v.check_schema(fixture(spark, sf_dir, "schema_hash_lines"))
    return groups


@query("unpublished_files", """
SELECT 'shard-' || CAST(s_suppkey % 4 AS varchar) AS shard, 'subshard-' || CAST(s_suppkey AS varchar) AS subshard
FROM supplier WHERE s_suppkey % 40 <> 3""")
def unpublished_files(spark, sf_dir):
    lines = fixture(spark, sf_dir, "schema_hash_lines")
    found = lines.select(F.split_part("name", F.lit("/"), F.lit(1)).alias("shard"),
                         F.split_part("name", F.lit("/"), F.lit(2)).alias("subshard"))
    return v.unpublished(found, lines.where("ncols = 3"))


# ── Checks on keys ─────────────────────────────────────────────────────────


@query("key_null_counts", """
SELECT count(*) FILTER (WHERE chrom IS NULL) AS chrom, count(*) FILTER (WHERE pos IS NULL) AS pos,
  count(*) FILTER (WHERE ref IS NULL) AS ref, count(*) FILTER (WHERE alt IS NULL) AS alt FROM long_table""",
       ("long_table",))
def key_null_counts(spark, sf_dir):
    return v.null_counts(fixture(spark, sf_dir, "long_table"), VARIANT_KEY)


@query("duplicate_key_report", """
SELECT id, gene, count(*) AS n FROM long_table WHERE id IS NOT NULL AND gene IS NOT NULL
GROUP BY id, gene HAVING count(*) > 1""", ("long_table",))
def duplicate_key_report(spark, sf_dir):
    return v.duplicate_keys(fixture(spark, sf_dir, "long_table"), ["id", "gene"])


@query("rows_with_duplicate_keys", """
SELECT id, gene, feature FROM long_table WHERE id IN (SELECT id FROM (
  SELECT id, gene FROM long_table WHERE id IS NOT NULL AND gene IS NOT NULL GROUP BY id, gene HAVING count(*) > 1) AS d)""",
       ("long_table",))
def rows_with_duplicate_keys(spark, sf_dir):
    return v.rows_with_duplicate_keys(fixture(spark, sf_dir, "long_table"), ["id", "gene"]).select("id", "gene", "feature")


@query("distinct_rows", "SELECT DISTINCT * FROM long_table", ("long_table",))
def distinct_rows(spark, sf_dir):
    return v.distinct_rows(fixture(spark, sf_dir, "long_table"))


@query("distinct_rows_rare_copies", "SELECT DISTINCT id, gene FROM long_table", ("long_table",))
def distinct_rows_rare_copies(spark, sf_dir):
    return v.distinct_rows(fixture(spark, sf_dir, "long_table").select("id", "gene"), rare_copies=True)


# ── Row features ───────────────────────────────────────────────────────────

_KEYED = "id, feature, gene"


@query("gene_biotype_filter", f"""
SELECT {_KEYED}, biotype FROM long_table
WHERE gene IN (SELECT gene FROM genes_to_keep) AND biotype IN ('protein_coding', 'lncRNA')""",
       ("long_table", "genes_to_keep"))
def gene_biotype_filter(spark, sf_dir):
    kept = v.filter_genes(fixture(spark, sf_dir, "long_table"), fixture(spark, sf_dir, "genes_to_keep"),
                          ["protein_coding", "lncRNA"])
    return kept.select("id", "feature", "gene", "biotype")


def _label_sql(labels: list[str], sep: str, source: str = "consequence", prefix: str = "consequence") -> str:
    return ", ".join(
        f"CASE WHEN {source} IS NOT NULL THEN CAST(list_contains(string_split({source}, '{sep}'), '{x}') AS tinyint) END "
        f"AS \"{prefix}_{x}\"" for x in labels)


@query("consequence_one_hot", f"SELECT {_KEYED}, consequence, {_label_sql(LABELS, '&')} FROM long_table", ("long_table",))
def consequence_one_hot(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "consequence")
    return v.one_hot(long, "consequence", "&", LABELS)


_COMMA_LABELS = ["missense_variant", "missense_variant&splice_region_variant", "start_lost", "synonymous_variant"]


@query("consequence_one_hot_found", f"SELECT {_KEYED}, consequence, {_label_sql(_COMMA_LABELS, ',')} FROM long_table",
       ("long_table",))
def consequence_one_hot_found(spark, sf_dir):
    """Vocabulary taken from the data, default separator: ``a&b`` is one label."""
    return v.one_hot(fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "consequence"), "consequence")


@query("loftee_flags", f"""
SELECT {_KEYED}, lof, CAST(coalesce(lof = 'HC', false) AS tinyint) AS loftee_hc, CAST(lof IS NULL AS tinyint) AS loftee_hc_is_na,
  CAST(coalesce(lof = 'LC', false) AS tinyint) AS loftee_lc, CAST(lof IS NULL AS tinyint) AS loftee_lc_is_na
FROM long_table""", ("long_table",))
def loftee_flags(spark, sf_dir):
    return v.loftee_flags(fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "lof"))


_RELATIVE = """CASE WHEN id IS NOT NULL AND gene IS NOT NULL THEN round_even(list_max([
    TRY_CAST(x AS bigint) for x in string_split(string_split(cds_position, '/')[1], '-') if regexp_full_match(x, '[0-9]+')])
  / CAST(string_split(cds_position, '/')[2] AS double) * 100, 0) / 100 END"""


@query("relative_cds_position", f"SELECT {_KEYED}, cds_position, {_RELATIVE} AS relative_cds_position FROM long_table",
       ("long_table",))
def relative_cds_position(spark, sf_dir):
    return v.relative_cds_position(fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "cds_position"))


_SPLICEAI = "list_max([TRY_CAST(x AS float) for x in string_split(spliceai_pred, '&')[2:5]])"


@query("spliceai_max_delta", f"SELECT {_KEYED}, {_SPLICEAI} AS spliceai_delta_score FROM long_table", ("long_table",))
def spliceai_max_delta(spark, sf_dir):
    return v.spliceai_delta(fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "spliceai_pred"), "&")


@query("substitution_score", f"""
SELECT {_KEYED}, amino_acids, m.blosum62 FROM long_table AS t LEFT JOIN substitution_matrix AS m
  ON t.amino_acids = m.ref_aa || '/' || m.alt_aa""", ("long_table", "substitution_matrix"))
def substitution_score(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "amino_acids")
    return v.substitution_score(long, fixture(spark, sf_dir, "substitution_matrix"))


_LENGTHS = """CAST(greatest(length(ref), length(alt)) AS int) AS variant_length,
  CAST(greatest(length(ref), length(alt)) > 1 AS tinyint) AS is_indel,
  CAST(length(ref) < length(alt) AS tinyint) AS is_insertion, CAST(length(ref) > length(alt) AS tinyint) AS is_deletion"""


@query("variant_length_flags", f"SELECT k, ref, alt, {_LENGTHS} FROM typed_sites", ("typed_sites",))
def variant_length_flags(spark, sf_dir):
    return v.length_flags(fixture(spark, sf_dir, "typed_sites").select("k", "ref", "alt"))


@query("absent_columns", f"SELECT {_KEYED}, gene AS region, CAST(NULL AS double) AS next_in_frame_relative, false AS known FROM long_table", ("long_table",))
def absent_columns(spark, sf_dir):
    """Steps whose column is not in the table leave it alone, or give a null."""
    long = v.with_region(fixture(spark, sf_dir, "long_table").select("id", "feature", "gene"))
    table = v.substitution_score(v.spliceai_delta(long), fixture(spark, sf_dir, "substitution_matrix"))
    table = v.protein_position_scores(table, fixture(spark, sf_dir, "position_scores"))
    table = v.domain_overlap(table, fixture(spark, sf_dir, "protein_domains"))
    table = v.start_lost_distance(table, fixture(spark, sf_dir, "genome_chunks"), CHUNK)
    return table.withColumn("known", F.lit(bool({"blosum62", "spliceai_delta_score", "cpt1_score", *_FLAGS} & set(table.columns))))


@query("cohort_frequency", f"SELECT {_KEYED}, af, af AS maf_cohort, gene AS region FROM long_table", ("long_table",))
def cohort_frequency(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature", "gene", "af")
    return v.with_region(v.with_maf_cohort(long))


# ── Gene features ──────────────────────────────────────────────────────────

@query("tss_table", _TSS, ("gtf_genes",))
def tss_table(spark, sf_dir):
    return v.tss_table(fixture(spark, sf_dir, "gtf_genes"))


_DISTANCE = "CASE WHEN strand_right = '+' THEN pos - tss ELSE tss - pos END"


@query("distance_to_tss", f"""
SELECT t.id, t.feature, t.pos, t.gene AS region, g.tss, g.strand_right, g.gene_length, {_DISTANCE} AS dist_to_tss
FROM long_table AS t LEFT JOIN ({_TSS}) AS g ON t.gene = g.region""", ("long_table", "gtf_genes"))
def distance_to_tss(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature", "pos", F.col("gene").alias("region"))
    return v.distance_to_tss(long, v.tss_table(fixture(spark, sf_dir, "gtf_genes")))


# ── Sequence features ──────────────────────────────────────────────────────

_WINDOWS = """
SELECT *, CASE WHEN strand = '1' THEN greatest(pos - o, 0) ELSE greatest(pos + o - 1 - n, 0) END AS w_start,
  CASE WHEN strand = '1' THEN pos + 100 ELSE pos + o - 1 END AS w_end
FROM (SELECT *, TRY_CAST(string_split(cds_position, '/')[1] AS bigint) AS o,
        TRY_CAST(string_split(cds_position, '/')[2] AS bigint) AS n FROM long_table
      WHERE consequence = 'start_lost' AND id IS NOT NULL AND gene IS NOT NULL
        AND regexp_full_match(cds_position, '[0-9]/[0-9]+')) AS s"""

_SEQUENCES = f"""
SELECT w_chrom, w_start, w_end, w_strand, CASE WHEN w_strand = '-1'
    THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq FROM (
  SELECT w_chrom, w_start, w_end, w_strand,
    substr(string_agg(c.seq, '' ORDER BY c.chunk), w_start % {CHUNK} + 1, w_end - w_start) AS seq
  FROM (SELECT DISTINCT chrom AS w_chrom, w_start, w_end, strand AS w_strand FROM ({_WINDOWS}) AS s) AS w
  JOIN genome_chunks AS c ON c.contig = w.w_chrom
    AND c.chunk BETWEEN w.w_start // {CHUNK} AND (w.w_end - 1) // {CHUNK}
  WHERE w_end > w_start GROUP BY w_chrom, w_start, w_end, w_strand) AS q"""

_NEXT_ATG = "coalesce([i for i in range(3, length(seq) - 2, 3) if substr(seq, i + 1, 3) = 'ATG'][1], -1)"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.one_hot(fixture(spark, sf_dir, "long_table"), "consequence", "&", LABELS)


@query("fetch_sequences", f"SELECT *, CAST({_NEXT_ATG} AS int) AS next_atg FROM ({_SEQUENCES}) AS s",
       ("long_table", "genome_chunks"))
def fetch_sequences(spark, sf_dir):
    windows = with_windows(_labelled(spark, sf_dir)).where("w_start is not null").select(*WINDOW)
    found = v.fetch_sequences(windows, fixture(spark, sf_dir, "genome_chunks"), CHUNK)
    return found.withColumn("next_atg", next_inframe_atg(F.col("seq")))


def _genome_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The genome as FASTA lines ``contig, value`` in 32-base lines, a contig's lines in order."""
    genome = fixture(spark, sf_dir, "genome_chunks")
    headers = genome.select("contig").distinct().select(
        "contig", F.lit(-1).cast("bigint").alias("chunk"), F.concat(F.lit(">"), "contig").alias("seq"))
    ordered = genome.unionByName(headers).repartition("contig").sortWithinPartitions("contig", "chunk")
    return ordered.select("contig", F.col("seq").alias("value"))


def _fetched(spark: SparkSession, sf_dir: str, glob: str) -> DataFrame:
    listing = spark.read.format("binaryFile").load(glob).select("path", "length")
    v.index_fasta(staged(listing), 100_000).count()
    windows = with_windows(_labelled(spark, sf_dir)).where("w_start is not null").select(*WINDOW)
    return v.fetch_indexed(windows, v.read_fasta_index(spark, glob))


@query("fetch_sequences_indexed", f"SELECT * FROM ({_SEQUENCES}) AS s", ("long_table", "genome_chunks"))
def fetch_sequences_indexed(spark, sf_dir):
    """Windows from the byte ranges of indexed FASTA files; the genome is not read."""
    path = staging_path(spark)
    _genome_lines(spark, sf_dir).write.partitionBy("contig").text(path)
    return _fetched(spark, sf_dir, f"{path}/*/*.txt")


@query("fetch_sequences_bgzf", f"SELECT * FROM ({_SEQUENCES}) AS s", ("long_table", "genome_chunks"))
def fetch_sequences_bgzf(spark, sf_dir):
    """The same from bgzipped FASTA files: of those only the members with the windows are read."""
    path = staging_path(spark)
    write_bgzf(_genome_lines(spark, sf_dir), path, ("contig",)).count()
    return _fetched(spark, sf_dir, f"{path}/*/*.gz")


_START_LOST = f"""
SELECT t.*, CASE WHEN d.a < 0 THEN 1e0 ELSE CAST(d.a AS double) / t.n END AS next_in_frame_relative
FROM ({_WINDOWS}) AS t LEFT JOIN (SELECT *, {_NEXT_ATG} AS a FROM ({_SEQUENCES}) AS s) AS d
  ON t.chrom = d.w_chrom AND t.w_start = d.w_start AND t.w_end = d.w_end AND t.strand = d.w_strand"""


@query("start_lost_next_atg", f"""
SELECT l.id, l.feature, l.gene, l.cds_position, l.strand, CASE WHEN l.consequence = 'start_lost' THEN r.next_in_frame_relative END
  AS next_in_frame_relative
FROM long_table AS l LEFT JOIN (SELECT DISTINCT id, gene, cds_position, strand, next_in_frame_relative FROM ({_START_LOST}) AS q) AS r
  ON l.id = r.id AND l.gene = r.gene AND l.cds_position = r.cds_position AND l.strand = r.strand""",
       ("long_table", "genome_chunks"))
def start_lost_next_atg(spark, sf_dir):
    done = v.start_lost_distance(_labelled(spark, sf_dir), fixture(spark, sf_dir, "genome_chunks"), CHUNK)
    return done.select("id", "feature", "gene", "cds_position", "strand", "next_in_frame_relative")


# ── Score merges ───────────────────────────────────────────────────────────


@query("score_key_normalisation", """
SELECT 'chr' || chrom AS chrom, pos, ref, alt, 'chr' || chrom || ':' || CAST(pos AS varchar) || ':' || ref || ':' || alt AS id,
  geneid AS region, phred, rawscore FROM deleteriousness_raw""", ("deleteriousness_raw",))
def score_key_normalisation(spark, sf_dir):
    return v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid")


@query("contig_prefixes", """
SELECT chrom, 'chr' || ltrim(chrom, 'chr') AS prefixed, ltrim(chrom, 'chr') AS bare FROM conservation_raw""",
       ("conservation_raw",))
def contig_prefixes(spark, sf_dir):
    raw = fixture(spark, sf_dir, "conservation_raw").select("chrom")
    return raw.select("chrom", with_chr(without_chr(F.col("chrom"))).alias("prefixed"),
                      without_chr(F.col("chrom")).alias("bare"))


_CONSERVATION = """
SELECT d.id, d.chrom, d.pos, d.ref, d.alt, c.gpn_score
FROM (SELECT DISTINCT id, chrom, pos, ref, alt FROM long_table) AS d LEFT JOIN conservation_raw AS c
  ON lower(substr(d.chrom, 4)) = lower(c.chrom) AND d.pos = c.pos AND d.ref = c.ref AND d.alt = c.alt"""


@query("conservation_merge", _CONSERVATION, ("long_table", "conservation_raw"))
def conservation_merge(spark, sf_dir):
    return v.conservation_scores(fixture(spark, sf_dir, "long_table"), fixture(spark, sf_dir, "conservation_raw"))


_FIRST_COLUMNS = ["id", "feature", "gene", "consequence", "amino_acids", "cds_position", "lof", "spliceai_pred",
                  "region", "tss", "strand_right", "gene_length", "dist_to_tss"]


def _first_sql(source: str, columns: list[str]) -> str:
    ties = ", ".join(f'"{c}" NULLS LAST' for c in columns if c not in ("id", "feature"))
    return (f"SELECT * EXCLUDE (n) FROM (SELECT {', '.join(columns)}, row_number() OVER (PARTITION BY id, feature "
            f"ORDER BY dist_to_tss NULLS LAST, {ties}) AS n FROM ({source}) AS s) AS r WHERE n = 1")


@query("keep_first_per_transcript", _first_sql(f"""
SELECT t.*, t.gene AS region, g.tss, g.strand_right, g.gene_length, {_DISTANCE} AS dist_to_tss
FROM long_table AS t LEFT JOIN ({_TSS}) AS g ON t.gene = g.region""", _FIRST_COLUMNS), ("long_table", "gtf_genes"))
def keep_first_per_transcript(spark, sf_dir):
    long = v.with_region(fixture(spark, sf_dir, "long_table"))
    located = v.distance_to_tss(long, v.tss_table(fixture(spark, sf_dir, "gtf_genes"))).select(*_FIRST_COLUMNS)
    return v.keep_first(located, ["id", "feature"], [F.asc_nulls_last("dist_to_tss")])


# The annotated part of a genome-wide score table: four contigs.
_PART = "SELECT * FROM long_table WHERE chrom IN ('chr1', 'chr2', 'chrX', 'chrY')"


@query("bloom_reduced_scores", f"""
SELECT d.id, d.chrom, d.pos, d.ref, d.alt, c.gpn_score
FROM (SELECT DISTINCT id, chrom, pos, ref, alt FROM ({_PART}) AS p) AS d LEFT JOIN conservation_raw AS c
  ON lower(substr(d.chrom, 4)) = lower(c.chrom) AND d.pos = c.pos AND d.ref = c.ref AND d.alt = c.alt""", ("long_table", "conservation_raw"))
def bloom_reduced_scores(spark, sf_dir):
    """Score rows of other variants are dropped by a Bloom filter before the shuffle."""
    part = fixture(spark, sf_dir, "long_table").where(F.col("chrom").isin("chr1", "chr2", "chrX", "chrY"))
    return v.conservation_scores(part, fixture(spark, sf_dir, "conservation_raw"), reduce=True)


@query("bucketed_merge", """
SELECT t.id, t.chrom, t.pos, t.ref, t.alt, t.feature, t.gene AS region, c.gpn_score, d.phred, d.rawscore FROM long_table AS t
LEFT JOIN (SELECT 'chr' || upper(chrom) AS chrom, pos, ref, alt, gpn_score FROM conservation_raw) AS c
  ON t.chrom = c.chrom AND t.pos = c.pos AND t.ref = c.ref AND t.alt = c.alt
LEFT JOIN deleteriousness_raw AS d ON t.chrom = 'chr' || d.chrom AND t.pos = d.pos AND t.ref = d.ref AND t.alt = d.alt AND t.gene = d.geneid""",
       ("long_table", "conservation_raw", "deleteriousness_raw"))
def bucketed_merge(spark, sf_dir):
    """Score tables stored in buckets of the variant key, merged twice without an exchange."""
    name = uuid.uuid4().hex
    long = fixture(spark, sf_dir, "long_table").select("id", *VARIANT_KEY, "feature", F.col("gene").alias("region"))
    raw = fixture(spark, sf_dir, "conservation_raw")
    conservation = raw.select(F.concat(F.lit("chr"), F.upper("chrom")).alias("chrom"), "pos", "ref", "alt", "gpn_score")
    scores = v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid").drop("id")
    stored = [v.store_bucketed(df, f"varloom_{kind}_{name}", VARIANT_KEY, 8, staging_path(spark)) for kind, df in (("long", long), ("a", conservation), ("b", scores))]
    return v.merge_bucketed(v.merge_bucketed(stored[0], stored[1], VARIANT_KEY), stored[2], [*VARIANT_KEY, "region"])


def _delete_join(source: str) -> str:
    return f"""
SELECT t.*, CAST(d.phred AS float) AS phred, CAST(d.rawscore AS float) AS rawscore FROM ({source}) AS t
LEFT JOIN deleteriousness_raw AS d ON t.chrom = 'chr' || d.chrom AND t.pos = d.pos AND t.ref = d.ref AND t.alt = d.alt
  AND t.region = d.geneid"""


@query("deleteriousness_merge", _delete_join(
    "SELECT id, chrom, pos, ref, alt, feature, gene AS region, CAST(af AS float) AS af FROM long_table"),
       ("long_table", "deleteriousness_raw"))
def deleteriousness_merge(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select(
        "id", *VARIANT_KEY, "feature", F.col("gene").alias("region"), "af")
    scores = v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid")
    return v.merge_deleteriousness(long, scores, ["PHRED", "RawScore", "absent"])


@query("bloom_reduced_deleteriousness", _delete_join(
    f"SELECT id, chrom, pos, ref, alt, feature, gene AS region, CAST(af AS float) AS af FROM ({_PART}) AS p"),
       ("long_table", "deleteriousness_raw"))
def bloom_reduced_deleteriousness(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").where(F.col("chrom").isin("chr1", "chr2", "chrX", "chrY")).select(
        "id", *VARIANT_KEY, "feature", F.col("gene").alias("region"), "af")
    scores = v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid")
    return v.merge_deleteriousness(long, scores, ["PHRED", "RawScore"], reduce=True)


@query("deleteriousness_merge_max", """
SELECT t.id, t.chrom, t.pos, t.ref, t.alt, t.feature, t.gene AS region, CAST(d.phred AS float) AS phred
FROM long_table AS t LEFT JOIN (SELECT chrom, pos, ref, alt, geneid, max(phred) AS phred FROM deleteriousness_raw
  GROUP BY chrom, pos, ref, alt, geneid) AS d ON t.chrom = 'chr' || d.chrom AND t.pos = d.pos AND t.ref = d.ref
  AND t.alt = d.alt AND t.gene = d.geneid""", ("long_table", "deleteriousness_raw"))
def deleteriousness_merge_max(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", *VARIANT_KEY, "feature", F.col("gene").alias("region"))
    scores = v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid")
    return v.merge_deleteriousness(long, scores, ["phred"], dedupe="max")


@query("join_variants", f"""
SELECT l.CHROM, l.POS, l.REF, l.ALT, l.consequence, l.feature, g.sample FROM ({_LONG}) AS l JOIN genotypes AS g
  ON l.CHROM = g.CHROM AND l.POS = g.POS AND l.REF = g.REF AND l.ALT = g.ALT""", ("variants", "genotypes"))
def join_variants(spark, sf_dir):
    long = v.convert_annotations(_sites(spark, sf_dir), CSQ_NAMES, with_ann=False)
    joined = v.join_variants(long, fixture(spark, sf_dir, "genotypes"))
    return joined.select("CHROM", "POS", "REF", "ALT", "consequence", "feature", "sample")


@query("join_variants_outer", f"""
SELECT coalesce(l.CHROM, g.CHROM) AS CHROM, coalesce(l.POS, g.POS) AS POS, coalesce(l.REF, g.REF) AS REF, coalesce(l.ALT, g.ALT) AS ALT,
  l.feature, g.sample FROM ({_LONG}) AS l FULL JOIN genotypes AS g
  ON l.CHROM = g.CHROM AND l.POS = g.POS AND l.REF = g.REF AND l.ALT = g.ALT""", ("variants", "genotypes"))
def join_variants_outer(spark, sf_dir):
    long = v.convert_annotations(_sites(spark, sf_dir), CSQ_NAMES, with_ann=False)
    joined = v.join_variants(long, fixture(spark, sf_dir, "genotypes"), "outer")
    return joined.select("CHROM", "POS", "REF", "ALT", "feature", "sample")


@query("downcast_doubles", "SELECT chrom, pos, CAST(phred AS float) AS phred, CAST(rawscore AS float) AS rawscore "
       "FROM deleteriousness_raw", ("deleteriousness_raw",))
def downcast_doubles(spark, sf_dir):
    return v.downcast_doubles(fixture(spark, sf_dir, "deleteriousness_raw").select("chrom", "pos", "phred", "rawscore"))


_SPEC = {"af": [0], "spliceai_delta_score": [0.0], "blosum62": [-4], "lof": ["none"], "not_kept": [1]}
_KEEP = ["id", "feature", "region", "af", "spliceai_delta_score", "blosum62", "lof", "not_in_table"]


def _fill_sql(source: str, extra: str = "") -> str:
    labels = ", ".join(f"coalesce(\"consequence_{x}\", 0) AS \"consequence_{x}\"" for x in LABELS)
    return f"""
SELECT id, feature, region, coalesce(af, 0) AS af, coalesce(spliceai_delta_score, 0) AS spliceai_delta_score,
  coalesce(blosum62, -4) AS blosum62, coalesce(lof, 'none') AS lof, {extra} {labels}, CAST(af IS NULL AS tinyint) AS af_is_na,
  CAST(spliceai_delta_score IS NULL AS tinyint) AS spliceai_delta_score_is_na,
  CAST(blosum62 IS NULL AS tinyint) AS blosum62_is_na, CAST(lof IS NULL AS tinyint) AS lof_is_na
FROM ({source}) AS f"""


@query("fill_nulls", _fill_sql(f"""
SELECT id, feature, gene AS region, af, {_SPLICEAI} AS spliceai_delta_score, m.blosum62, lof, {_label_sql(LABELS, '&')}
FROM long_table AS t LEFT JOIN substitution_matrix AS m ON t.amino_acids = m.ref_aa || '/' || m.alt_aa"""),
       ("long_table", "substitution_matrix"))
def fill_nulls(spark, sf_dir):
    table = v.with_region(v.spliceai_delta(_labelled(spark, sf_dir), "&"))
    table = v.substitution_score(table, fixture(spark, sf_dir, "substitution_matrix"))
    return v.fill_nulls(table, _SPEC, _KEEP)


# ── Whole builds ───────────────────────────────────────────────────────────

_BASE = ["chrom", "pos", "ref", "alt", "af", "id", "allele", "consequence", "gene", "feature", "biotype", "strand",
         "cds_position", "amino_acids", "lof"]
_VEP = f"""
SELECT {', '.join('t.' + c for c in _BASE)}, {_label_sql(LABELS, '&', 't.consequence')},
  CAST(coalesce(t.lof = 'HC', false) AS tinyint) AS loftee_hc, CAST(t.lof IS NULL AS tinyint) AS loftee_hc_is_na,
  CAST(coalesce(t.lof = 'LC', false) AS tinyint) AS loftee_lc, CAST(t.lof IS NULL AS tinyint) AS loftee_lc_is_na,
  t.af AS maf_cohort, {_RELATIVE} AS relative_cds_position,
  CASE WHEN consequence = 'start_lost' THEN next_in_frame_relative END AS next_in_frame_relative,
  {_SPLICEAI} AS spliceai_delta_score, m.blosum62, {_LENGTHS}, t.gene AS region, g.tss, g.strand_right, g.gene_length,
  {_DISTANCE} AS dist_to_tss
FROM (SELECT DISTINCT * FROM long_table WHERE gene IN (SELECT gene FROM genes_to_keep)
      AND biotype IN ('protein_coding', 'lncRNA')) AS t
LEFT JOIN (SELECT DISTINCT id AS r_id, gene AS r_gene, cds_position AS r_cds, strand AS r_strand, next_in_frame_relative
  FROM ({_START_LOST}) AS q) AS r ON t.id = r_id AND t.gene = r_gene AND t.cds_position = r_cds AND t.strand = r_strand
LEFT JOIN substitution_matrix AS m ON t.amino_acids = m.ref_aa || '/' || m.alt_aa
LEFT JOIN ({_TSS}) AS g ON t.gene = g.region"""
_VEP_TABLES = ("long_table", "genes_to_keep", "genome_chunks", "substitution_matrix", "gtf_genes")
_VEP_COLUMNS = [*_BASE, *[f"consequence_{x}" for x in LABELS], "loftee_hc", "loftee_hc_is_na", "loftee_lc",
                "loftee_lc_is_na", "maf_cohort", "relative_cds_position", "next_in_frame_relative",
                "spliceai_delta_score", "blosum62", "variant_length", "is_indel", "is_insertion", "is_deletion",
                "region", "tss", "strand_right", "gene_length", "dist_to_tss"]


def _vep(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = v.process_vep(
        fixture(spark, sf_dir, "long_table"), v.tss_table(fixture(spark, sf_dir, "gtf_genes")),
        fixture(spark, sf_dir, "substitution_matrix"), fixture(spark, sf_dir, "genome_chunks"), CHUNK,
        fixture(spark, sf_dir, "genes_to_keep"), ["protein_coding", "lncRNA"],
        consequence_sep="&", spliceai_sep="&", vocabulary=LABELS)
    return table.select(*_VEP_COLUMNS)


@query("process_vep", _VEP, _VEP_TABLES)
def process_vep(spark, sf_dir):
    return _vep(spark, sf_dir)


_PRE = f"""
SELECT f.*, c.gpn_score FROM ({_first_sql(_VEP, _VEP_COLUMNS)}) AS f LEFT JOIN ({_CONSERVATION}) AS c
  ON f.chrom = c.chrom AND f.pos = c.pos AND f.ref = c.ref AND f.alt = c.alt"""


@query("pre_deleteriousness", _PRE, (*_VEP_TABLES, "conservation_raw"))
def pre_deleteriousness(spark, sf_dir):
    table = staged(_vep(spark, sf_dir))
    scores = v.conservation_scores(fixture(spark, sf_dir, "typed_sites"), fixture(spark, sf_dir, "conservation_raw"))
    return v.merge_pre_deleteriousness(table, staged(scores))


_FEATURES = _fill_sql(_delete_join(
    _PRE.replace("f.*", "f.* REPLACE (CAST(f.af AS float) AS af)")),
    "coalesce(phred, 0) AS phred, coalesce(CAST(gpn_score AS float), 0) AS gpn_score,") .replace(
        "CAST(lof IS NULL AS tinyint) AS lof_is_na",
        "CAST(lof IS NULL AS tinyint) AS lof_is_na, CAST(phred IS NULL AS tinyint) AS phred_is_na, "
        "CAST(gpn_score IS NULL AS tinyint) AS gpn_score_is_na")


@query("feature_table", _FEATURES, (*_VEP_TABLES, "conservation_raw", "deleteriousness_raw"))
def feature_table(spark, sf_dir):
    """All stages after the long table: features, score merges, fill."""
    scores = v.normalise_score_keys(fixture(spark, sf_dir, "deleteriousness_raw"), gene="geneid")
    table = staged(pre_deleteriousness(spark, sf_dir))
    merged = v.merge_deleteriousness(table, scores, ["phred", "rawscore"])
    spec = {**_SPEC, "phred": [0], "gpn_score": [0]}
    return v.fill_nulls(merged, spec, [*_KEEP[:-1], "phred", "gpn_score"])


def _pipeline_config(spark: SparkSession, sf_dir: str, path: str, **given) -> v.FeatureConfig:
    """Reference files below ``path``: GTF, FASTA, matrix, gene list, scores; and the configuration that names them."""
    attributes = F.format_string('gene_id "%s"; gene_type "%s";', "gene_id", "gene_type")
    dot = F.lit(".")
    fixture(spark, sf_dir, "gtf_genes").select(F.concat_ws(
        "\t", "seqname", F.lit("TEST"), "feature", "start1", "end1", dot, "strand", dot, attributes)).write.text(f"{path}/genes.gtf")
    _genome_lines(spark, sf_dir).write.partitionBy("contig").text(f"{path}/genome")
    cells = fixture(spark, sf_dir, "substitution_matrix").where("ref_aa >= alt_aa")
    triangle = cells.groupBy("ref_aa").agg(F.sort_array(F.collect_list(F.struct("alt_aa", "blosum62"))).alias("row")).select(
        "ref_aa", F.concat_ws(" ", F.transform("row", lambda c: c.blosum62.cast("int").cast("string"))).alias("line"))
    whole = triangle.agg(F.sort_array(F.collect_list(F.struct("ref_aa", "line"))).alias("rows")).select(F.concat(
        F.concat_ws(" ", F.transform("rows", lambda r: r.ref_aa)), F.lit("\n"), F.concat_ws("\n", F.transform("rows", lambda r: r.line))))
    whole.coalesce(1).write.text(f"{path}/matrix")
    fixture(spark, sf_dir, "genes_to_keep").select(F.col("gene").alias("gene_id")).write.parquet(f"{path}/genes")
    fixture(spark, sf_dir, "conservation_raw").write.parquet(f"{path}/conservation")
    fixture(spark, sf_dir, "deleteriousness_raw").write.parquet(f"{path}/scores")
    return v.FeatureConfig(
        outdir=f"{path}/out", gtf=f"{path}/genes.gtf", fasta=f"{path}/genome/*/*.txt",
        substitution_matrix=f"{path}/matrix", gene_list=f"{path}/genes", biotypes=["protein_coding", "lncRNA"], vocabulary=LABELS,
        conservation=f"{path}/conservation", deleteriousness=f"{path}/scores", deleteriousness_columns=["phred", "rawscore"],
        deleteriousness_keys={"chrom": "chrom", "pos": "pos", "ref": "ref", "alt": "alt", "gene": "geneid"},
        fill={**_SPEC, "phred": [0], "gpn_score": [0]}, keep=[*_KEEP[:-1], "phred", "gpn_score"], **given)


@query("run_pipeline", _FEATURES, (*_VEP_TABLES, "conservation_raw", "deleteriousness_raw"))
def run_pipeline(spark, sf_dir):
    """The same build by the job itself, from files: annotation folders, GTF, FASTA, matrix, gene list, scores."""
    path = staging_path(spark)
    fixture(spark, sf_dir, "long_table").write.option("compression", "zstd").parquet(f"{path}/in/shard-1/subshard-1/annotations.parquet")
    return v.run_pipeline(spark, _pipeline_config(spark, sf_dir, path, roots=[f"{path}/in"]))


@query("incremental_features", _FEATURES, (*_VEP_TABLES, "conservation_raw", "deleteriousness_raw"))
def incremental_features(spark, sf_dir):
    """The same features, built in two runs as the release grows; the second run reads only what is new."""
    path, root = staging_path(spark), _release_files(spark, sf_dir)
    config = _pipeline_config(spark, sf_dir, path, published=f"{path}/long", incremental=True)
    for subshard in ("subshard-0", "subshard-*"):
        v.convert_release(spark, root, f"{path}/long", subshards=subshard, vcf_name="*.vcf.gz", with_ann=False)
        found = v.run_pipeline(spark, config)
    return found


# ── Merges the reference keeps switched off ────────────────────────────────


@query("promoter_max_abs", """
SELECT t.id, t.gene, t.feature, p.promoterai FROM long_table AS t LEFT JOIN (
  SELECT id, gene, CASE WHEN max(promoterai) >= -min(promoterai) THEN max(promoterai) ELSE min(promoterai) END AS promoterai
  FROM promoter_raw GROUP BY id, gene) AS p ON t.id = p.id AND t.gene = p.gene""", ("long_table", "promoter_raw"))
def promoter_max_abs(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "gene", "feature")
    return v.promoter_scores(long, fixture(spark, sf_dir, "promoter_raw"))


@query("promoter_from_raw", """
SELECT t.id, t.gene, t.feature, p.promoterai FROM long_table AS t LEFT JOIN (
  SELECT id, gene, CASE WHEN max(promoterai) >= -min(promoterai) THEN max(promoterai) ELSE min(promoterai) END AS promoterai
  FROM promoter_raw GROUP BY id, gene) AS p ON t.id = p.id AND t.gene = p.gene""", ("long_table", "promoter_raw"))
def promoter_from_raw(spark, sf_dir):
    """As above, the scores in the columns of their own files."""
    long = fixture(spark, sf_dir, "long_table").select("id", "gene", "feature")
    part = F.split("id", ":")
    raw = fixture(spark, sf_dir, "promoter_raw").select(
        part[0].alias("chrom"), part[1].cast("long").alias("pos"), part[2].alias("ref"), part[3].alias("alt"),
        F.lit("name").alias("gene"), F.col("gene").alias("gene_id"), F.col("promoterai").alias("promoterAI"))
    return v.promoter_scores(long, score_merges.normalise_promoter_scores(raw))


# The flag columns as a domain table names them.
_FLAGS = ("mobi_full_disorder_priority", "mobi_curated_disorder_priority", "mobi_full_lip_priority", "ted_domain",
          "low_complexity_domain")


@query("domain_overlap", f"""
SELECT r.*, {', '.join(f'coalesce(h.{f}, false) AS {f}' for f in _FLAGS)} FROM protein_rows AS r LEFT JOIN (
  SELECT v.id, v.region, {', '.join(f'bool_or(d.{f}) AS {f}' for f in _FLAGS)}
  FROM (SELECT id, region, TRY_CAST(s[1] AS int) AS a, TRY_CAST(coalesce(s[2], s[1]) AS int) AS b FROM (
    SELECT id, region, string_split(string_split(protein_position, '/')[1], '-') AS s FROM protein_rows) AS x) AS v
  JOIN protein_domains AS d ON v.region = d.region
    AND (v.a BETWEEN d.domain_start AND d.domain_end OR v.b BETWEEN d.domain_start AND d.domain_end)
  GROUP BY v.id, v.region) AS h ON r.id = h.id AND r.region = h.region""", ("protein_rows", "protein_domains"))
def domain_overlap(spark, sf_dir):
    return v.domain_overlap(fixture(spark, sf_dir, "protein_rows"), fixture(spark, sf_dir, "protein_domains"))


# Reading windows of three to nine million bases around genes, and spread sites.
_WIDE = "SELECT gene_id, 'chr' || CAST(start1 % 3 + 1 AS string) AS contig, start1 * 90 AS low, start1 * 90 + 3000000 + start1 % 7 * 1000000 AS high FROM gtf_genes"
_SPREAD = "SELECT k, chrom AS contig, CAST(pos AS bigint) * 1000 + k % 1000 AS place FROM sites"


@query("interval_overlap", f"""
SELECT w.gene_id, w.contig, w.low, w.high, count(*) AS n_sites, min(s.place) AS first_place, max(s.place) AS last_place
FROM ({_WIDE}) AS w JOIN ({_SPREAD}) AS s ON w.contig = s.contig AND s.place BETWEEN w.low AND w.high
GROUP BY w.gene_id, w.contig, w.low, w.high""", ("gtf_genes", "sites"))
def interval_overlap(spark, sf_dir):
    """Sites within windows of millions of bases; a window is in one or two bins."""
    for table in ("gtf_genes", "sites"):
        fixture(spark, sf_dir, table).createOrReplaceTempView(table)
    pairs = v.overlap_join(spark.sql(_WIDE), spark.sql(_SPREAD), ["contig"], ("low", "high"), ("place", "place"))
    return pairs.groupBy("gene_id", "contig", "low", "high").agg(
        F.count("*").alias("n_sites"), F.min("place").alias("first_place"), F.max("place").alias("last_place"))


@query("protein_position_scores", """
SELECT r.*, s.cpt1_score FROM protein_rows AS r LEFT JOIN position_scores AS s ON r.region = s.region
  AND r.amino_acids = s.amino_acids AND string_split(r.protein_position, '/')[1] = s.prot_pos""",
       ("protein_rows", "position_scores"))
def protein_position_scores(spark, sf_dir):
    return v.protein_position_scores(fixture(spark, sf_dir, "protein_rows"), fixture(spark, sf_dir, "position_scores"))


@query("splice_expression_scores", """
SELECT t.chrom, t.pos, t.ref, t.alt, t.gene, t.feature, s.absplice FROM long_table AS t
LEFT JOIN (SELECT DISTINCT * FROM splice_expression_raw) AS s ON t.chrom = s.chrom AND t.pos = s.pos AND t.ref = s.ref
  AND t.alt = s.alt AND t.gene = s.gene""", ("long_table", "splice_expression_raw"))
def splice_expression_scores(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select(*VARIANT_KEY, "gene", "feature")
    return score_merges.splice_expression_scores(long, fixture(spark, sf_dir, "splice_expression_raw"))


@query("expression_scores", """
SELECT t.id, t.gene AS region, t.feature, s.abexp FROM long_table AS t
LEFT JOIN expression_raw AS s ON t.id = s.id AND t.gene = s.region""", ("long_table", "expression_raw"))
def expression_scores(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", F.col("gene").alias("region"), "feature")
    return score_merges.expression_scores(long, fixture(spark, sf_dir, "expression_raw"))


@query("missense_model_scores", """
SELECT t.id, t.feature, t.gene, s.pai3_score FROM long_table AS t
LEFT JOIN missense_scores AS s ON t.id = s.id AND t.feature = s.feature""", ("long_table", "missense_scores"))
def missense_model_scores(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature", "gene")
    return score_merges.missense_model_scores(long, fixture(spark, sf_dir, "missense_scores"))


@query("regulatory_flags", """
SELECT t.id, t.feature, s.is_promoter, s.is_enhancer FROM long_table AS t LEFT JOIN regulatory_raw AS s ON t.id = s.id""",
       ("long_table", "regulatory_raw"))
def regulatory_flags(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature")
    return score_merges.regulatory_flags(long, fixture(spark, sf_dir, "regulatory_raw"), ["is_promoter", "is_enhancer"])


@query("cohort_maf_from_counts", """
SELECT t.id, t.feature, CAST(s.mac_cohort AS double) / 276000e0 AS maf_cohort FROM long_table AS t
LEFT JOIN allele_counts AS s ON t.id = s.id""", ("long_table", "allele_counts"))
def cohort_maf_from_counts(spark, sf_dir):
    long = fixture(spark, sf_dir, "long_table").select("id", "feature")
    return score_merges.cohort_maf(long, fixture(spark, sf_dir, "allele_counts"), n_samples=138_000)


@query("utr_one_hot", f"SELECT id, gene, utr, {_label_sql(LABELS, '&', 'utr', 'utr')} FROM "
       "(SELECT id, gene, consequence AS utr FROM long_table) AS t", ("long_table",))
def utr_one_hot(spark, sf_dir):
    """The 5'UTR dummies: the same one-hot on another ``&``-separated column."""
    long = fixture(spark, sf_dir, "long_table").select("id", "gene", F.col("consequence").alias("utr"))
    return v.one_hot(long, "utr", "&")
