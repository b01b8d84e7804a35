"""Variant-annotation tables derived from the driver's parquet tables.

Each table is one SELECT that runs in Spark SQL and in DuckDB, so a query and
its check start from the same rows. An order stands for a site, a lineitem for
one consequence entry, a part for a gene. Where the dialects differ, the entry
is a pair (Spark, DuckDB).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from varloom.session import fit_shuffles
from varloom.staging import staged

BASE_TABLES = ("supplier", "part", "orders", "lineitem")

CSQ_RAW = ["Allele", "Consequence", "Gene", "Feature", "BIOTYPE", "STRAND", "CDS_position",
           "Amino_acids", "LoF", "SpliceAI_pred", "AF"]

_LETTERS = "ARNDC"
_MATRIX_ROWS = ", ".join(
    f"('{r}', '{a}', {(ord(r) * ord(a)) % 9 - 4})" for r in _LETTERS for a in _LETTERS
)

_GENE = "'ENSG' || lpad(CAST({0} AS string), 11, '0')"

FIXTURES: dict[str, str | tuple[str, str]] = {
    "sites": """
SELECT o_orderkey AS k,
  'chr' || CASE WHEN o_orderkey % 27 < 22 THEN CAST(o_orderkey % 27 + 1 AS string)
                WHEN o_orderkey % 27 = 22 THEN 'X' WHEN o_orderkey % 27 = 23 THEN 'Y'
                WHEN o_orderkey % 27 = 24 THEN 'M' WHEN o_orderkey % 27 = 25 THEN '1'
                ELSE 'Un_KI270302v1' END AS chrom,
  CAST(1000 + (o_orderkey * 37) % 200000 AS string) AS pos,
  CASE WHEN o_orderkey % 11 = 0 THEN 'ACG'
       ELSE substr('ACGT', CAST(o_orderkey % 4 + 1 AS int), 1) END AS ref,
  CASE WHEN o_orderkey % 17 = 0 THEN '*' WHEN o_orderkey % 19 = 0 THEN 'G,T'
       WHEN o_orderkey % 23 = 0 THEN 'G,*' WHEN o_orderkey % 7 = 0 THEN 'TTAG'
       ELSE substr('CGTA', CAST(o_orderkey % 4 + 1 AS int), 1) END AS alt,
  CASE WHEN o_orderkey % 10 = 0 THEN '.' ELSE CAST(o_orderkey % 100 AS string) END AS qual,
  CASE WHEN o_orderkey % 6 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter,
  CASE WHEN o_orderkey % 29 = 0 THEN '.' ELSE CAST(o_orderkey % 50 AS string) END AS ac,
  '276000' AS an,
  CASE WHEN o_orderkey % 29 = 0 THEN '.' WHEN o_orderkey % 19 = 0 THEN '0.5,0.001'
       ELSE '0.' || lpad(CAST(o_orderkey % 1000 AS string), 4, '0') END AS af,
  CASE WHEN o_orderkey % 3 = 0 THEN '.'
       WHEN o_orderkey % 3 = 1 THEN 'G|upstream_gene_variant|MODIFIER|NAME' || CAST(o_orderkey % 50 AS string)
       ELSE 'G|intron_variant|MODIFIER||GID|transcript|T1|protein_coding|1/2|c.1A>G||1/900|1/600|1/200|5|,'
            || 'T|stop_gained|HIGH|NAME1' END AS ann
FROM orders""",
    "entry_fields": f"""
SELECT l_orderkey AS k, l_partkey, l_suppkey, l_linenumber,
  substr('ACGT', CAST(l_partkey % 4 + 1 AS int), 1) AS allele,
  CASE l_linenumber % 5 WHEN 0 THEN 'start_lost' WHEN 1 THEN 'missense_variant'
    WHEN 2 THEN 'missense_variant&splice_region_variant' WHEN 3 THEN 'synonymous_variant' ELSE '' END AS consequence,
  CASE WHEN l_partkey % 9 = 0 THEN '' ELSE {_GENE.format('l_partkey')} END AS gene,
  'ENST' || lpad(CAST(l_partkey * 10 + l_linenumber AS string), 11, '0') AS feature,
  CASE l_partkey % 3 WHEN 0 THEN 'protein_coding' WHEN 1 THEN 'lncRNA' ELSE 'processed_pseudogene' END AS biotype,
  CASE l_partkey % 2 WHEN 0 THEN '1' ELSE '-1' END AS strand,
  CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN CAST(l_suppkey % 9 + 1 AS string) || '/' || CAST(l_suppkey % 100 + 300 AS string)
    WHEN 2 THEN '10-12/900' WHEN 3 THEN '?-15/900' ELSE '3' END AS cds_position,
  CASE l_partkey % 4 WHEN 0 THEN 'A/R' WHEN 1 THEN 'R' WHEN 2 THEN 'N/D' ELSE '' END AS amino_acids,
  CASE l_suppkey % 4 WHEN 0 THEN 'HC' WHEN 1 THEN 'LC' WHEN 2 THEN 'OS' ELSE '' END AS lof,
  CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'SYM&0.01&0.2&0.0&.' ELSE 'SYM&.&.&.&.' END AS spliceai_pred,
  '0.0' || CAST(l_linenumber AS string) AS entry_af
FROM lineitem""",
    "csq_entries": """
SELECT k, allele || '|' || consequence || '|' || gene || '|' || feature || '|' || biotype || '|' || strand || '|'
  || cds_position || '|' || amino_acids || '|' || lof || '|' || spliceai_pred || '|' || entry_af AS entry
FROM entry_fields""",
    "csq_blocks": (
        "SELECT k, concat_ws(',', array_sort(collect_list(entry))) AS csq FROM csq_entries GROUP BY k",
        "SELECT k, string_agg(entry, ',' ORDER BY entry) AS csq FROM csq_entries GROUP BY k",
    ),
    "variants": "SELECT s.*, b.csq FROM sites AS s LEFT JOIN csq_blocks AS b ON s.k = b.k",
    # Sites as the conversion leaves them: '*' dropped, typed, unknown contigs null.
    "typed_sites": """
SELECT k, chrom, pos, ref, alt, af,
  chrom || ':' || CAST(pos AS string) || ':' || ref || ':' || alt AS id
FROM (SELECT k, CASE WHEN chrom NOT LIKE 'chrUn%' THEN chrom END AS chrom, CAST(pos AS bigint) AS pos, ref, alt,
        CASE WHEN af NOT LIKE '%,%' AND af <> '.' THEN CAST(af AS double) END AS af
      FROM sites WHERE alt NOT LIKE '%*%') AS s""",
    # The long table of stage one, without the detour over packed text.
    "long_table": """
SELECT s.chrom, s.pos, s.ref, s.alt, s.af, s.id, e.allele, nullif(e.consequence, '') AS consequence,
  nullif(e.gene, '') AS gene, e.feature, e.biotype, e.strand, nullif(e.cds_position, '') AS cds_position,
  nullif(e.amino_acids, '') AS amino_acids, nullif(e.lof, '') AS lof,
  nullif(e.spliceai_pred, '') AS spliceai_pred
FROM typed_sites AS s JOIN entry_fields AS e ON s.k = e.k""",
    "gtf_genes": """
SELECT gene_id, seqname, feature, start1, end1, strand, gene_type FROM (
  SELECT {gene} || '.' || CAST(p_partkey % 5 AS string) AS gene_id, 'chrX' AS seqname,
    CASE WHEN p_partkey % 6 = 5 THEN 'transcript' ELSE 'gene' END AS feature,
    1000 + p_partkey * 90 AS start1, 1000 + p_partkey * 90 + 500 + p_partkey % 300 AS end1,
    CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
    CASE WHEN p_partkey % 8 = 7 THEN 'lncRNA' ELSE 'protein_coding' END AS gene_type
  FROM part
  UNION ALL
  SELECT {gene} || '.' || CAST(p_partkey % 5 AS string) || '_PAR_Y' AS gene_id, 'chrY' AS seqname,
    CASE WHEN p_partkey % 6 = 5 THEN 'transcript' ELSE 'gene' END AS feature,
    1007 + p_partkey * 90 AS start1, 1007 + p_partkey * 90 + 500 + p_partkey % 300 AS end1,
    CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
    CASE WHEN p_partkey % 8 = 7 THEN 'lncRNA' ELSE 'protein_coding' END AS gene_type
  FROM part WHERE p_partkey % 50 = 0) AS g""".replace("{gene}", _GENE.format("p_partkey")),
    "genes_to_keep": f"SELECT {_GENE.format('p_partkey')} AS gene FROM part WHERE p_partkey % 7 <> 0",
    "conservation_raw": """
SELECT CASE WHEN k % 5 = 0 THEN lower(substr(chrom, 4)) ELSE substr(chrom, 4) END AS chrom,
  CAST(pos AS bigint) AS pos, ref, alt, 0e0 - CAST(k % 1000 AS double) / 100e0 AS gpn_score
FROM sites WHERE k % 4 <> 0""",
    "deleteriousness_raw": f"""
SELECT substr(s.chrom, 4) AS chrom, CAST(s.pos AS bigint) AS pos, s.ref, s.alt,
  {_GENE.format('l.l_partkey')} AS geneid,
  CAST(l.l_partkey % 60 AS double) / 2e0 AS phred, CAST(l.l_suppkey % 10 AS double) / 10e0 AS rawscore
FROM sites AS s JOIN lineitem AS l ON s.k = l.l_orderkey WHERE l.l_linenumber % 2 = 0""",
    "substitution_matrix": f"""
SELECT ref_aa, alt_aa, CAST(score AS float) AS blosum62
FROM (VALUES {_MATRIX_ROWS}) AS m(ref_aa, alt_aa, score)""",
    "schema_hash_lines": """
SELECT md5(CASE WHEN s_suppkey % 40 = 3 THEN 'CHROM,POS,extra' ELSE 'CHROM,POS' END) AS hash,
  'shard-' || CAST(s_suppkey % 4 AS string) || '/subshard-' || CAST(s_suppkey AS string) AS name,
  CAST(CASE WHEN s_suppkey % 40 = 3 THEN 3 ELSE 2 END AS int) AS ncols
FROM supplier""",
    # Header subfields of one file per supplier; every 40th file has one more.
    "header_fields": " UNION ALL ".join(
        "SELECT 'shard-' || CAST(s_suppkey % 4 AS string) AS shard, 'subshard-' || CAST(s_suppkey AS string) AS subshard, "
        f"{i} AS position, '{name}' AS name FROM supplier" + (" WHERE s_suppkey % 40 = 3" if name == "extra" else "")
        for i, name in enumerate(["allele", "consequence", "af_2", "extra"])),
    # A genome with a base for every site position: 32 bases per chunk.
    "genome_chunks": (
        """
SELECT contig, chunk,
  translate(md5(contig || ':' || CAST(chunk AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM (SELECT contig, explode(sequence(0L, CAST(last_pos AS bigint) div 32 + 4)) AS chunk
      FROM (SELECT chrom AS contig, max(pos) AS last_pos FROM typed_sites
            WHERE chrom IS NOT NULL GROUP BY chrom) AS c) AS g""",
        """
SELECT contig, chunk,
  translate(md5(contig || ':' || CAST(chunk AS string)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM (SELECT contig, unnest(range(0, last_pos // 32 + 5)) AS chunk
      FROM (SELECT chrom AS contig, max(pos) AS last_pos FROM typed_sites
            WHERE chrom IS NOT NULL GROUP BY chrom) AS c) AS g""",
    ),
    "genotypes": """
SELECT chrom AS CHROM, pos AS POS, ref AS REF, alt AS ALT, 'S' || CAST(k % 7 AS string) AS sample
FROM typed_sites WHERE k % 3 <> 1""",
    "promoter_raw": """
SELECT id, gene, CAST((length(feature) * 7 + l % 41) % 21 - 10 AS double) / 10e0 AS promoterai
FROM (SELECT id, gene, feature, CAST(substr(feature, 5) AS bigint) AS l FROM long_table
      WHERE gene IS NOT NULL) AS t""",
    # Two or three domains per gene, overlapping.
    "protein_domains": " UNION ALL ".join(f"""
SELECT {_GENE.format('p_partkey')} AS region, {start} AS domain_start, {start} + 4 + p_partkey % 90 AS domain_end,
  (p_partkey + {i}) % 2 = 0 AS mobi_full_disorder_priority, (p_partkey + {i}) % 3 = 0 AS mobi_curated_disorder_priority,
  (p_partkey + {i}) % 5 = 0 AS mobi_full_lip_priority, {i} = 1 AS ted_domain, p_partkey % 4 = 0 AS low_complexity_domain
FROM part WHERE {i} < 2 + p_partkey % 2""" for i, start in enumerate([1, 8, 40])),
    "protein_rows": f"""
SELECT id, gene AS region, feature, amino_acids,
  CASE WHEN cds_position = '3' THEN '58-72/300' ELSE cds_position END AS protein_position
FROM long_table""",
    "position_scores": f"""
SELECT {_GENE.format('p_partkey')} AS region, CASE p_partkey % 4 WHEN 0 THEN 'A/R' WHEN 1 THEN 'R' ELSE 'N/D' END AS amino_acids,
  CASE WHEN p_partkey % 3 = 0 THEN '10-12' ELSE '2' END AS prot_pos, CAST(p_partkey % 17 AS double) / 4e0 AS cpt1_score
FROM part""",
    "missense_scores": """
SELECT id, feature, CAST(length(id) AS double) / 8e0 AS pai3_score FROM long_table
WHERE id IS NOT NULL AND consequence LIKE '%missense%' GROUP BY id, feature""",
    "expression_raw": """
SELECT id, gene AS region, min(chrom) AS chrom, min(pos) AS pos, min(ref) AS ref, min(alt) AS alt,
  CAST(count(*) AS double) / 4e0 AS abexp FROM long_table
WHERE id IS NOT NULL AND gene IS NOT NULL GROUP BY id, gene""",
    # Every row twice, as such files come.
    "splice_expression_raw": """
SELECT chrom, pos, ref, alt, gene, absplice FROM (
  SELECT chrom, pos, ref, alt, gene, CAST(min(length(feature)) + count(*) AS double) / 8e0 AS absplice FROM long_table
  WHERE id IS NOT NULL AND gene IS NOT NULL GROUP BY chrom, pos, ref, alt, gene) AS a
UNION ALL
SELECT chrom, pos, ref, alt, gene, absplice FROM (
  SELECT chrom, pos, ref, alt, gene, CAST(min(length(feature)) + count(*) AS double) / 8e0 AS absplice FROM long_table
  WHERE id IS NOT NULL AND gene IS NOT NULL GROUP BY chrom, pos, ref, alt, gene) AS b""",
    "regulatory_raw": """
SELECT id, min(k) % 2 = 0 AS is_promoter, min(k) % 3 = 0 AS is_enhancer FROM typed_sites
WHERE id IS NOT NULL GROUP BY id""",
    "allele_counts": "SELECT id, min(k) % 40 AS mac_cohort FROM typed_sites WHERE id IS NOT NULL GROUP BY id",
}


def _text(name: str, dialect: int) -> str:
    entry = FIXTURES[name]
    return entry if isinstance(entry, str) else entry[dialect]


def _needed(name: str, dialect: int, given: tuple[str, ...], seen: list[str]) -> list[str]:
    for other in FIXTURES:
        if other not in (name, *given, *seen) and re.search(rf"\b{other}\b", _text(name, dialect)):
            _needed(other, dialect, given, seen)
    if name not in seen:
        seen.append(name)
    return seen


def with_tables(query: str, names: list[str], dialect: int = 1, given: tuple[str, ...] = ()) -> str:
    """``query`` preceded by the fixture tables it names (DuckDB by default), except those ``given`` as views."""
    order: list[str] = []
    for name in names:
        if name not in given:
            _needed(name, dialect, given, order)
    tables = ",\n".join(f"{n} AS ({_text(n, dialect).strip()})" for n in order)
    return (f"WITH {tables}\n" if tables else "") + query.strip()


# What earlier stages leave on disk: derived once per session, then read as
# the Parquet tables they stand for.
STORED = ("variants", "long_table")

_SITE_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}

_session_of: dict[str, tuple[str, set[str]]] = {}


def _register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    tables = {table: spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in BASE_TABLES}
    # Counted from the footers.
    partitions = max(fit_shuffles(spark, tables["lineitem"].count()), spark.sparkContext.defaultParallelism)
    for table, df in tables.items():
        # Dealt out once by the key that sites, entries and blocks are joined by, while a row is
        # still a few numbers; the texts made of them need no exchange then.
        if table in _SITE_KEYS:
            df = df.repartition(partitions, _SITE_KEYS[table])
        df.createOrReplaceTempView(table)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a DataFrame over the parquet tables in ``sf_dir``."""
    session = f"{spark.sparkContext.applicationId}-{id(spark)}"
    known_dir, stored = _session_of.get(session, ("", set()))
    if known_dir != sf_dir or not spark.catalog.tableExists(BASE_TABLES[0]):
        stored = set()
        _session_of[session] = (sf_dir, stored)
        _register_base_tables(spark, sf_dir)
    for table in STORED:
        used = table == name or table in _needed(name, 0, (), [])
        if used and table not in stored:
            query = with_tables(f"SELECT * FROM {table}", [table], 0, tuple(stored))
            staged(spark.sql(query)).createOrReplaceTempView(table)
            stored.add(table)
    return spark.sql(with_tables(f"SELECT * FROM {name}", [name], 0, tuple(stored)))
