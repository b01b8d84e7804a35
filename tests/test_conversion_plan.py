"""A line and an entry are split once, whatever filters and tests are built on their cells."""

import re

from vcf_cases import rows, vcf_text, write_vcf

import varloom as v


def plan_of(df) -> str:
    return re.sub(r"\(cut\)|\s+", " ", df._jdf.queryExecution().executedPlan().toString())


def test_lines_and_entries_are_split_once(spark, tmp_path):
    records = ["chr1\t5\t.\tA\tG\t.\tPASS\tXAC=9;AC=3;CSQ=G|missense_variant|G1|c.1|0.1,G|stop_lost|G2||;ANN=G|a|b|c",
               "chr1\t6\t.\tA\t*\t.\tPASS\tAC=1;CSQ=G|x|G1||", "chr1\t7\t.\tA\tC\t.\tPASS\tAC=2"]
    write_vcf(tmp_path, "shard-0", "subshard-0", vcf_text(records))
    names = ["allele", "consequence", "gene", "hgvsc", "af_2"]
    long = v.convert_annotations(v.read_sites(spark, f"{tmp_path}/*/*/*.gz"), names, with_ann=False)
    plan = plan_of(long)
    scan = plan[:plan.index("FileScan")]
    assert scan.count("split(value") == 1
    assert scan.count("regexp_extract(entries") == 5
    # No interpreted function over the entries.
    assert "lambda" not in scan and "stringsplitsql" not in scan
    assert [(r[1], r[6], r[11], r[13]) for r in rows(long)] == [(5, 3, "missense_variant", "c.1"), (5, 3, "stop_lost", None)]
