import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from varloom.functions.keys import CONTIGS, contig_rank, known_contig, variant_id, with_chr, without_chr
from varloom.functions.names import RESERVED_NAMES, columns_md5, sanitise_names, table_columns
from varloom.functions.positions import range_max_int, relative_position
from varloom.functions.sequence import next_inframe_atg, reverse_complement
from varloom.functions.text import info_value, missing_to_null, to_number


def one_column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_names_are_sanitised_and_kept_apart():
    raw = ["cDNA.pos / cDNA.length", "cDNA_pos_cDNA_length", "ID", "***", "AF", "MAX_AF_POPS", "", "Ann"]
    assert sanitise_names(raw) == [
        "cdna_pos_cdna_length", "cdna_pos_cdna_length_2", "id_2", "field", "af_2", "max_af_pops", "field_2", "ann_2"]
    assert {"chrom", "pos", "id", "csq", "ann"} <= RESERVED_NAMES


@given(st.lists(st.text(max_size=8), max_size=12))
def test_sanitised_names_are_unique(raw):
    names = sanitise_names(raw)
    assert len(names) == len(raw) == len(set(names))
    assert not set(names) & RESERVED_NAMES


def test_column_hash_is_md5_of_the_listing(spark):
    columns = table_columns(["allele", "af_2"])
    expected = hashlib.md5(("\n".join(columns) + "\n").encode()).hexdigest()
    df = spark.createDataFrame([(columns,)], "c array<string>")
    assert df.select(columns_md5(F.col("c"))).first()[0] == expected


def test_missing_tokens(spark):
    assert one_column(spark, [".", "", "-", "0", None, ". "], missing_to_null) == [None, None, "-", "0", None, ". "]


def test_numbers_must_be_plain(spark):
    texts = ["1", "-2.5", "1e3", ".5", "12d", "1f", " 1", "0.5,0.001", "x", None, "nan", "1_0", "5."]
    got = one_column(spark, texts, lambda c: to_number(c, "double"))
    assert got[:4] == [1.0, -2.5, 1000.0, 0.5] and got[4:10] == [None] * 6
    assert got[10] != got[10] and got[11:] == [None, 5.0]
    whole = one_column(spark, ["7", "-7", "1.5", "1e3", "99999999999"], lambda c: to_number(c, "int"))
    assert whole == [7, -7, None, None, None]


def test_info_lookup(spark):
    infos = ["AC=3;AN=9", "MLEAC=5;AC=4", "AN=9", "AC=;AN=1", "AC=.", "AC=1;AC=2", "XAC=1;CSQ=a|b,c|d;AC=7", None]
    assert one_column(spark, infos, lambda c: info_value(c, "AC")) == ["3", "4", None, None, None, "1", "7", None]


def test_contigs_and_keys(spark):
    assert len(CONTIGS) == 25
    assert one_column(spark, ["chr1", "chrM", "chrUn", "1"], known_contig) == ["chr1", "chrM", None, None]
    assert one_column(spark, ["chr1", "chrX", "chrM", "chrUn", None], contig_rank) == [1, 23, 25, None, None]
    assert one_column(spark, ["1", "chr1", "cX"], with_chr) == ["chr1", "chr1", "chrcX"]
    assert one_column(spark, ["chr1", "X", "hrc2"], without_chr) == ["1", "X", "2"]
    df = spark.createDataFrame([("chr1", 5, "A", "T"), (None, 5, "A", "T"), ("chr1", 5, None, "T")],
                               "c string, p long, r string, a string")
    got = df.select(variant_id(F.col("c"), F.col("p"), F.col("r"), F.col("a"))).collect()
    assert [r[0] for r in got] == ["chr1:5:A:T", None, None]


def largest_number(value):
    """The rule in words: the number itself, else the largest digit run between hyphens."""
    if value.lstrip("+-").isdigit() and len(value) - len(value.lstrip("+-")) <= 1:
        return int(value)
    found = [int(part) for part in value.split("-") if part.isdigit()]
    return max(found) if found else None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-?", min_size=1, max_size=9), min_size=20, max_size=40))
def test_range_maximum(spark, values):
    assert one_column(spark, values, range_max_int) == [largest_number(v) for v in values]


def test_relative_position(spark):
    values = ["10-12/900", "?-15/900", "?/900", "3", "5/0", "5/x", None, "/9", "285/1000", "1/3"]
    assert one_column(spark, values, relative_position) == [
        0.01, 0.02, None, None, None, None, None, None, 0.28, 0.33]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ATGatg", max_size=60), min_size=20, max_size=40))
def test_next_atg(spark, sequences):
    expected = [next((i for i in range(3, len(s) - 2, 3) if s[i:i + 3] == "ATG"), -1) for s in sequences]
    assert one_column(spark, sequences, next_inframe_atg) == expected


def test_next_atg_of_a_long_sequence(spark):
    far = "C" * 300_000 + "ATG"
    assert one_column(spark, [far, "C" + far, None], next_inframe_atg) == [300_000, -1, None]


@pytest.mark.parametrize("seq, expected", [("ACGTN", "NACGT"), ("aCg", "cGt"), ("", "")])
def test_reverse_complement(spark, seq, expected):
    assert one_column(spark, [seq], reverse_complement) == [expected]
