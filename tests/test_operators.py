"""Edge cases of the table operators, with expected values worked out by hand."""

import logging
import random

import pytest
from pyspark.sql import functions as F

import varloom as v
from vcf_cases import rows
from varloom.operators.one_hot import label_vocabulary
from varloom.operators.scores import DOMAIN_FLAGS, cohort_maf, expression_scores
from varloom.operators.start_lost import WINDOW, with_windows


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# ── Labels ─────────────────────────────────────────────────────────────────


def test_one_hot_separators_and_missing_labels(spark):
    df = frame(spark, "i int, consequence string", (1, "a&b"), (2, "b"), (3, None), (4, ""), (5, "a&&b"))
    by_and = v.one_hot(df, "consequence", "&")
    assert by_and.columns == ["i", "consequence", "consequence_a", "consequence_b"]
    assert rows(by_and.drop("consequence")) == [(1, 1, 1), (2, 0, 1), (3, None, None), (4, None, None), (5, 1, 1)]
    assert dict(by_and.dtypes)["consequence_a"] == "tinyint"
    assert v.one_hot(df, "consequence").columns[2:] == ["consequence_a&&b", "consequence_a&b", "consequence_b"]
    assert v.one_hot(df, "consequence", "&", ["b", "zz"], prefix="p").columns[2:] == ["p_b", "p_zz"]


def test_one_hot_refuses_clashes_and_floods(spark):
    df = frame(spark, "x string, x_b string", ("A|a", "1"), ("b", "2"))
    with pytest.raises(ValueError, match="x_a"):
        v.one_hot(df.select("x"), "x", "|")
    with pytest.raises(ValueError, match="x_b"):
        v.one_hot(df, "x", "|", ["b"])
    with pytest.raises(ValueError, match="more than 1 labels"):
        label_vocabulary(df, "x", "|", max_labels=1)


# ── Row features ───────────────────────────────────────────────────────────


def test_lower_columns(spark):
    df = frame(spark, "A int, b int", (1, 2))
    assert v.lower_columns(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="only in case"):
        v.lower_columns(frame(spark, "a int, b int", (1, 2)).toDF("x", "X"))


def test_loftee_treats_null_as_missing(spark):
    df = frame(spark, "lof string", ("HC",), ("LC",), ("OS",), (None,))
    got = v.loftee_flags(df).select("loftee_hc", "loftee_hc_is_na", "loftee_lc", "loftee_lc_is_na").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0), (0, 0, 1, 0), (0, 0, 0, 0), (0, 1, 0, 1)]


def test_spliceai_separators(spark):
    df = frame(spark, "spliceai_pred string", ("S|0.1|0.9|.|0.2|7",), ("S|.|.",), (None,), ("S",))
    got = [r[0] for r in v.spliceai_delta(df).collect()]
    assert got[0] == pytest.approx(0.9) and got[1:] == [None, None, None]
    assert [r[0] for r in v.spliceai_delta(df, "&").collect()] == [None] * 4
    assert v.spliceai_delta(df).columns == ["spliceai_delta_score"]
    assert v.spliceai_delta(df.select(F.lit(1).alias("x"))).columns == ["x"]


def test_substitution_pairs(spark):
    matrix = frame(spark, "ref_aa string, alt_aa string, blosum62 float", ("A", "R", -1.0), ("R", "A", -1.0))
    df = frame(spark, "amino_acids string", ("A/R",), ("A",), ("AA/R",), ("A/*",), (None,))
    assert [r.blosum62 for r in v.substitution_score(df, matrix).collect()] == [-1.0, None, None, None, None]


def test_length_flags(spark):
    df = frame(spark, "ref string, alt string", ("A", "G"), ("A", "AT"), ("ACG", "A"), ("AC", "GT"), (None, "A"))
    got = v.length_flags(df).select("variant_length", "is_indel", "is_insertion", "is_deletion").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0), (2, 1, 1, 0), (3, 1, 0, 1), (2, 1, 0, 0), (1, 0, None, None)]


def test_relative_position_needs_its_keys(spark):
    df = frame(spark, "id string, gene string, cds_position string", ("i", "g", "1/4"), (None, "g", "1/4"), ("i", None, "1/4"))
    assert [r.relative_cds_position for r in v.relative_cds_position(df).collect()] == [0.25, None, None]


def test_distance_follows_the_strand(spark):
    tss = frame(spark, "region string, tss long, strand_right string, gene_length long", ("g", 100, "+", 9), ("h", 100, "-", 9))
    df = frame(spark, "region string, pos long", ("g", 130), ("h", 130), ("x", 130), (None, 130))
    got = v.distance_to_tss(df, tss)
    assert got.columns == ["region", "pos", "tss", "strand_right", "gene_length", "dist_to_tss"]
    assert {r.region: r.dist_to_tss for r in got.collect()} == {"g": 30, "h": -30, "x": None, None: None}


# ── Start-lost ─────────────────────────────────────────────────────────────


@pytest.fixture(scope="module")
def genome():
    random.seed(3)
    return {"chr1": "".join(random.choices("ACGT", k=5000)), "chr2": "".join(random.choices("ACGT", k=300))}


@pytest.fixture(scope="module")
def chunks(spark, genome):
    pieces = [(c, i // 64, s[i:i + 64]) for c, s in genome.items() for i in range(0, len(s), 64)]
    return spark.createDataFrame(pieces, "contig string, chunk long, seq string")


def opposite(seq):
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_windows_are_fetched_from_both_strands(spark, genome, chunks):
    random.seed(5)
    windows = []
    for i in range(200):
        contig = random.choice(["chr1", "chr2"])
        start = random.randrange(len(genome[contig]))
        windows.append((contig, start, start + random.randrange(1, 400), random.choice(["1", "-1"])))
    df = spark.createDataFrame(windows + windows[:50] + [("chr9", 0, 5, "1"), ("chr2", 900, 950, "1")],
                               "w_chrom string, w_start long, w_end long, w_strand string")
    got = {tuple(r)[:4]: r.seq for r in v.fetch_sequences(df, chunks, 64).collect()}
    expected = {}
    for contig, start, end, strand in windows:
        seq = genome[contig][start:end]
        expected[contig, start, end, strand] = opposite(seq) if strand == "-1" else seq
    assert got == expected


def test_start_lost_by_brute_force(spark, genome, chunks):
    random.seed(7)
    table, expected = [], {}
    for i in range(300):
        chrom, strand = random.choice(["chr1", "chr2", "1"]), random.choice(["1", "-1"])
        pos, offset = random.randrange(1, 4900 if chrom != "chr2" else 290), random.randrange(1, 10)
        length = random.choice([3, 30, 300, 900])
        table.append((f"v{i}", f"g{i % 9}", chrom, pos, strand, "A", f"{offset}/{length}", 1))
        start, end = (pos - offset, pos + 100) if strand == "1" else (pos + offset - 1 - length, pos + offset - 1)
        seq = genome["chr1" if chrom == "1" else chrom][max(start, 0):max(end, 0)]
        seq = opposite(seq) if strand == "-1" else seq
        found = next((k for k in range(3, len(seq) - 2, 3) if seq[k:k + 3] == "ATG"), None)
        expected[f"v{i}"] = None if not seq else 1.0 if found is None else found / length
    odd = [("o1", "g", "chr1", 500, "1", "AT", "1/30", 1), ("o2", "g", "chr1", 500, "1", "A", "1/30", 0),
           ("o3", "g", "chr1", 500, "1", "A", "12/30", 1), ("o4", "g", "chr1", 500, "1", "A", "3", 1),
           ("o5", "g", "chr7", 500, "1", "A", "1/30", 1), ("o6", None, "chr1", 500, "1", "A", "1/30", 1),
           ("o7", "g", "chr1", 500, "1", "A", "?/30", 1), ("o8", "g", "chr1", 500, "1", "A", "1/30", None),
           ("o9", "g", "chr1", 500, "1", None, None, 1)]
    expected.update({row[0]: None for row in odd})
    df = spark.createDataFrame(table + odd, "id string, gene string, chrom string, pos long, strand string, allele string, "
                               "cds_position string, consequence_start_lost int")
    got = {r.id: r.next_in_frame_relative for r in v.start_lost_distance(df, chunks, 64).collect()}
    assert got == expected


def test_start_lost_column_is_always_there(spark):
    df = frame(spark, "id string", ("a",))
    assert v.start_lost_distance(df, None).dtypes == [("id", "string"), ("next_in_frame_relative", "double")]


def test_windows_of_one_site_are_shared(spark):
    df = frame(spark, "id string, gene string, chrom string, pos long, strand string, allele string, cds_position string, "
               "consequence_start_lost int", *[("v", f"g{i}", "chr1", 500, "1", "A", "1/30", 1) for i in range(5)])
    assert with_windows(df).select(*WINDOW).distinct().count() == 1


# ── Keys and duplicates ────────────────────────────────────────────────────


def test_cardinality(spark):
    unique = frame(spark, "k string", ("a",), ("b",), (None,), (None,))
    repeated = frame(spark, "k string", ("a",), ("a",))
    v.validate_join(unique, unique, ["k"], "1:1")
    v.validate_join(repeated, unique, ["k"], "m:1")
    v.validate_join(unique, repeated, ["k"], "1:m")
    for cardinality in ("1:1", "1:m"):
        with pytest.raises(v.CardinalityError, match=r"left side repeats \['k'\].*'a', 2"):
            v.validate_join(repeated, unique, ["k"], cardinality)
    with pytest.raises(v.CardinalityError, match="right side"):
        v.validate_join(unique, repeated, ["k"], "m:1")
    with pytest.raises(ValueError, match="unknown cardinality"):
        v.validate_join(unique, unique, ["k"], "one")


def test_null_keys_are_reported(spark):
    df = frame(spark, "chrom string, pos long", ("a", 1), (None, 2))
    with pytest.raises(v.NullKeyError, match="'chrom': 1"):
        v.assert_no_nulls(df, ["chrom", "pos"])
    assert v.assert_no_nulls(df, ["pos"]) is df


@pytest.mark.parametrize("rare", [False, True])
def test_keep_first_prefers_small_then_breaks_ties(spark, rare):
    df = frame(spark, "id string, feature string, d int, x string",
               ("a", "t", None, "z"), ("a", "t", 5, "y"), ("a", "t", 5, "b"), ("a", "u", None, "q"),
               (None, None, 1, "n"), (None, None, 0, "m"))
    got = v.keep_first(df, ["id", "feature"], [F.asc_nulls_last("d")], rare_copies=rare)
    assert rows(got) == sorted([("a", "t", 5, "b"), ("a", "u", None, "q"), (None, None, 0, "m")], key=repr)


@pytest.mark.parametrize("rare", [False, True])
def test_distinct_drops_copies_only(spark, rare):
    df = frame(spark, "a string, b double", ("x", 1.0), ("x", 1.0), ("x", None), ("x", None), (None, 1.0),
               ("z", 0.0), ("z", -0.0), ("n", float("nan")), ("n", float("nan")))
    assert v.distinct_rows(df, rare).count() == 5
    assert v.distinct_rows(df.limit(1), rare).count() == 1 and v.distinct_rows(df.limit(0), rare).count() == 0


def test_distinct_with_too_many_copies_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr("varloom.operators.dedupe.is_broadcastable", lambda df: False)
    df = spark.range(50).select((F.col("id") % 7).alias("k"), F.lit("c").alias("c"))
    assert v.distinct_rows(df, True).count() == 7
    assert v.keep_first(df, ["k"], [F.asc("c")], rare_copies=True).count() == 7


def test_gene_and_biotype_filters(spark):
    df = frame(spark, "gene string, biotype string", ("g", "p"), ("g", "q"), ("h", "p"), (None, "p"))
    genes = frame(spark, "gene string", ("g",), ("g",))
    assert rows(v.filter_genes(df, genes, ["p"])) == [("g", "p")]
    assert v.filter_genes(df).count() == 4


# ── Score merges ───────────────────────────────────────────────────────────

KEYED = "chrom string, pos long, ref string, alt string, region string"


def test_score_keys_take_any_prefix(spark):
    raw = spark.createDataFrame([("1", 5, "A", "T", "g", 2.0), ("chrX", 6, "A", "T", "g", 3.0)],
                                ["#Chrom", "Pos", "Ref", "Alt", "GeneID", "PHRED"])
    got = v.normalise_score_keys(raw, "#Chrom", "Pos", "Ref", "Alt", "GeneID")
    assert got.columns == ["chrom", "pos", "ref", "alt", "id", "region", "phred"]
    assert [r.id for r in got.collect()] == ["chr1:5:A:T", "chrX:6:A:T"]


def test_deleteriousness_fans_out_unless_told(spark):
    df = frame(spark, KEYED + ", d double", ("chr1", 5, "A", "T", "g", 0.1), ("chr1", 6, "A", "T", "g", 0.2))
    scores = frame(spark, KEYED + ", phred double, raw double",
                   ("chr1", 5, "A", "T", "g", 1.0, 9.0), ("chr1", 5, "A", "T", "g", 3.0, 8.0), ("chr1", 5, "A", "T", "h", 7.0, 7.0))
    assert v.merge_deleteriousness(df, scores, ["PHRED"]).count() == 3
    got = v.merge_deleteriousness(df, scores, ["phred", "raw", "none"], dedupe="max")
    assert {(r.pos, r.phred, r.raw) for r in got.collect()} == {(5, 3.0, 9.0), (6, None, None)}
    assert {t for _, t in got.dtypes} == {"string", "bigint", "float"}
    with pytest.raises(ValueError, match="already present"):
        v.merge_deleteriousness(df.withColumn("phred", F.lit(1)), scores, ["phred"])
    with pytest.raises(ValueError, match="dedupe"):
        v.merge_deleteriousness(df, scores, ["phred"], dedupe="mean")


def test_conservation_ignores_prefix_and_case(spark):
    df = frame(spark, "id string, chrom string, pos long, ref string, alt string",
               ("chrX:5:A:T", "chrX", 5, "A", "T"), ("chrX:5:A:T", "chrX", 5, "A", "T"), (None, None, 5, "A", "T"))
    scores = frame(spark, "chrom string, pos int, ref string, alt string, gpn_score double", ("x", 5, "A", "T", -1.0))
    got = v.conservation_scores(df, scores)
    assert {(r.id, r.gpn_score) for r in got.collect()} == {("chrX:5:A:T", -1.0), (None, None)} and got.count() == 2


def test_merge_scores_checks_the_right_side(spark):
    df = frame(spark, "id string, x int", ("a", 1), ("a", 2), (None, 3))
    with pytest.raises(v.CardinalityError):
        v.merge_scores(df, frame(spark, "id string, s int", ("a", 1), ("a", 2)), ["id"])
    got = v.merge_scores(df, frame(spark, "id string, s int", ("a", 1), (None, 2)), ["id"])
    assert rows(got) == sorted([("a", 1, 1), ("a", 2, 1), (None, 3, None)], key=repr)
    with pytest.raises(ValueError, match="already present"):
        v.merge_scores(df, frame(spark, "id string, x int", ("a", 1)), ["id"])


def test_promoter_keeps_the_largest_magnitude(spark):
    df = frame(spark, "id string, gene string", ("a", "g"), ("b", "g"), ("c", "g"), ("d", "g"))
    scores = frame(spark, "id string, gene string, promoterai double", ("a", "g", 0.2), ("a", "g", -0.9), ("b", "g", 0.5),
                   ("b", "g", -0.5), ("c", "g", -0.1), ("c", "g", None), ("d", "h", 1.0))
    got = {r.id: r.promoterai for r in v.promoter_scores(df, scores).collect()}
    assert got == {"a": -0.9, "b": 0.5, "c": -0.1, "d": None}


def test_domains_by_brute_force(spark):
    random.seed(11)
    domains = []
    for _ in range(60):
        start = random.randrange(1, 400)
        domains.append((f"g{random.randrange(3)}", start, start + random.randrange(200),
                        *[random.random() < 0.4 for _ in DOMAIN_FLAGS]))
    texts = ["5", "?-15", "60-70/300", "?", "-", "128/300", "63-64/9", None, "399-600", "x"]
    table = [(f"v{i % 40}", f"g{i % 4}", random.choice(texts)) for i in range(200)] + [(None, "g1", "5"), ("v1", None, "5")]

    def number(text):
        return int(text) if text is not None and text.isdigit() else None

    expected = {}
    for variant, region, text in table:
        expected.setdefault((variant, region), [False] * len(DOMAIN_FLAGS))
        if None in (variant, region, text):
            continue
        parts = text.split("/")[0].split("-")
        points = {number(parts[0]), number(parts[1] if len(parts) > 1 else parts[0])} - {None}
        for name, start, end, *flags in domains:
            if name == region and any(start <= p <= end for p in points):
                expected[variant, region] = [a or b for a, b in zip(expected[variant, region], flags)]
    df = spark.createDataFrame(table, "id string, region string, protein_position string")
    schema = "region string, domain_start int, domain_end int, " + ", ".join(f"{f} boolean" for f in DOMAIN_FLAGS)
    got = v.domain_overlap(df, spark.createDataFrame(domains, schema))
    assert got.count() == len(table)
    assert {(r.id, r.region): [r[f] for f in DOMAIN_FLAGS] for r in got.collect()} == expected


def test_small_merges(spark):
    df = frame(spark, "id string, region string", ("a", "g"), ("b", "g"))
    scores = frame(spark, "id string, region string, chrom string, pos long, ref string, alt string, s double",
                   ("a", "g", "chr1", 1, "A", "T", 0.5))
    assert rows(expression_scores(df, scores)) == [("a", "g", 0.5), ("b", "g", None)]
    counts = frame(spark, "id string, mac_cohort long", ("a", 3))
    assert rows(cohort_maf(df, counts, 10)) == [("a", "g", 0.15), ("b", "g", None)]
    assert v.protein_position_scores(df, scores) is df and v.domain_overlap(df, scores) is df


# ── Fill ───────────────────────────────────────────────────────────────────


def test_fill_nulls(spark, caplog):
    df = frame(spark, "a double, b int, c string, consequence_x byte, extra int, b_is_na byte",
               (None, 1, None, None, 9, 5), (float("nan"), None, "s", 1, 9, 5))
    with caplog.at_level(logging.WARNING):
        got = v.fill_nulls(df, {"c": ["?"], "a": [0], "b": [7], "extra": [1], "consequence_x": [5]},
                           ["a", "b", "b_is_na", "c", "gone"])
    assert "gone" in caplog.text
    assert got.columns == ["a", "b", "b_is_na", "c", "consequence_x", "c_is_na", "a_is_na"]
    first, second = got.collect()
    assert tuple(first) == (0.0, 1, 0, "?", 0, 1, 1)
    assert second.a != second.a and tuple(second)[1:] == (7, 1, "s", 1, 0, 0)
    assert dict(got.dtypes)["consequence_x"] == "tinyint"
    for value in (0.5, "x"):
        with pytest.raises(ValueError, match="does not fit b"):
            v.fill_nulls(df, {"b": [value]}, ["b"])
    with pytest.raises(ValueError, match="does not fit a"):
        v.fill_nulls(df, {"a": ["x"]}, ["a"])


def test_query_filter_and_downcast(spark):
    df = frame(spark, "max_af string, d double", ("0.001", 1.0), ("0.5", 1.0), ("0.1&0.2", 1.0), (None, 1.0))
    assert v.query_filter(df, "try_cast(max_af as double) < 0.01").count() == 1
    assert v.downcast_doubles(df).dtypes == [("max_af", "string"), ("d", "float")]
