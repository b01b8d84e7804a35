"""Windows fetched by index against the whole sequence."""

import random

import pytest
from vcf_cases import rows

from varloom.operators.start_lost import WINDOW, fetch_sequences
from varloom.sources.bgzf import as_member
from varloom.sources.fasta_index import fetch_indexed, index_fasta, read_fasta_index
from varloom.sources.reference_data import read_fasta_chunks

LENGTHS = {"chr1": (5003, 60), "chr2": (3, 60), "chrEmpty": (0, 0), "chrX": (2400, 60), "chrOne": (7000, 7000), "chrY": (1001, 7)}


def fasta(newline="\n", ending="\n"):
    rng, parts = random.Random(4), []
    for name, (n, width) in LENGTHS.items():
        seq = "".join(rng.choice("ACGTN") for _ in range(n))
        parts += [f">{name} some words", *[seq[i:i + width] for i in range(0, n, width or 1)]]
    return newline.join(parts) + ending


def write(path, text, gzipped):
    data = text.encode()
    path.write_bytes(b"".join(as_member(data[i:i + 700]) for i in range(0, len(data), 700)) + as_member(b"") if gzipped else data)


def listed(spark, path):
    return spark.createDataFrame([(str(path), path.stat().st_size)], "path string, length long")


@pytest.mark.parametrize("gzipped, split, newline, ending", [(False, 1 << 20, "\n", "\n"), (False, 333, "\n", ""), (False, 61, "\r\n", "\r\n"),
                                                              (True, 1 << 20, "\n", "\n"), (True, 900, "\n", "\n\n")])
def test_windows_equal_the_chunked_genome(spark, tmp_path, gzipped, split, newline, ending):
    path = tmp_path / ("g.fa.gz" if gzipped else "g.fa")
    write(path, fasta(newline, ending), gzipped)
    assert index_fasta(listed(spark, path), split).first().n_contigs == len(LENGTHS)
    index = read_fasta_index(spark, str(path))
    assert {r.contig: (r.bases, r.line_bases) for r in index.collect()} == {c: (n, min(n, width)) for c, (n, width) in LENGTHS.items()}
    rng = random.Random(split)
    windows = [("chr1", 0, 10_000, "1"), ("chr1", 5002, 5003, "-1"), ("chr2", 1, 2, "1"), ("chr9", 1, 2, "1"), ("chrEmpty", 0, 5, "1"), ("chr1", 7, 7, "1"), ("chr1", 9000, 9001, "1")]
    windows += [(c, s, s + rng.randint(1, 300), rng.choice(["1", "-1"])) for c, (n, _) in LENGTHS.items() for s in (rng.randrange(n) for _ in range(20) if n)]
    table = spark.createDataFrame(windows + windows[:5], ", ".join(f"{c} {t}" for c, t in zip(WINDOW, ("string", "long", "long", "string"))))
    plain = tmp_path / "plain.fa"
    plain.write_text(fasta())
    wanted = rows(fetch_sequences(table, read_fasta_chunks(spark, str(plain), 64), 64))
    assert rows(fetch_indexed(table, index)) == wanted and len(wanted) > 80


def test_the_genome_is_not_read_whole(spark, tmp_path):
    path = tmp_path / "g.fa"
    write(path, fasta(), False)
    index_fasta(listed(spark, path)).count()
    table = spark.createDataFrame([("chr1", 5, 9, "1")], f"{WINDOW[0]} string, {WINDOW[1]} long, {WINDOW[2]} long, {WINDOW[3]} string")
    plan = fetch_indexed(table, read_fasta_index(spark, str(path)))._jdf.queryExecution().executedPlan().toString()
    assert "g.fa" not in plan.replace("g.fa.fai", "") and "SortMergeJoin" not in plan


@pytest.mark.parametrize("text", [">a\nACGT\nACG\nACGT\n", ">a\nACGT\nAC\nA\n", ">a\nACGT\n\nACGT\n", "ACGT\n>a\nACGT\n", ">a\nAC\nACGT\n"])
def test_uneven_lines_are_refused(spark, tmp_path, text):
    path = tmp_path / "g.fa"
    path.write_text(text)
    with pytest.raises(Exception, match="equally long|before the first header"):
        index_fasta(listed(spark, path)).count()
