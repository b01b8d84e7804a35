"""Index and region reads against a scan of the whole file."""

import random

import pytest
from vcf_cases import rows, vcf_text

from varloom.operators.filters import region_filter
from varloom.sources import tabix
from varloom.sources.bgzf import as_member
from varloom.sources.tabix import index_vcf, overlapping_bins, read_regions, region_ranges, smallest_bin
from varloom.sources.vcf import discover_files, read_sites

REGIONS = ["chr1:5000-5100", "chr2", "chr3:700,000-", "chr1:300000000-400000000", "chr9:1-10", "chr2:1-5", "chr1:7777"]


def write_sorted(path, seed, n, member=900, contigs=("chr1", "chr2", "chr10", "chr3")):
    rng = random.Random(seed)
    records = []
    for contig in contigs:
        top = 500_000_000 if contig == "chr1" else 900_000
        places = sorted(rng.randint(1, 9000 if rng.random() < .05 else top) for _ in range(n))
        records += [f"{contig}\t{pos}\t.\t{'A' * rng.choice([1, 1, 1, 3, 40, 20_000 if k % 50 == 0 else 2])}\tG\t.\tPASS\tAC=1;AF=0.{k}" for k, pos in enumerate(places)]
    data = vcf_text(records).encode()
    path.parent.mkdir(parents=True)
    with open(path, "wb") as out:
        for start in range(0, len(data), member):
            out.write(as_member(data[start:start + member]))
        out.write(as_member(b""))
    return len(data)


@pytest.fixture(scope="module", params=[3_000_000, 40_000])
def indexed(spark, tmp_path_factory, request):
    """Two files, their index built from one range each, or from many."""
    root = tmp_path_factory.mktemp(f"tabix{request.param}")
    for k in (1, 2):
        write_sorted(root / "shard-1" / f"subshard-{k}" / "cohort.annotated.vcf.gz", k, 4000, 900 * k)
    files = discover_files(spark, f"{root}/*/*/*.gz")
    assert index_vcf(files, request.param).where("n_bins > 10").count() == 2
    return files, f"{root}/*/*/*.gz"


@pytest.mark.parametrize("regions", [[r] for r in REGIONS] + [REGIONS, ["chr1:5000-5100", "chr1:5050-6000", "chr10:1-100"]], ids=str)
def test_regions_equal_the_filtered_scan(spark, indexed, regions):
    files, glob = indexed
    found = read_regions(spark, files, regions, split_bytes=5000)
    assert rows(found) == rows(region_filter(read_sites(spark, glob), regions))


def test_only_their_ranges_are_read(spark, indexed):
    files, _ = indexed
    whole = sum(r.length for r in files.collect())
    few = region_ranges(files, ["chr1:5000-5100", "chr3:800000-800500"]).collect()
    assert 0 < sum(r.bytes for r in few) < whole / 2
    every = region_ranges(files, ["chr1", "chr2", "chr3", "chr10"], split_bytes=40_000).collect()
    assert len(every) > 8 and max(r.bytes for r in every) < whole / 2
    assert region_ranges(files, ["chr5"]).count() == 0


def test_bins_hold_what_overlaps():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = sorted(rng.sample(range(1 << rng.choice([16, 20, 29])), 2))
        c, d = sorted(rng.sample(range(1 << rng.choice([16, 20, 29])), 2))
        if a < d and c < b:
            assert any(low <= smallest_bin(a, b) <= high for low, high in overlapping_bins(c, d))
    assert smallest_bin(0, 1) == 4681 and smallest_bin(0, 1 << 29) == 0 and smallest_bin(16383, 16385) == 585


def test_unsorted_files_and_other_indexes_are_refused(spark, tmp_path):
    path = tmp_path / "shard-1" / "subshard-1" / "x.annotated.vcf.gz"
    path.parent.mkdir(parents=True)
    path.write_bytes(as_member(vcf_text(["chr1\t500\t.\tA\tG\t.\tPASS\tAC=1", "chr1\t20\t.\tA\tG\t.\tPASS\tAC=1"]).encode()) + as_member(b""))
    with pytest.raises(Exception, match="coordinate order"):
        index_vcf(discover_files(spark, str(tmp_path / "*/*/*.gz"))).count()
    with pytest.raises(ValueError, match="not a tabix"):
        tabix.ranges_of(b"CSI\1" + b"\0" * 40, ["chr1"])
