"""VCF text and files for the tests, and rows in a fixed order."""

import gzip

CSQ_HEADER = ('##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. '
              'Format: {}">\n')
ANN_HEADER = ("##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Annotation | "
              "Annotation_Impact | Gene_Name'\">\n")


def vcf_text(records, subfields="Allele|Consequence|Gene|HGVSc|AF"):
    head = "##fileformat=VCFv4.2\n" + CSQ_HEADER.format(subfields) + ANN_HEADER
    return head + "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + "".join(r + "\n" for r in records)


def write_vcf(root, shard, subshard, text, members=2, name="cohort.annotated.vcf.gz"):
    """A gzip file of several members plus an empty one, as bgzip writes it."""
    folder = root / shard / subshard
    folder.mkdir(parents=True, exist_ok=True)
    data = text.encode()
    step = len(data) // members + 1
    with open(folder / name, "wb") as out:
        for start in range(0, len(data), step):
            out.write(gzip.compress(data[start:start + step]))
        out.write(gzip.compress(b""))
    return folder / name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
