"""Contig names and the variant key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contigs kept in the table, in genomic order.
CONTIGS = tuple([f"chr{n}" for n in range(1, 23)] + ["chrX", "chrY", "chrM"])

VARIANT_KEY = ["chrom", "pos", "ref", "alt"]


def known_contig(chrom: Column) -> Column:
    """The contig if it is one of ``CONTIGS``, else null."""
    return F.when(chrom.isin(*CONTIGS), chrom)


def contig_rank(chrom: Column) -> Column:
    """1-based genomic order of a contig, for sorting; null when unknown."""
    position = F.array_position(F.array(*[F.lit(c) for c in CONTIGS]), chrom)
    return F.nullif(position, F.lit(0)).cast("int")


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """``CHROM:POS:REF:ALT``; null when any part is null."""
    sep = F.lit(":")
    return F.concat(chrom, sep, pos.cast("string"), sep, ref, sep, alt)


def with_chr(chrom: Column) -> Column:
    """Add the ``chr`` prefix where it is absent."""
    return F.regexp_replace(chrom, "^(?!chr)", "chr")


def without_chr(chrom: Column) -> Column:
    """Drop every leading ``c``, ``h`` or ``r``."""
    return F.regexp_replace(chrom, "^[chr]+", "")
