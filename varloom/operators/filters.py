"""Row filters on sites and on the long table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.text import to_number
from varloom.operators.joins import membership_join


def _any_allele(values: Column, test) -> Column:
    """True when some ``,``-separated value passes; missing counts as no."""
    return F.coalesce(F.exists(F.split(values, ","), test), F.lit(False))


def site_filters(sites: DataFrame, max_af: float | None = None, max_ac: int | None = None) -> DataFrame:
    """Drop sites with a ``*`` allele, or with any AF or AC above its limit.

    Works on the raw text columns, so it runs below the expansion of the
    packed annotation. A missing AF or AC never drops a site.
    """
    comma = F.lit(",")
    excluded = F.coalesce(F.concat(comma, F.col("ALT"), comma).contains(",*,"), F.lit(False))
    if max_af is not None:
        excluded = excluded | _any_allele(F.col("AF"), lambda v: to_number(v, "double") > F.lit(float(max_af)))
    if max_ac is not None:
        excluded = excluded | _any_allele(F.col("AC"), lambda v: to_number(v, "bigint") > F.lit(int(max_ac)))
    return sites.where(~excluded)


def parse_region(region: str) -> tuple[str, int | None, int | None]:
    """Contig, first and last position (1-based, both included; None: open)."""
    parsed = re.fullmatch(r"([^:,\s]+)(?::([0-9]+)(-([0-9]*))?)?", region.strip().replace(",", ""))
    if parsed is None:
        raise ValueError(f"not a region: {region!r} (use chr, chr:pos, chr:start- or chr:start-end)")
    chrom, start, dash, end = parsed.groups()
    if start is not None and not dash:
        end = start
    return chrom, int(start) if start is not None else None, int(end) if end else None


def _one_region(region: str) -> Column:
    chrom, start, end = parse_region(region)
    inside = F.col("CHROM") == chrom
    first = to_number(F.col("POS").cast("string"), "bigint")
    if start is not None:
        inside = inside & (first + F.length("REF") - 1 >= F.lit(start))
    return inside if end is None else inside & (first <= F.lit(end))


def region_filter(sites: DataFrame, region: str | Sequence[str]) -> DataFrame:
    """Keep records overlapping ``chr:start-end`` (1-based, both ends included)."""
    regions = [region] if isinstance(region, str) else list(region)
    return sites.where(reduce(lambda a, b: a | b, [_one_region(r) for r in regions]))


def filter_genes(df: DataFrame, genes: DataFrame | None = None, biotypes: Sequence[str] | None = None) -> DataFrame:
    """Keep rows of listed genes (a table with a ``gene`` column) and biotypes."""
    if biotypes is not None:
        df = df.where(F.col("biotype").isin(list(biotypes)))
    if genes is not None:
        df = membership_join(df, genes, "gene")
    return df


def query_filter(df: DataFrame, condition: str) -> DataFrame:
    """Filter by a SQL condition, e.g. ``try_cast(max_af as double) < 0.01``."""
    return df.where(F.expr(condition))
