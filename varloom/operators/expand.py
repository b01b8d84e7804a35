"""From one row per site to one row per site and annotation entry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions.keys import known_contig, variant_id
from varloom.functions.names import ANN_COLUMNS, FIXED_TYPES
from varloom.functions.text import missing_to_null, to_number


def null_tokens(df: DataFrame) -> DataFrame:
    """Every text cell that is ``.`` or empty becomes null."""
    return df.select(*[
        missing_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def cast_fixed(df: DataFrame) -> DataFrame:
    """Type POS, QUAL, AC, AN and AF and keep known contigs only; failures are null."""
    present = set(df.columns)
    casts = {c: to_number(F.col(c), t) for c, t in FIXED_TYPES.items() if c in present}
    return df.withColumns({**casts, "CHROM": known_contig(F.col("CHROM"))})


def add_variant_id(df: DataFrame, name: str = "ID") -> DataFrame:
    c = {k.lower(): k for k in df.columns}
    return df.withColumn(name, variant_id(*[F.col(c[k]) for k in ("chrom", "pos", "ref", "alt")]))


def _exploded(df: DataFrame, kept: Sequence[str], entries: Column) -> DataFrame:
    """One row per entry of ``a|b,c|d`` with its subfields as ``_parts``.

    Each entry is split once, as the only row of a second generator: a split in
    a projection would be repeated for every output column, and one in a lambda
    over the entries is interpreted.
    """
    listed = df.select(*kept, entries.alias("_entry"))
    return listed.select(*kept, F.explode(F.array(F.split("_entry", r"\|", -1))).alias("_parts"))


def expand_csq(df: DataFrame, names: Sequence[str], col: str = "CSQ") -> DataFrame:
    """One row per entry of ``col``, its subfields as columns by position.

    Sites without annotation give no row; short entries are padded with null.
    """
    kept = [c for c in df.columns if c != col]
    annotated = df.where(missing_to_null(F.col(col)).isNotNull())
    exploded = _exploded(annotated, kept, F.explode(F.split(col, ",")))
    return exploded.select(*kept, *[
        missing_to_null(F.get("_parts", F.lit(i))).alias(name) for i, name in enumerate(names)
    ])


def expand_ann(df: DataFrame, col: str = "ANN", names: Sequence[str] = ANN_COLUMNS) -> DataFrame:
    """One row per ANN entry next to the raw column, for names not yet taken.

    A row without ANN stays, with null fields. On a table already expanded by
    CSQ this pairs every CSQ entry with every ANN entry of the site.
    """
    taken = {c.lower() for c in df.columns}
    added = [(i, name) for i, name in enumerate(names) if name.lower() not in taken]
    exploded = _exploded(df, df.columns, F.explode_outer(F.split(col, ",")))
    return exploded.select(*df.columns, *[
        F.nullif(F.get("_parts", F.lit(i)), F.lit("")).alias(name) for i, name in added
    ])
