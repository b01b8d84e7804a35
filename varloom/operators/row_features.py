"""Features computed from one row of the long table, without any shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.positions import relative_position
from varloom.functions.text import to_number
from varloom.operators.joins import lookup_join


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names; raises if two become equal."""
    lowered = [c.lower() for c in df.columns]
    repeated = sorted({c for c in lowered if lowered.count(c) > 1})
    if repeated:
        raise ValueError(f"columns differ only in case: {repeated}")
    return df.toDF(*lowered)


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("tinyint")


def loftee_flags(df: DataFrame) -> DataFrame:
    """High/low confidence loss-of-function flags and their missing indicators."""
    lof = F.col("lof")
    return df.withColumns({
        "loftee_hc": _flag(lof == "HC"),
        "loftee_hc_is_na": _flag(lof.isNull()),
        "loftee_lc": _flag(lof == "LC"),
        "loftee_lc_is_na": _flag(lof.isNull()),
    })


def with_maf_cohort(df: DataFrame, mac: str | None = None, n_samples: int | None = None) -> DataFrame:
    """``maf_cohort`` from ``af``, or from an allele count over ``2 * n_samples``."""
    if mac is not None and n_samples is not None:
        return df.withColumn("maf_cohort", F.col(mac) / F.lit(2.0 * n_samples))
    return df.withColumn("maf_cohort", F.col("af"))


def relative_cds_position(df: DataFrame) -> DataFrame:
    """Position within the coding sequence, 0 to 1; null without gene or variant id."""
    keyed = F.col("id").isNotNull() & F.col("gene").isNotNull()
    return df.withColumn("relative_cds_position", F.when(keyed, relative_position(F.col("cds_position"))))


def spliceai_delta(df: DataFrame, sep: str = "|") -> DataFrame:
    """Largest of the four delta scores; replaces ``spliceai_pred`` if present."""
    if "spliceai_pred" not in df.columns:
        return df
    scores = F.slice(F.split("spliceai_pred", re.escape(sep), -1), 2, 4)
    numbers = F.transform(scores, lambda v: to_number(v, "float"))
    return df.withColumn("spliceai_delta_score", F.array_max(numbers)).drop("spliceai_pred")


def substitution_score(df: DataFrame, matrix: DataFrame) -> DataFrame:
    """Score of an amino-acid exchange written ``A/R``; null for anything else."""
    if "amino_acids" not in df.columns:
        return df
    pattern = r"^([A-Z])/([A-Z])$"
    pairs = matrix.select(F.concat_ws("/", "ref_aa", "alt_aa").alias("_pair"), "blosum62")
    keyed = df.withColumn("_pair", F.when(F.col("amino_acids").rlike(pattern), F.col("amino_acids")))
    return lookup_join(keyed, pairs, ["_pair"]).drop("_pair")


def length_flags(df: DataFrame) -> DataFrame:
    """Longest allele and indel flags; any allele over one base counts as indel."""
    ref, alt = F.length("ref"), F.length("alt")
    longest = F.greatest(ref, alt)
    return df.withColumns({
        "variant_length": longest,
        "is_indel": (longest > 1).cast("tinyint"),
        "is_insertion": (ref < alt).cast("tinyint"),
        "is_deletion": (ref > alt).cast("tinyint"),
    })


def with_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", F.col("gene"))


# ── Transcription start ────────────────────────────────────────────────────


def tss_table(gtf: DataFrame) -> DataFrame:
    """Transcription start per protein-coding gene: ``region, tss, strand_right, gene_length``.

    Positions are 0-based half-open. A gene annotated on two contigs keeps the
    copy with the smallest contig name and start.
    """
    start0 = F.col("start1") - 1
    genes = gtf.where("gene_type = 'protein_coding' and feature = 'gene'").select(
        F.get(F.split("gene_id", r"\."), F.lit(0)).alias("region"),
        F.struct(
            F.col("seqname"), start0.alias("start0"),
            F.when(F.col("strand") == "+", start0).otherwise(F.col("end1")).alias("tss"),
            F.col("strand").alias("strand_right"),
            (F.col("end1") - start0 + 1).alias("gene_length"),
        ).alias("copy"),
    )
    return genes.groupBy("region").agg(F.min("copy").alias("copy")).select(
        "region", "copy.tss", "copy.strand_right", "copy.gene_length"
    )


def distance_to_tss(df: DataFrame, tss: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Signed distance from the gene's transcription start, along its strand; ``counted`` is as in ``balanced_join``."""
    joined = lookup_join(df, tss, ["region"], counted=counted)
    downstream = F.col("pos") - F.col("tss")
    signed = F.when(F.col("strand_right") == "+", downstream).otherwise(-downstream)
    return joined.withColumn("dist_to_tss", signed)
