"""Merging external score tables into the annotation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.keys import VARIANT_KEY, without_chr
from varloom.functions.positions import slash_part
from varloom.operators.bloom import bloom_filter, bloom_reduced_join, might_match
from varloom.operators.dedupe import keep_first
from varloom.operators.intervals import overlap_join
from varloom.operators.joins import balanced_join, membership_join
from varloom.operators.row_features import lower_columns
from varloom.operators.validate import validate_join
from varloom.staging import staged


def downcast_doubles(df: DataFrame) -> DataFrame:
    """Every double column as float."""
    return df.select(*[
        F.col(f"`{c}`").cast("float").alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes
    ])


def conservation_scores(df: DataFrame, scores: DataFrame, value: str = "gpn_score", reduce: bool = False) -> DataFrame:
    """Score of every distinct variant of ``df``: the variant key, ``id`` and ``value``.

    Contigs are compared without prefix and case. Variants without a score
    keep a null. With ``reduce`` a Bloom filter of the variants drops most
    other score rows before the shuffle.
    """
    def contig(column: str):
        return F.lower(without_chr(F.col(column)))

    variants = df.select("id", *VARIANT_KEY).distinct().withColumn("_contig", contig("chrom"))
    right = scores.select(
        contig("chrom").alias("_contig"), F.col("pos").cast("bigint").alias("pos"), "ref", "alt", value
    )
    keys = ["_contig", "pos", "ref", "alt"]
    if reduce:
        return bloom_reduced_join(staged(variants), right, keys, left_unique=True)[0].drop("_contig")
    return balanced_join(variants, right, keys, left_unique=True).drop("_contig")


def merge_scores(df: DataFrame, scores: DataFrame, on: Sequence[str], cardinality: str = "m:1",
                 validate: bool = True) -> DataFrame:
    """Left join of a score table after checking the cardinality of the key.

    Without ``validate`` the caller vouches for it. Rows are the same either
    way; a right side of unique keys only needs no search for heavy ones,
    which would compute it twice more.
    """
    clashes = sorted((set(scores.columns) - set(on)) & set(df.columns))
    if clashes:
        raise ValueError(f"score columns already present: {clashes}")
    if validate:
        validate_join(df, scores, on, cardinality)
    return balanced_join(df, scores, on, "left", right_unique=cardinality.endswith(":1"))


def first_per_transcript(df: DataFrame) -> DataFrame:
    """One row per variant and transcript, nearest start first.

    After the full-row distinct few keys repeat, so only their rows are ranked
    and shuffled; of the others 16 bytes each. Reads ``df`` three times, so pass
    a stored table.
    """
    return keep_first(df, ["id", "feature"], [F.asc_nulls_last("dist_to_tss")], rare_copies=True)


def merge_pre_deleteriousness(df: DataFrame, conservation: DataFrame, value: str = "gpn_score") -> DataFrame:
    """One row per variant and transcript, nearest start first, with its score."""
    # Stored, since the search for heavy keys reads it as well as the join.
    return merge_conservation(staged(first_per_transcript(df)), conservation, value)


def merge_conservation(df: DataFrame, conservation: DataFrame, value: str = "gpn_score") -> DataFrame:
    """Left join of ``conservation_scores``; several score rows for one variant give several rows.

    A genome-wide score file may list a variant again, as do files stacked from
    overlapping pieces, and that is no reason to refuse it.
    """
    return merge_scores(df, conservation.select(*VARIANT_KEY, value), VARIANT_KEY, "m:m")


def merge_deleteriousness(df: DataFrame, scores: DataFrame, columns: Sequence[str],
                          dedupe: str | None = None, reduce: bool = False) -> DataFrame:
    """Left join of per-variant, per-gene scores; doubles become floats.

    ``scores`` is keyed by ``normalise_score_keys``. Several score rows for one
    key give several rows unless ``dedupe='max'`` keeps the largest values.
    Only score rows of genes at hand are kept, or with ``reduce`` those that a
    Bloom filter of the whole key lets pass; they are written once, since the
    search for heavy keys reads them as well as the join.
    """
    keys = [*VARIANT_KEY, "region"]
    wanted = sorted({c.lower() for c in columns} & set(scores.columns) - {*keys, "id"})
    clashes = sorted(set(wanted) & set(df.columns))
    if clashes:
        raise ValueError(f"score columns already present: {clashes}")
    # Most of a genome-wide score table lies outside the genes or variants at hand.
    if reduce:
        small = staged(might_match(scores.select(*keys, *wanted), bloom_filter(df, keys)))
    else:
        small = staged(membership_join(scores.select(*keys, *wanted), df.select("region"), "region"))
    if dedupe == "max":
        small = small.groupBy(*keys).agg(*[F.max(c).alias(c) for c in wanted])
    elif dedupe is not None:
        raise ValueError(f"dedupe must be None or 'max', not {dedupe!r}")
    joined = balanced_join(df, small, keys, "left", right_unique=dedupe == "max")
    return downcast_doubles(lower_columns(joined))


# ── Merges the reference keeps switched off ────────────────────────────────


def splice_expression_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Per variant and gene; exact copies of a score row count once."""
    return merge_scores(df, lower_columns(scores).distinct(), [*VARIANT_KEY, "gene"], "m:1")


def expression_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Per variant id and region; the score table's own position columns are dropped."""
    return merge_scores(df, scores.drop(*VARIANT_KEY), ["id", "region"], "m:1")


def missense_model_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    return merge_scores(df, scores, ["id", "feature"], "m:1")


def regulatory_flags(df: DataFrame, flags: DataFrame, columns: Sequence[str]) -> DataFrame:
    return merge_scores(df, flags.select("id", *columns), ["id"], "m:1")


def cohort_maf(df: DataFrame, counts: DataFrame, n_samples: int) -> DataFrame:
    """``maf_cohort`` from allele counts ``id, mac_cohort`` of ``n_samples`` samples."""
    maf = counts.select("id", (F.col("mac_cohort") / F.lit(2.0 * n_samples)).alias("maf_cohort"))
    return merge_scores(df.drop("maf_cohort"), maf, ["id"], "m:1")


def normalise_promoter_scores(scores: DataFrame) -> DataFrame:
    """Promoter scores as their file lays them out, keyed by variant id and gene id."""
    key = F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", "alt")
    return scores.select(key.alias("id"), F.col("gene_id").alias("gene"), F.col("promoterAI").alias("promoterai"))


def promoter_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """The promoter score of largest magnitude per variant and gene, sign kept.

    Of ``x`` and ``-x`` the positive one is taken. Needs only the extremes, so
    repeated keys collapse before the shuffle.
    """
    low, high = F.min("promoterai"), F.max("promoterai")
    best = scores.groupBy("id", "gene").agg(
        F.when(high >= -low, high).otherwise(low).alias("promoterai")
    )
    return merge_scores(df, best, ["id", "gene"], "m:1", validate=False)


def protein_position_scores(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores by region, amino acids and the first part of ``protein_position``."""
    if not {"protein_position", "amino_acids"} <= set(df.columns):
        return df
    keyed = df.withColumn("prot_pos", slash_part(F.col("protein_position"), 0))
    return balanced_join(keyed, scores, ["region", "amino_acids", "prot_pos"], "left").drop("prot_pos")


# The flag columns of a domain table.
DOMAIN_FLAGS = (
    "mobi_full_disorder_priority", "mobi_curated_disorder_priority", "mobi_full_lip_priority",
    "ted_domain", "low_complexity_domain",
)


def domain_overlap(df: DataFrame, domains: DataFrame, flags: Sequence[str] = DOMAIN_FLAGS) -> DataFrame:
    """Does a variant's protein start or end lie in a domain, by ``id`` and ``region``.

    A flag is the maximum over the domains hit by any row of the variant and
    region, false if none. The distinct residues asked for meet the domains by
    hierarchical bins, and each is reduced to one row of flags before it goes
    back to the variants, so neither a hot region nor a domain of any length is
    paired off in full. The flags of a variant are aggregated where the last join
    needs them, so they are exchanged once and not stored.
    """
    if "protein_position" not in df.columns:
        return df
    span = F.split(slash_part(F.col("protein_position"), 0), "-")
    start = F.get(span, F.lit(0))
    ends = F.array(start, F.coalesce(F.get(span, F.lit(1)), start))
    hits = (
        df.where("protein_position is not null")
        .select("id", "region", F.explode(F.array_distinct(ends)).alias("residue"))
        .withColumn("residue", F.expr("try_cast(residue as int)"))
        .dropna()
    )
    hits = staged(hits)
    asked = hits.select("region", "residue").distinct()
    per_residue = (overlap_join(asked, domains.select("region", "domain_start", "domain_end", *flags), ["region"], ("residue", "residue"), ("domain_start", "domain_end"))
                   .groupBy("region", "residue").agg(*[F.max(f).alias(f) for f in flags]))
    per_variant = (balanced_join(hits, per_residue, ["region", "residue"], "inner", right_unique=True).groupBy("id", "region")
                   .agg(*[F.max(f).alias(f) for f in flags]))
    merged = balanced_join(df, per_variant, ["id", "region"], right_unique=True)
    return merged.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})
