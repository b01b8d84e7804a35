"""The whole feature build, stage by stage, each stage a Parquet table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from varloom.functions.keys import VARIANT_KEY
from varloom.functions.names import ANN_COLUMNS
from varloom.operators import scores as score_merges
from varloom.operators.dedupe import variant_metadata
from varloom.operators.fill import fill_nulls
from varloom.operators.row_features import lower_columns, tss_table
from varloom.operators.validate import NullKeyError, WatchedKeys
from varloom.operators.scores import conservation_scores, first_per_transcript, merge_conservation, merge_deleteriousness
from varloom.plans.features import process_vep
from varloom.session import fit_shuffles
from varloom.sources import reference_data, tables
from varloom.sources.sinks import write_annotations, write_table
from varloom.staging import remove_path, staging_scope


EXTRA_SCORES: dict[str, Callable[[DataFrame, DataFrame, Mapping[str, Any]], DataFrame]] = {
    "splice_expression": lambda table, scores, extra: score_merges.splice_expression_scores(table, scores),
    "expression": lambda table, scores, extra: score_merges.expression_scores(table, scores),
    "missense_model": lambda table, scores, extra: score_merges.missense_model_scores(table, scores),
    "regulatory": lambda table, scores, extra: score_merges.regulatory_flags(table, scores, extra["columns"]),
    "cohort_maf": lambda table, scores, extra: score_merges.cohort_maf(table, scores, extra["n_samples"]),
    "promoter": lambda table, scores, extra: score_merges.promoter_scores(table, score_merges.normalise_promoter_scores(scores)),
    "protein_position": lambda table, scores, extra: score_merges.protein_position_scores(table, scores),
    "domains": lambda table, scores, extra: score_merges.domain_overlap(table, scores),
}


@dataclass
class FeatureConfig:
    """Inputs of ``run_pipeline``; a stage whose input is not given is skipped."""

    outdir: str
    gtf: str
    roots: Sequence[str] = ()            # folders of shard-*/subshard-*/annotations.parquet
    published: str | None = None         # or an outdir of convert_release
    substitution_matrix: str | None = None
    fasta: str | None = None
    gene_list: str | None = None
    biotypes: Sequence[str] | None = None
    # Separators inside a cell: of converted tables '&'; ',' and '|' elsewhere.
    consequence_sep: str = "&"
    spliceai_sep: str = "&"
    vocabulary: Sequence[str] | None = None
    sanity_check: bool = False
    conservation: str | None = None
    conservation_value: str = "gpn_score"
    deleteriousness: str | None = None
    deleteriousness_keys: Mapping[str, str] = field(default_factory=lambda: {
        "chrom": "#Chrom", "pos": "Pos", "ref": "Ref", "alt": "Alt", "gene": "GeneID"})
    deleteriousness_columns: Sequence[str] = ()
    dedupe: str | None = None
    # Drop score rows of other variants by a Bloom filter before they are shuffled.
    reduce_scores: bool = False
    # Further merges in this order: kind (a key of EXTRA_SCORES), path of a
    # Parquet table, and what else the kind needs (columns, n_samples).
    extra_scores: Sequence[Mapping[str, Any]] = ()
    fill: Mapping[str, Sequence[Any]] | None = None
    keep: Sequence[str] = ()
    # Build only what was published since the last run into ``outdir``.
    incremental: bool = False


def run_pipeline(spark: SparkSession, config: FeatureConfig) -> DataFrame:
    """Run all configured stages and return the last table.

    Every stage is written before the next reads it. That cuts the lineage, so
    a lost executor repeats part of one stage, and lets the size and skew
    checks of later joins scan a few columns instead of recomputing the table.
    All stages stay on disk, so those that a later one reads are zstd.
    An ``incremental`` build is ``plans.incremental.update_features``.
    """
    if config.incremental:
        from varloom.plans.incremental import update_features

        return update_features(spark, config)
    out = config.outdir.rstrip("/")

    def stage(name: str, build: Callable[[], DataFrame], write: Callable[..., None] = write_annotations) -> DataFrame:
        with staging_scope(spark):
            write(build(), f"{out}/{name}", mode="overwrite")
        return spark.read.parquet(f"{out}/{name}")

    if config.published is not None:
        annotations = without_ann(tables.read_published(spark, config.published).drop("shard", "subshard"))
    else:
        annotations = stage("annotations", lambda: without_ann(tables.concat_annotations(spark, config.roots)))
    fit_shuffles(spark, annotations.count())
    stage("variant_metadata", lambda: variant_metadata(lower_columns(annotations)))

    chunks = None
    if config.fasta is not None:
        chunks = stage("genome_chunks", lambda: reference_data.read_fasta_chunks(spark, config.fasta))
    matrix = None
    if config.substitution_matrix is not None:
        matrix = reference_data.read_substitution_matrix(spark, config.substitution_matrix)
    genes = None if config.gene_list is None else tables.read_gene_list(spark, config.gene_list)

    watched = WatchedKeys(VARIANT_KEY) if config.sanity_check else None
    table = stage("vep_processed", lambda: process_vep(
        annotations, tss_table(reference_data.read_gtf(spark, config.gtf)), matrix, chunks,
        reference_data.DEFAULT_CHUNK, genes, config.biotypes, config.consequence_sep, config.spliceai_sep,
        config.vocabulary, watched=watched))
    if watched is not None:
        try:
            watched.check()
        except NullKeyError:
            remove_path(spark, f"{out}/vep_processed")
            raise
    # One row per variant and transcript, whatever is merged after it.
    table = stage("first_rows", lambda: first_per_transcript(table))

    if config.conservation is not None:
        value = config.conservation_value
        scored = stage("conservation", lambda: conservation_scores(table, spark.read.parquet(config.conservation), value, config.reduce_scores))
        table = stage("pre_deleteriousness", lambda: merge_conservation(table, scored, value))
    if config.deleteriousness is not None:
        scores = tables.normalise_score_keys(
            spark.read.parquet(config.deleteriousness), **config.deleteriousness_keys)
        table = stage("merged", lambda: merge_deleteriousness(
            table, scores, config.deleteriousness_columns, config.dedupe, config.reduce_scores))
    for number, extra in enumerate(config.extra_scores, start=1):
        scores = spark.read.parquet(extra["path"])
        table = stage(f"extra_{number}", lambda: EXTRA_SCORES[extra["kind"]](table, scores, extra))
    if config.fill is not None:
        table = stage("final", lambda: fill_nulls(table, config.fill, config.keep), write_table)
    return table


def without_ann(table: DataFrame) -> DataFrame:
    """The long table without the packed or expanded ANN part: no feature needs it, and it multiplies rows.

    The expanded fields stand behind the variant id; fields of the same name
    before it belong to the other annotation.
    """
    after_id = table.columns.index("ID") if "ID" in table.columns else len(table.columns)
    return table.drop("ANN", *[c for c in table.columns[after_id + 1:] if c in ANN_COLUMNS])
