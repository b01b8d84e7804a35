"""Variant-annotation tables on Spark: conversion, features, score merges."""

from varloom.operators.bloom import bloom_filter, bloom_reduced_join, might_match
from varloom.operators.coverage import annotation_gap
from varloom.operators.dedupe import distinct_rows, keep_first, variant_metadata
from varloom.operators.expand import add_variant_id, cast_fixed, expand_ann, expand_csq, null_tokens
from varloom.operators.fill import fill_nulls, select_columns
from varloom.operators.filters import filter_genes, query_filter, region_filter, site_filters
from varloom.operators.intervals import overlap_join
from varloom.operators.joins import balanced_join, join_variants, lookup_join
from varloom.operators.one_hot import label_vocabulary, one_hot
from varloom.operators.row_features import (
    distance_to_tss, length_flags, loftee_flags, lower_columns, relative_cds_position, spliceai_delta,
    substitution_score, tss_table, with_maf_cohort, with_region,
)
from varloom.operators.schema_check import (
    SchemaMismatch, check_schema, enforce_one_schema, schema_groups, schema_hashes,
)
from varloom.operators.bucketed import merge_bucketed, store_bucketed
from varloom.operators.scores import (
    cohort_maf, conservation_scores, domain_overlap, downcast_doubles, expression_scores, merge_deleteriousness,
    merge_pre_deleteriousness, merge_scores, missense_model_scores, promoter_scores, protein_position_scores,
    regulatory_flags, splice_expression_scores,
)
from varloom.operators.start_lost import fetch_sequences, start_lost_distance, window_distances
from varloom.operators.validate import (
    CardinalityError, NullKeyError, assert_no_nulls, duplicate_keys, null_counts, rows_with_duplicate_keys,
    validate_join,
)
from varloom.plans.convert import convert_annotations, convert_release
from varloom.plans.features import process_vep
from varloom.plans.incremental import read_features, update_features
from varloom.plans.pipeline import FeatureConfig, run_pipeline
from varloom import staging
from varloom.session import build_session
from varloom.sources.fasta_index import fetch_indexed, index_fasta, read_fasta_index
from varloom.sources.reference_data import read_fasta_chunks, read_gtf, read_substitution_matrix
from varloom.sources.sinks import publish_annotations, unpublished, write_annotations
from varloom.sources.tables import (
    concat_annotations, normalise_score_keys, read_all_string_tsv, read_gene_list, read_published,
)
from varloom.sources.tabix import index_vcf, read_regions, region_ranges
from varloom.sources.vcf import discover_files, list_fields, read_field_names, read_sites
