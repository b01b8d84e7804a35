"""Annotated VCF files to the long annotation table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.names import leading_columns, table_columns
from varloom.operators.coverage import WatchedGap
from varloom.operators.expand import add_variant_id, cast_fixed, expand_ann, expand_csq, null_tokens
from varloom.operators.filters import region_filter, site_filters
from varloom.operators.schema_check import (
    canonical_file, canonical_schema, check_schema, enforce_one_schema, schema_hashes,
)
from varloom.sources import sinks
from varloom.sources.bgzf import DEFAULT_SPLIT, read_bgzf_lines, with_bgzf_flag
from varloom.sources.vcf import (
    DEFAULT_VCF_NAME, discover_files, info_tags, read_field_names, read_sites, vcf_glob,
)
from varloom.staging import staged, staging_scope


def convert_annotations(sites: DataFrame, names: Sequence[str], field: str = "CSQ",
                        max_af: float | None = None, max_ac: int | None = None,
                        region: str | Sequence[str] | None = None, with_ann: bool = True) -> DataFrame:
    """Long table of raw site records: one row per site and entry of ``field``.

    Filters, casts and the variant id run once per site, before the expansion
    multiplies the rows; there is no shuffle. Columns: fixed, carried field,
    ``names``, ``ID``, then the ANN fields not already present. With
    ``with_ann=False`` ANN stays packed.
    """
    leading = leading_columns(field)
    extra = [c for c in sites.columns if c not in leading and c not in ("CSQ", "ANN", field)]
    kept = sites if region is None else region_filter(sites, region)
    kept = site_filters(kept, max_af, max_ac).select(*leading, field, *extra)
    keyed = add_variant_id(cast_fixed(null_tokens(kept)))
    long = expand_csq(keyed, names, field).select(*leading, *names, "ID", *extra)
    if with_ann and "ANN" in leading:
        long = expand_ann(long)
        added = [c for c in long.columns if c not in extra]
        long = long.select(*added, *extra)
    return long


def convert_release(spark: SparkSession, annotation_root: str, outdir: str, field: str = "CSQ",
                    shards: str = "shard-*", subshards: str = "subshard-*", vcf_name: str = DEFAULT_VCF_NAME,
                    max_af: float | None = None, max_ac: int | None = None, with_ann: bool = True,
                    region: str | Sequence[str] | None = None, split_bytes: int = DEFAULT_SPLIT,
                    rows_per_file: int = sinks.ROWS_PER_FILE) -> DataFrame:
    """Convert every file not published yet; returns the schema groups.

    All headers, those of earlier runs included, must agree before any record
    is read. The report is written in either case. The first run notes the
    options and the table's columns; a later run that differs is refused. With
    nothing new, nothing is written.
    """
    options = {"field": field, "max_af": max_af, "max_ac": max_ac, "with_ann": with_ann,
               "region": [region] if isinstance(region, str) else None if region is None else list(region)}
    release = sinks.release_record(spark, outdir)
    if release is not None:
        sinks.same_release(release, options)
    found = discover_files(spark, vcf_glob(annotation_root, shards, subshards, vcf_name))
    published = sinks.published_files(spark, outdir)
    with staging_scope(spark):
        todo = staged(sinks.unpublished(found, published))
        if published is not None and todo.isEmpty():
            return check_schema(published.drop("run"))[0]
        fields = staged(read_field_names(todo, field))
        fresh = schema_hashes(fields, field)
        without = todo.join(fields.select("shard", "subshard").distinct(), ["shard", "subshard"], "left_anti") \
            .select("path").limit(5).collect()
        if without:
            raise ValueError(f"no {field} subfields in the header of {[r.path for r in without]}")

        hashes = fresh if published is None else published.select(*fresh.columns).unionByName(fresh)
        run = uuid.uuid4().hex
        # The report needs its own copy: the staged headers go with this run.
        hashes = sinks.keep_hashes(hashes, outdir, run)
        groups, report = check_schema(hashes)
        names = release["names"] if release is not None else _names_of(fields, fresh)
        sinks.write_schema_report(
            spark, outdir, hashes, groups, canonical_schema(spark, table_columns(names, field)), report)
        enforce_one_schema(hashes)
        sites = read_release(spark, todo, info_tags(field), split_bytes)
        long = convert_annotations(sites, names, field, max_af, max_ac, region, with_ann)
        if release is None:
            sinks.open_release(spark, outdir, options, names, long)
        else:
            sinks.same_release(release, options, long.dtypes)
        # Only the job that writes all rows is watched.
        gap = WatchedGap(field)
        sinks.publish_annotations(convert_annotations(gap.watch(sites), names, field, max_af, max_ac, region, with_ann), outdir, run, rows_per_file)
        sinks.write_column_lists(spark, todo, table_columns(names, field), outdir, run)
        sinks.record_coverage(spark, gap.counts(), outdir, run)
        sinks.record_published(fresh, outdir, run)
    return groups


def read_release(spark: SparkSession, files: DataFrame, info: Sequence[str],
                 split_bytes: int = DEFAULT_SPLIT) -> DataFrame:
    """Site records of discovered files; bgzipped ones over ``split_bytes`` are read in ranges."""
    large = staged(with_bgzf_flag(files.where(F.col("length") > split_bytes)).where("is_bgzf").select("path", "length"))
    small = [row.path for row in files.join(large, "path", "left_anti").select("path").collect()]
    parts = []
    if small:
        parts.append(read_sites(spark, small, info))
    if not large.isEmpty():
        parts.append(read_sites(spark, [], info, read_bgzf_lines(large, split_bytes)))
    return reduce(DataFrame.unionByName, parts)


def _names_of(fields: DataFrame, hashes: DataFrame) -> list[str]:
    """Subfield names of the canonical new file; empty when nothing is new."""
    first = canonical_file(hashes)
    if first is None:
        return []
    rows = fields.where(F.concat_ws("/", "shard", "subshard") == first["name"]).orderBy("position")
    return [row.name for row in rows.select("name").collect()]
