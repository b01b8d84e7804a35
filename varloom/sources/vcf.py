"""Annotated VCF text as a Spark source: file discovery, headers, site records."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from varloom.functions.names import CARRIED, sanitise_names, table_columns
from varloom.functions.text import entry_value, info_entries, missing_to_null

DEFAULT_VCF_NAME = "*.annotated.vcf.gz"

_PARENTS = r"/([^/]+)/([^/]+)/[^/]+$"


def vcf_glob(root: str, shards: str = "shard-*", subshards: str = "subshard-*",
             vcf_name: str = DEFAULT_VCF_NAME) -> str:
    return f"{root.rstrip('/')}/{shards}/{subshards}/{vcf_name}"


def _with_partition_names(df: DataFrame, path: Column) -> DataFrame:
    return df.withColumns({
        "shard": F.regexp_extract(path, _PARENTS, 1),
        "subshard": F.regexp_extract(path, _PARENTS, 2),
    })


def discover_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per matching file: ``path, length, shard, subshard``."""
    try:
        # Only the listing is used: the content column is pruned from the scan.
        files = spark.read.format("binaryFile").load(glob).select("path", "length")
    except AnalysisException as error:
        raise FileNotFoundError(f"no file matches {glob}") from error
    return _with_partition_names(files, F.col("path"))


def read_sites(spark: SparkSession, paths: str | Sequence[str],
               info: Sequence[str] = ("AC", "AN", "AF", "CSQ", "ANN"),
               lines: DataFrame | None = None) -> DataFrame:
    """Site records as text columns, ``shard``/``subshard`` from the parent folders.

    A tag absent from INFO is null. Sample columns, if any, are never split.
    Plain text is read in splits; a ``.gz`` file is one task, so for a few
    large bgzipped files pass ``lines=read_bgzf_lines(...)`` instead.
    """
    if lines is None:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    # Both steps go through a generator of one row: what comes after sees finished cells. In a projection Spark
    # would repeat the splits of a line in each filter and missing-value test built on top of it.
    fields = lines.where(~F.col("value").startswith("#")).select("path", F.explode(F.array(F.split("value", "\t", 9))).alias("f"))
    names = ("CHROM", "POS", None, "REF", "ALT", "QUAL", "FILTER")
    fixed = [F.get("f", F.lit(i)).alias(name) for i, name in enumerate(names) if name]
    padded = fields.select("path", "f", info_entries(F.get("f", F.lit(7))).alias("entries"))
    records = padded.select("path", F.inline(F.array(F.struct(*fixed, *[entry_value(F.col("entries"), tag).alias(tag) for tag in info]))))
    sites = records.select("path", *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in records.columns if c != "path"])
    return _with_partition_names(sites, F.col("path")).drop("path")


# ── Headers ────────────────────────────────────────────────────────────────

_FIELD_NAMES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("shard", T.StringType()),
    T.StructField("subshard", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("raw", T.StringType()),
    T.StructField("name", T.StringType()),
])


# Schemes that Hadoop and Arrow name differently, and those Arrow opens itself.
_SAME_STORE = {"s3a": "s3", "s3n": "s3"}
_ARROW_SCHEMES = ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")


def input_location(path: str) -> tuple[str, bool]:
    """The URI or path that Arrow opens, and whether its own reader knows the scheme."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/", path)
    if scheme is None:
        return path, True
    name = scheme.group(1).lower()
    if name == "file":
        return "/" + path[len("file:"):].lstrip("/"), True
    name = _SAME_STORE.get(name, name)
    return name + path[len(scheme.group(1)):], name in _ARROW_SCHEMES


def _store(path: str):
    from pyarrow import fs

    place, known = input_location(path)
    if known:
        return fs.FileSystem.from_uri(place)
    return fs.HadoopFileSystem.from_uri(re.match(r"[^:]+:(//[^/]*)?", place).group()), place


def open_input(path: str):
    """Open a file by path or URI on an executor, for random access.

    Schemes that Arrow does not know go through the Hadoop client library, as
    Spark's readers do.
    """
    filesystem, inner = _store(path)
    return filesystem.open_input_file(inner)


def open_output(path: str):
    """Open a file for writing, bytes as they are whatever its name ends in."""
    filesystem, inner = _store(path)
    return filesystem.open_output_stream(inner, compression=None)


def subfield_names(description: str) -> list[str]:
    """Names listed in an INFO description: after ``Format:`` or inside quotes."""
    listed = re.search(r"Format:\s*(.*)", description) or re.search(r"'([^']*)'", description)
    if listed is None or not listed.group(1).strip():
        return []
    return [name.strip() for name in listed.group(1).strip(" '\"").split("|")]


def _header_description(path: str, field: str) -> str:
    wanted = re.compile(rf'^##INFO=<ID={re.escape(field)},.*?Description="(.*)"')
    with open_input(path) as raw:
        gzipped = raw.read(2) == b"\x1f\x8b"
        raw.seek(0)
        for line in gzip.GzipFile(fileobj=raw) if gzipped else raw:
            text = line.decode("utf-8", "replace")
            found = wanted.match(text)
            if found:
                return found.group(1)
            if not text.startswith("##"):
                break
    return ""


def read_field_names(files: DataFrame, field: str = "CSQ") -> DataFrame:
    """Subfields of ``field`` per file: ``path, shard, subshard, position, raw, name``.

    ``files`` comes from :func:`discover_files`. Each task reads only the header
    lines of its files. A file without the field yields no row.
    """

    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                raw = subfield_names(_header_description(row.path, field))
                yield pd.DataFrame({
                    "path": row.path, "shard": row.shard, "subshard": row.subshard,
                    "position": pd.Series(range(len(raw)), dtype="int32"),
                    "raw": pd.Series(raw, dtype=object),
                    "name": pd.Series(sanitise_names(raw), dtype=object),
                })

    return files.select("path", "shard", "subshard").mapInPandas(headers, _FIELD_NAMES_SCHEMA)


def list_fields(spark: SparkSession, path: str, field: str = "CSQ") -> DataFrame:
    """Resolved column list of one file, without converting it: ``position, name``."""
    rows = read_field_names(discover_files(spark, path), field).orderBy("position").collect()
    if not rows:
        raise ValueError(f"no {field} subfields in the header of {path}")
    columns = table_columns([r.name for r in rows], field)
    return spark.createDataFrame(list(enumerate(columns)), "position int, name string")


def info_tags(field: str = "CSQ") -> list[str]:
    """INFO tags a conversion of ``field`` needs from each record."""
    return ["AC", "AN", "AF", field, *([CARRIED[field]] if field in CARRIED else [])]
