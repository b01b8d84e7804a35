"""Helpers shared by the operators on documents."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.sources.vcf import input_location

#: Where the vocabulary files lie when no path is given.
TOKENIZER_DIR = "/opt/tokenizers"


def tokenizer_path(name: str) -> str:
    """A vocabulary file: a path as it stands, or a bare name in ``TOKENIZER_DIR``."""
    return name if os.sep in name else os.path.join(TOKENIZER_DIR, name)


def shared_store(folder: str):
    """(Arrow file system, path in it) of a folder that Spark wrote, as a worker reaches it; schemes Arrow lacks go through Hadoop's client."""
    from pyarrow import fs

    place, known = input_location(folder)
    if known:
        return fs.FileSystem.from_uri(place if "://" in place else os.path.abspath(place))
    return fs.HadoopFileSystem.from_uri(re.match(r"[^:]+:(//[^/]*)?", place).group()), place


def free_names(taken, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``taken`` has it, whatever the case."""
    lower, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in lower:
            name = f"_{name}"
        out.append(name)
    return out


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator needs, under fixed names; null texts are empty."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))


def crc32_of(ids) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold about ``limit`` bytes; a longer text is alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        yield batch.slice(start)
