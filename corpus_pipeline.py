"""A training corpus from raw documents: the stages, and the whole run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.near_duplicates import keep_one_of_each
from varloom.llm.packing import packed_sequences
from varloom.llm.quality import quality_filter
from varloom.llm.secrets import redact
from varloom.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Sequences of the packed corpus, and the id that ends each document.
SEQUENCE_TOKENS = 1024
TOKENIZER, END_ID = "byte_bpe_50k.json", 50256


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return keep_one_of_each(docs, size=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by the kind of secret."""
    return redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their token ids."""
    return packed_sequences(docs, TOKENIZER, END_ID, SEQUENCE_TOKENS, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing),
]

#: Token packing has no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
