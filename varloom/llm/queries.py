"""Registered queries of this subpackage; each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from varloom.llm.byte_bpe import bpe_report
from varloom.llm.chat_format import CHAT_SQL, HARD_CASE, chat_report
from varloom.llm.common import read_documents
from varloom.llm.near_duplicates import near_duplicates
from varloom.llm.packing import packed_sequences
from varloom.llm.prefix_trie import TRIE_SQL, prefix_trie
from varloom.llm.quality import QUALITY_SQL, quality_report
from varloom.llm.secrets import secret_report
from varloom.llm.sharding import byte_shards
from varloom.llm.spelling import SPELLING_SQL, spelling_variants
from varloom.llm.spot_signatures import fingerprint_report
from varloom.llm.token_counts import token_counts
from varloom.llm.token_file import token_output
from varloom.llm.url_rules import URL_SQL, judge_urls, rule_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(read_documents(spark, sf_dir), "word_bpe_49k.json", end_id=2)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read_documents(spark, sf_dir))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir), size=3, percent=85)


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(read_documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(read_documents(spark, sf_dir), "byte_bpe_50k.json", end_id=0, size=1024)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_documents(spark, sf_dir), "byte_bpe_50k.json", limit=1024)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_report(read_documents(spark, sf_dir), "byte_bpe_multi_50k.tiktoken")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(read_documents(spark, sf_dir), shards=8)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_documents(spark, sf_dir))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turns = HARD_CASE
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_report(given.unionByName(spark.createDataFrame([(conv, *t) for t in turns], given.schema)))


QUERIES: dict[str, Query] = {
    "op1_token_output": op1_token_output,
    "op2_secret_scan": op2_secret_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_spot_signatures": op4_spot_signatures,
    "op5_packing": op5_packing,
    "op6_token_counts": op6_token_counts,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_sharding": op8_sharding,
    "op9_url_filter": op9_url_filter,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_format": op13_chat_format,
}

#: DuckDB statements for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op9_url_filter": URL_SQL,
    "op10_quality_rules": QUALITY_SQL,
    "op11_prefix_trie": TRIE_SQL,
    "op12_spelling_variants": SPELLING_SQL,
    "op13_chat_format": CHAT_SQL,
}
