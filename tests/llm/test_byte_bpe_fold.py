"""The tables that the fold of the byte-level BPE looks up."""

import random

from pyspark.sql import functions as F

from varloom.llm import byte_bpe

NAME = "byte_bpe_multi_50k.tiktoken"


def test_pairs_that_are_no_token_have_no_rank(spark):
    ranks = byte_bpe.read_ranks(NAME)
    rng = random.Random(4)
    some = rng.sample(sorted(ranks), 400)
    pairs = [(t[:k], t[k:]) for t in some for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks] + [(a, b) for a, b in zip(some, some[1:])]
    rows = spark.createDataFrame([(ranks[a], ranks[b], ranks.get(a + b)) for a, b in pairs], "l long, r long, wanted long")
    rank = byte_bpe.pair_literal(NAME)
    found = rows.select("wanted", rank(byte_bpe.pair_key(F.col("l"), F.col("r"))).alias("found")).collect()
    assert [r.found for r in found] == [r.wanted for r in found] and {r.found is None for r in found} == {True, False}


def test_every_byte_has_its_id(spark):
    ranks = byte_bpe.read_ranks(NAME)
    word = bytes(range(256))
    assert spark.createDataFrame([(bytearray(word),)], "word binary").select(byte_bpe.byte_ids(F.col("word"), NAME)).first()[0] == [ranks[word[i:i + 1]] for i in range(256)]
