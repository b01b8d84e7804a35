"""The passes over the texts take the words of a batch as one array."""

import random

import numpy as np
import pyarrow as pa
import pytest
import regex

from varloom.llm import byte_bpe

NAME = "byte_bpe_multi_50k.tiktoken"
PARTS = ["cat", "über", "İx", "don't", "12", "a-b", "naïve", "кот", ".", ",", "...", ",.", "", " ", "\n", "\n\n", "\t", "\r", "\0", "　", "é", "x.", "y,"]


def texts():
    rng = random.Random(11)
    made = ["".join(rng.choice(PARTS) + rng.choice(["", " ", " ", "\n", " \n", "  "]) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    plain = [" ".join(rng.choice(["cat", "über", "naïve.", "x,", "\ncat", "\nx."]) for _ in range(9)).replace(" \n", "\n") for _ in range(60)]
    return ["", " ", "\n", "\0", ".", "cat", " cat", "cat\n", "\ncat", "cat ", *made, *plain]


def table(words):
    ids = [np.array(byte_bpe._library(NAME)(w), "<u4") for w in words]
    return byte_bpe.WordTable(pa.array(words, pa.string()), np.concatenate(ids), np.array([len(i) for i in ids]))


@pytest.mark.parametrize("rows", [1, 700])
def test_words_in_arrays_give_the_ids_of_whole_texts(rows):
    known = {w for t in texts() for w in regex.findall(byte_bpe.PATTERN, t)} | {"\n", ".", ","}
    found, listed = table(sorted(known)), []
    chunks = byte_bpe.BlockWords(lambda words: listed.extend(words.to_pylist()) or found.find(words))
    for at in range(0, len(texts()), rows):
        some = texts()[at:at + rows]
        ids, ends = chunks.encode(pa.array(some))
        wanted = [[i for w in regex.findall(byte_bpe.PATTERN, t) for i in byte_bpe._library(NAME)(w)] for t in some]
        assert [r.tolist() for r in np.split(ids, ends)[:-1]] == wanted
    assert set(listed) == known and not chunks and not chunks.spaced


def test_plain_words_are_looked_up_once_for_a_batch():
    calls = []
    found = table(["\n", ".", ",", "cat", " cat", " über"])
    chunks = byte_bpe.BlockWords(lambda words: calls.append(words.to_pylist()) or found.find(words))
    ids, ends = chunks.encode(pa.array(["cat cat.\ncat, über"] * 1000))
    assert len(ends) == 1000 and len(calls) == 1 and len(calls[0]) <= 8
    assert ids[:ends[0]].tolist() == [i for w in ["cat", " cat", ".", "\n", "cat", ",", " über"] for i in byte_bpe._library(NAME)(w)]


def test_a_word_that_is_not_in_the_table_is_an_error():
    with pytest.raises(KeyError):
        byte_bpe.BlockWords(table(["\n", ".", ",", "cat"]).find).encode(pa.array(["cat dog"]))
