"""Token files, counts, packing and byte-level BPE against the tokenizer libraries."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import EDGE_ROWS, sha, texts_of

from varloom.llm import encoding
from varloom.llm.byte_bpe import PATTERN, bpe_report, read_ranks
from varloom.llm.common import tokenizer_path
from varloom.llm.encoding import ChunkEncoder
from varloom.llm.packing import cutting_stock, packed_sequences, price_pattern, sequence_of
from varloom.llm.token_counts import token_counts
from varloom.llm.token_file import BLOCK, TokenFile, TokenFileWriter, pack_blocks, token_output

tokenizers = pytest.importorskip("tokenizers")
tiktoken = pytest.importorskip("tiktoken")

PARTS = ["\0", " ", "\n", "\n\n", " ", "  ", "a", "B", "é", ".", ",", "'s", "1", "<|endoftext|>", "\t", " ", "ß", "İ", "́", "日", "-", "😀"]


def library(name):
    return tokenizers.Tokenizer.from_file(tokenizer_path(name))


def odd_texts(n=1500):
    rng = random.Random(7)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + [t for _, t in texts_of()]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("long_text", [40, 1 << 22])
def test_chunks_give_the_library_ids(name, long_text, monkeypatch):
    monkeypatch.setattr(encoding, "LONG_TEXT", long_text)
    texts = odd_texts()
    ids, ends = ChunkEncoder(name).encode(pa.array(texts))
    wanted = [e.ids for e in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == wanted


@pytest.mark.parametrize("high", [1, 2, 300, 70_000, 2**32 - 1])
def test_blocks_round_trip(high, tmp_path):
    rng = np.random.default_rng(high)
    ids = rng.integers(0, high, 3 * BLOCK + 17, dtype=np.uint32)
    ids[::50] = 2**32 - 1  # outliers for the exception lists
    lengths = np.array([1, BLOCK, len(ids) - BLOCK - 1])
    path = tmp_path / "a.tok"
    with open(path, "wb") as out:
        writer = TokenFileWriter(out)
        writer.add(np.array([3, 5, 9]), lengths, ids)
        writer.close()
    opened = TokenFile.open(path.read_bytes())
    assert opened.doc_ids.tolist() == [3, 5, 9]
    assert np.array_equal(np.concatenate([t for _, _, t in opened.runs(100)]), ids)
    assert np.array_equal(opened.tokens(BLOCK - 5, 2 * BLOCK + 3), ids[BLOCK - 5:2 * BLOCK + 3])
    assert len(pack_blocks(ids)) == 4


def test_an_incomplete_file_is_refused():
    with pytest.raises(ValueError):
        TokenFile.open(b"VLTOKEN2" + bytes(100))


def test_token_output(spark, edge_docs, no_docs):
    found = token_output(edge_docs, "word_bpe_49k.json", 2).collect()
    tok = library("word_bpe_49k.json")
    wanted = Counter()
    for doc, text in texts_of():
        ids = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4")
        wanted[(doc, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == sorted((r.doc_id for r in found), key=lambda d: (d is not None, d or 0))
    assert token_output(no_docs, "word_bpe_49k.json", 2).count() == 0


def test_token_counts(edge_docs, no_docs):
    tok = library("byte_bpe_50k.json")
    wanted = Counter()
    for doc, text in texts_of():
        n = len(tok.encode(text, add_special_tokens=False).ids)
        wanted[(doc, len(text.encode()), n, n > 1024)] += 1
    assert Counter(map(tuple, token_counts(edge_docs, "byte_bpe_50k.json").collect())) == wanted
    assert token_counts(no_docs, "byte_bpe_50k.json").count() == 0


def test_knapsack_and_patterns():
    worth, pattern = price_pattern(np.array([0, 0.2, 0.5, 0]), 7)
    assert worth == pytest.approx(1.2) and pattern.tolist() == [0, 0, 2, 0] or worth == pytest.approx(1.0)
    rng = np.random.default_rng(1)
    histogram = rng.integers(0, 40, 63)
    patterns = cutting_stock(histogram, 64)
    used = np.zeros(63, int)
    for p in patterns:
        assert 0 < p.filled <= 64
        for length, n in p.counts.items():
            used[length - 1] += n * p.runs
    assert (used <= histogram).all()
    assert used.sum() >= 0.8 * histogram.sum()
    assert cutting_stock(np.zeros(63, int), 64) == []


def test_the_end_of_the_line_is_powers_of_two():
    found = [sequence_of(a, 10, 8) for a in range(10)]
    assert found[:8] == [(0, i, 8 - i) for i in range(8)] and found[8:] == [(1, 0, 2), (1, 1, 1)]
    assert [sequence_of(a, 7, 8)[0] for a in range(7)] == [0, 0, 0, 0, 1, 1, 2]


def packing_faults(pieces, wanted, size):
    """Documents are covered exactly once, sequences gapless, and padding only where allowed."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert sum(r.length for r in pieces) == sum(len(ids) for _, ids in wanted)
    return by_doc, padding


@pytest.mark.parametrize("size", [16, 1024])
def test_packing(edge_docs, no_docs, size):
    tok = library("byte_bpe_50k.json")
    wanted = [(d, np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")) for d, t in texts_of()]
    by_doc, padding = packing_faults(packed_sequences(edge_docs, "byte_bpe_50k.json", 0, size).collect(), wanted, size)
    assert padding == 0
    for (doc, n), pieces in by_doc.items():
        same = [ids for d, ids in wanted if d == doc and len(ids) == n]
        assert sum(length for _, length, _ in pieces) == n * len(same)
        if len(same) == 1:
            assert all(zlib.crc32(same[0][s:s + length].tobytes()) == crc for s, length, crc in pieces)
    assert packed_sequences(no_docs, "byte_bpe_50k.json", 0, size).count() == 0


def test_packing_splits_a_hot_length(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('a b ', 5) AS text")
    found = packed_sequences(docs, "byte_bpe_50k.json", 0, 64).collect()
    n = found[0].doc_tokens
    assert sum(r.length for r in found) == 3000 * n and len({r.sequence_id for r in found}) <= 3000 * n // 64 + 7


def test_byte_bpe(spark, edge_docs, no_docs):
    name = "byte_bpe_multi_50k.tiktoken"
    enc = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=read_ranks(name), special_tokens={})

    def wanted(pairs):
        out = Counter()
        for doc, text in pairs:
            ids = enc.encode_ordinary(text)
            out[(doc, len(ids), sha(",".join(map(str, ids))), sha(text))] += 1
        return out

    assert Counter(map(tuple, bpe_report(edge_docs, name).collect())) == wanted(texts_of())
    pairs = list(enumerate(odd_texts(400)))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert Counter(map(tuple, bpe_report(docs, name).collect())) == wanted(pairs)
    assert bpe_report(no_docs, name).count() == 0


def test_edge_rows_are_all_kinds():
    assert any(r[0] is None for r in EDGE_ROWS) and any(r[1] is None for r in EDGE_ROWS)


def test_long_words_are_folded_alike(spark):
    """Both kinds of fold, and the library beyond them, on words around their limits."""
    import random

    from varloom.llm.byte_bpe import CARRIED_FROM, LONGEST_FOLD, encode_word

    import tiktoken

    name = "byte_bpe_multi_50k.tiktoken"
    bpe = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=read_ranks(name), special_tokens={})
    rng = random.Random(3)
    words = ["".join(rng.choice("aeiourstnlé") for _ in range(n)) for n in (1, 2, 20, CARRIED_FROM - 1, CARRIED_FROM, CARRIED_FROM + 1, 200, 900)] + ["z" * 700, " " * 90, "-" * 49]
    table = spark.createDataFrame([(bytearray(w.encode()),) for w in words], "word binary")
    found = {bytes(r.word).decode(): r.ids for r in table.select("word", encode_word(table.word, name).alias("ids")).collect()}
    assert found == {w: bpe._encode_single_piece(w.encode()) for w in words}
    over = spark.createDataFrame([(1, "x" * (LONGEST_FOLD + 5))], "doc_id long, text string")
    assert bpe_report(over, name).first().n_tokens == len(bpe.encode_ordinary("x" * (LONGEST_FOLD + 5)))


def test_byte_bpe_does_not_depend_on_the_input_splits(spark, tmp_path, monkeypatch):
    from varloom.llm import byte_bpe
    from varloom.llm.byte_bpe import decode_ids, encode_documents

    # Many blocks in a task, with words that come back in the next block.
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 3000)

    docs = spark.createDataFrame([(i, f"row {i} été " * (i % 7)) for i in range(4000)], "doc_id long, text string")
    docs.coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "docs"))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "1g")
        built = encode_documents(spark.read.parquet(str(tmp_path / "docs")), "byte_bpe_multi_50k.tiktoken")
        spark.conf.set(setting, "4k")
        decoded = built.select("doc_id", decode_ids(built.ids, "byte_bpe_multi_50k.tiktoken").cast("string").alias("text")).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(map(tuple, decoded)) == sorted(map(tuple, docs.collect()))
