"""Byte-level BPE as Spark higher-order functions over distinct words.

1. Each block of rows lists the distinct words (pattern matches) of its texts.
   A block is some rows of a file by their number, so both passes see the same
   blocks however the file is dealt out to tasks.
2. The distinct words of all blocks are encoded once each: a fold over the
   word's bytes merges, step by step, the leftmost adjacent pair with the
   lowest rank. Every token is a number and every merge a pair of numbers, so
   the literal rank map is lists of pairs and ranks by the pair's remainder.
   Short words look all pairs up at each step; long ones carry the ranks along
   and look up only the two beside a merge.
3. The ids go back to the blocks that have the word, as a Parquet folder for each
   block; a second pass over the texts reads its block's folder and strings the
   ids together. Texts are never exchanged.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, shared_store, text_or_empty, tokenizer_path
from varloom.llm.encoding import LINE, ChunkEncoder, plain_letters
from varloom.llm.quality import let
from varloom.staging import staged, staging_path

# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words above this carry their ranks through the fold; above the other one they go to the library in the second
#: pass, as each of their bytes is a step over the whole word.
CARRIED_FROM, LONGEST_FOLD = 48, 2048

BUCKETS, PAIR_BUCKETS = 16384, 32749
BATCH_BYTES = 8 << 20
#: Words that a block's table takes at a time.
TABLE_ROWS = 1 << 14
#: Text bytes of a block, on average.
BLOCK_BYTES = 32 << 20


@lru_cache(maxsize=2)
def read_ranks(name: str) -> dict[bytes, int]:
    with open(tokenizer_path(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def rank_literal(name: str) -> Column:
    """The ranks of whole words by checksum of their hexadecimal text."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in read_ranks(name).items():
        key = token.hex()
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def pair_literal(name: str):
    """A column function: the rank of two neighbouring tokens joined, by ``pair_key``; null if they are no token."""
    ranks = read_ranks(name)
    buckets: list[dict[int, int]] = [{} for _ in range(PAIR_BUCKETS)]
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                key = left << 32 | right
                buckets[key % PAIR_BUCKETS][key] = rank
    keys = F.from_json(F.lit(json.dumps([list(b) for b in buckets])), "array<array<bigint>>")
    values = F.from_json(F.lit(json.dumps([list(b.values()) for b in buckets])), "array<array<bigint>>")

    def rank(key: Column) -> Column:
        # The bucket is written twice: a remainder is cheaper than an array to hold it.
        bucket = (key % PAIR_BUCKETS).cast("int")
        return F.get(F.get(values, bucket), (F.array_position(F.get(keys, bucket), key) - 1).cast("int"))

    return rank


def pair_key(left: Column, right: Column) -> Column:
    return left * F.lit(1 << 32) + right


def byte_ids(word: Column, name: str) -> Column:
    """The ids of a word's bytes. The low bytes of the checksums of single bytes are all different."""
    ranks, table = read_ranks(name), [0] * 256
    for i in range(256):
        table[zlib.crc32(bytes([i])) & 255] = ranks[bytes([i])]
    singles = F.from_json(F.lit(json.dumps(table)), "array<bigint>")
    return F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.get(singles, F.crc32(F.substring(word, i, F.lit(1))).bitwiseAND(255).cast("int")))


def encode_word(word: Column, name: str) -> Column:
    """Ids of one word, given as binary; null beyond ``LONGEST_FOLD`` bytes."""
    rank = pair_literal(name)
    size = F.octet_length(word)
    none = F.array().cast("array<bigint>")

    def ranks_of(parts: Column) -> Column:
        # The last part has no neighbour, so its key and rank are null.
        return F.transform(F.transform(parts, lambda left, i: pair_key(left, F.get(parts, i + 1))), rank)

    def lowest(found: Column) -> Column:
        best = F.array_min(found)
        return F.struct(best.alias("rank"), F.array_position(found, best).cast("int").alias("at"))

    def replaced(parts: Column, best: Column) -> Column:
        return F.concat(F.slice(parts, 1, best["at"] - 1), F.array(best["rank"]), F.slice(parts, best["at"] + 2, F.size(parts)))

    def looked_up(state: Column) -> Column:
        parts = state["parts"]
        return F.when(state["done"], state).otherwise(let(ranks_of(parts), lambda found: let(lowest(found), lambda best: F.when(
            best["rank"].isNull(), F.struct(parts.alias("parts"), F.lit(True).alias("done"))).otherwise(F.struct(replaced(parts, best).alias("parts"), F.lit(False).alias("done"))))))

    def carried(state: Column) -> Column:
        parts, found = state["parts"], state["ranks"]

        def merged(best: Column) -> Column:
            at, token = best["at"], best["rank"]
            left = F.when(at > 1, F.concat(F.slice(found, 1, at - 2), F.array(rank(pair_key(F.get(parts, at - 2), token))))).otherwise(none)
            right = F.concat(F.array(rank(pair_key(token, F.get(parts, at + 1)))), F.slice(found, at + 2, F.size(found)))
            return F.struct(replaced(parts, best).alias("parts"), F.concat(left, right).alias("ranks"))

        return let(lowest(found), lambda best: F.when(best["rank"].isNull(), state).otherwise(merged(best)))

    steps, parts = F.sequence(F.lit(2), size), byte_ids(word, name)
    short = F.aggregate(steps, F.struct(parts.alias("parts"), F.lit(False).alias("done")), lambda state, _: looked_up(state), lambda state: state["parts"].cast("array<int>"))
    long = F.aggregate(steps, let(parts, lambda p: F.struct(p.alias("parts"), ranks_of(p).alias("ranks"))), lambda state, _: carried(state), lambda state: state["parts"].cast("array<int>"))
    text = F.lower(F.hex(word))
    whole = F.element_at(rank_literal(name), (F.crc32(text) % BUCKETS).cast("int") + 1)[text]
    return (F.when(size == 0, F.array().cast("array<int>")).when(whole.isNotNull(), F.array(whole)).when(size == 1, parts.cast("array<int>"))
            .when(size <= CARRIED_FROM, short).when(size <= LONGEST_FOLD, long))


def decode_ids(ids: Column, name: str) -> Column:
    """The bytes of an array of ids: the tokens' binary pieces, one after the other."""
    pieces = [""] * (max(read_ranks(name).values()) + 1)
    for token, rank in read_ranks(name).items():
        pieces[rank] = token.hex()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), ""))


class Pieces:
    """Byte strings by number, to be strung together for arrays of numbers."""

    def __init__(self, pieces: list[bytes]):
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


@lru_cache(maxsize=1)
def digest_pieces(name: str) -> tuple[Pieces, Pieces]:
    """Each token's id in decimal with a comma, and its bytes."""
    tokens = [b""] * (max(read_ranks(name).values()) + 1)
    for token, rank in read_ranks(name).items():
        tokens[rank] = token
    return Pieces([b"%d," % k for k in range(len(tokens))]), Pieces(tokens)


class WordChunks(ChunkEncoder):
    """Chunks of a text as in ``encoding``; a chunk's value is what ``of_word`` gives for its words."""

    def __init__(self, of_word):
        import regex

        dict.__init__(self)
        self.words, self.of_word = regex.compile(PATTERN).findall, of_word
        self.drops_space = False
        self.line = self._library("\n")
        self.marks = {mark: self._library(mark) for mark in ".,"}
        self.spaced = {}

    def __missing__(self, chunk: str) -> bytes:
        # Letters with or without a space before them are one word: its value is at hand, so it is not kept here once more.
        if plain_letters(chunk[1:] if chunk[:1] == " " else chunk):
            return self.of_word(chunk)
        ids = self[chunk] = self._library(chunk)
        return ids

    def _library(self, chunk: str) -> bytes:
        return b"".join([self.of_word(word) for word in self.words(chunk)])


class BlockWords(WordChunks):
    """The words of many texts at once: ``find`` takes an array of words and gives all ids, and where each word's start and how many they are.

    Chunks that are letters become words by Arrow, the others by the pattern, so nothing is kept from one batch to the next.
    """

    def __init__(self, find):
        import regex

        dict.__init__(self)
        self.words, self.find = regex.compile(PATTERN).findall, find
        self.drops_space = False
        self.spaced = {}

    def _values(self, chunks: pa.Array, plain: np.ndarray, follows: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spaced = np.flatnonzero(follows)
        asked = np.concatenate([spaced, opening])
        spaces, plain = np.arange(len(asked)) < len(spaced), plain[asked]
        chosen = chunks.take(pa.array(asked))
        letters, others = chosen.filter(pa.array(plain)), chosen.filter(pa.array(~plain)).to_pylist()
        lines, dots, commas = (f.to_numpy(zero_copy_only=False) for f in (pc.starts_with(letters, LINE), pc.ends_with(letters, "."), pc.ends_with(letters, ",")))
        before = pa.array(["", " "]).take(pa.array((spaces[plain] & ~lines).astype(np.int8)))
        lists = [self.words("\n" + c[1:] if c[:1] == LINE else " " + c if s else c) for c, s in zip(others, spaces[~plain].tolist())]
        words = pa.concat_arrays([pc.binary_join_element_wise(before, pc.utf8_trim(letters, LINE + ".,"), ""), pa.array([w for ws in lists for w in ws], pa.string()), pa.array(["\n", ".", ","])])

        # The words of each chunk by their places in ``words``; the last three are the line break and the marks.
        counts = np.empty(len(asked), np.int64)
        counts[plain] = 1 + lines + dots + commas
        counts[~plain] = np.fromiter(map(len, lists), np.int64, len(lists))
        ends = np.cumsum(counts)
        places, own = np.empty(ends[-1] if len(ends) else 0, np.int64), np.repeat(plain, counts)
        opens, closes = (ends - counts)[plain], ends[plain] - 1
        places[~own] = np.arange(len(letters), len(words) - 3)
        places[opens + lines] = np.arange(len(letters))
        for mark, at in enumerate((opens[lines], closes[dots], closes[commas])):
            places[at] = len(words) - 3 + mark

        ids, starts, sizes = self.find(words)
        laid = np.concatenate([[0], np.cumsum(sizes[places])])
        in_chunk = np.zeros(len(chunks) + len(opening), np.int64)
        in_chunk[np.concatenate([spaced, np.arange(len(chunks), len(in_chunk))])] = laid[ends] - laid[ends - counts]
        return gathered(ids, starts[places], sizes[places]), in_chunk

    def _one(self, text: str) -> np.ndarray:
        return gathered(*self.find(pa.array(self.words(text), pa.string())))


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``ids``, one after the other."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordTable:
    """Ids of words, laid end to end."""

    def __init__(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray):
        self.words, self.ids, self.sizes = words, ids, sizes
        self.starts = np.cumsum(sizes) - sizes

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = pc.index_in(words, value_set=self.words)
        if rows.null_count:
            raise KeyError(words.filter(pc.is_null(rows))[0].as_py())
        return self.ids, self.starts[rows], self.sizes[rows]

    def __call__(self, word: str) -> bytes:
        return gathered(*self.find(pa.array([word]))).tobytes()


def split_runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows with one split, in their order."""
    splits = batch.column("split").to_numpy()
    starts = np.concatenate([[0], np.flatnonzero(np.diff(splits)) + 1])
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(splits)]):
        yield int(splits[start]), batch.slice(start, end - start)


def split_words(docs: DataFrame) -> DataFrame:
    """(split, word) of ``docs`` (split, text), words as binary; a split that comes in several runs may list a word again."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words = None, []

        def find(some: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words.append(pc.unique(some))
            return np.empty(0, "<u4"), *np.zeros((2, len(some)), np.int64)

        chunks = BlockWords(find)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for split, run in split_runs(batch):
                if split != now:
                    if now is not None:
                        yield _word_rows(now, words)
                    now = split
                    words.clear()
                chunks.encode(run.column("text"))
                words[:] = [pc.unique(pa.concat_arrays(words))] if words else []
        if now is not None:
            yield _word_rows(now, words)

    return docs.mapInArrow(collect, "split long, word binary")


def _word_rows(split: int, words: list[pa.Array]) -> pa.RecordBatch:
    # Every batch asks for the line break and the marks.
    distinct = pc.unique(pa.concat_arrays([*words, pa.array(["\n", ".", ","])])).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), split), pa.int64()), distinct], ["split", "word"])


def word_ids(words: DataFrame, name: str) -> DataFrame:
    """``words`` (split, word) with the ids of each word, which is encoded once for all splits.

    Each word comes once from every split, so a common word has a row for each split.
    """
    distinct = words.groupBy("word").agg(F.collect_set("split").alias("splits"))
    encoded = distinct.select("splits", "word", encode_word(F.col("word"), name).alias("ids"))
    return encoded.select(F.explode("splits").alias("split"), "word", "ids")


def _blocked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, split: rows of Parquet files under the hash of their file and block; other input is stored first.

    An equal hash only merges two word lists.
    """
    own = (F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    try:
        rows = docs.select(*own, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        rows = staged(docs.select(*own)).select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    block = max(1, min(1 << 20, BLOCK_BYTES * size.n // max(1, size.bytes or 0)))
    return rows.select("doc_id", "text", F.xxhash64("file", F.expr(f"row div {block}")).alias("split"))


def encoded_batches(docs: DataFrame, name: str, doc_id: str, text: str, schema: str, emit) -> DataFrame:
    """``emit(doc_ids, ids, ends)`` of every batch of rows: all their ids in order, and where each row's ids end."""
    rows = _blocked(docs, doc_id, text)
    folder = staging_path(docs.sparkSession)
    word_ids(split_words(rows.select("split", "text")), name).repartition("split").write.partitionBy("split").parquet(folder)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, now = None, None
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for split, run in split_runs(batch):
                if chunks is None or split != now:
                    now, chunks = split, None
                    chunks = BlockWords(_word_table(folder, split, name).find)
                yield emit(run.column("doc_id"), *chunks.encode(run.column("text")))

    return rows.mapInArrow(apply, schema)


def encode_documents(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and ids. Null texts are empty and have none; repeated rows stay; a null id stays null."""
    def emit(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return encoded_batches(docs, name, doc_id, text, "doc_id long, ids array<int>", emit)


def _word_table(folder: str, split: int, name: str) -> WordTable:
    """Ids of the split's words; words too long for the fold by the library."""
    import pyarrow.dataset as ds

    store, base = shared_store(folder)
    # The folder's own files only: the writer's markers are not data.
    found = ds.dataset(f"{base}/split={split}", filesystem=store, format="parquet")
    words, ids, sizes = [pa.array([], pa.string())], [np.empty(0, "<u4")], [np.empty(0, np.int64)]
    # In small batches, as a few files together are read ahead otherwise.
    for batch in found.to_batches(columns=["word", "ids"], batch_size=TABLE_ROWS, batch_readahead=1, fragment_readahead=1, use_threads=False):
        some, listed = batch.column("word").cast(pa.string()), batch.column("ids")
        short = listed.drop_null()
        words.append(some.filter(pc.is_valid(listed)))
        sizes.append(pc.list_value_length(short).to_numpy().astype(np.int64))
        ids.append(short.flatten().to_numpy().astype("<u4"))
        if listed.null_count:
            words.append(some.filter(pc.is_null(listed)))
            long = [np.array(_library(name)(w), "<u4") for w in words[-1].to_pylist()]
            sizes.append(np.fromiter(map(len, long), np.int64, len(long)))
            ids.extend(long)
    return WordTable(pa.concat_arrays(words), np.concatenate(ids), np.concatenate(sizes))


@lru_cache(maxsize=1)
def _library(name: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=read_ranks(name), special_tokens={})._encode_single_piece


def bpe_report(docs: DataFrame, name: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, digests of the decimal ids and of the decoded bytes.

    Null and empty texts have no tokens and the digests of nothing, repeated
    rows stay, a null id stays null.
    """
    def emit(doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        decimal, tokens = digest_pieces(name)
        rows = np.split(ids, ends[:-1]) if len(ends) else []
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array([hashlib.sha256(decimal.join(r)[:-1]).hexdigest() for r in rows], pa.string()),
             pa.array([hashlib.sha256(tokens.join(r)).hexdigest() for r in rows], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded_batches(docs, name, doc_id, text, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", emit)
