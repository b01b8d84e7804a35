"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of whole documents, one document after the other, in
blocks of ``BLOCK`` ids:

    file    = magic, blocks, block starts, document ids, document lengths, tail
    block   = header (minimum, width, ids, exceptions), packed ids,
              exception places, exception values
    tail    = number of blocks, number of documents, place of the block starts, magic

A block subtracts its minimum and packs the differences at the width that
covers ``percentile`` of them; larger ones are stored whole in the exception
list. Packed ids are vertical: ``LANES`` lanes, each a row of 32-bit words. All
numbers are little-endian. Block starts let a reader jump to any id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, crc32_of, id_and_text, shared_store
from varloom.llm.encoding import chunk_encoder
from varloom.staging import staging_path

MAGIC = b"VLTOKEN2"
LANES = 32
BLOCK = 32 * LANES
HEADER = np.dtype([("minimum", "<u4"), ("width", "<u1"), ("spare", "<u1"), ("ids", "<u2"), ("exceptions", "<u4")])
TAIL = np.dtype([("blocks", "<u8"), ("documents", "<u8"), ("starts_at", "<u8"), ("nulls", "<u8"), ("magic", "S8")])

#: Texts are encoded in batches of so many bytes.
BATCH_BYTES = 8 << 20


def pack_blocks(ids: np.ndarray, percentile: float = 0.95) -> list[bytes]:
    """The ids as encoded blocks; the last one may be short."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    padded = np.full(count * BLOCK, ids[-1], np.uint32)
    padded[:len(ids)] = ids
    blocks = padded.reshape(count, BLOCK)
    minimum = blocks.min(axis=1)
    rest = blocks - minimum[:, None]
    covered = np.partition(rest, int(percentile * (BLOCK - 1)), axis=1)[:, int(percentile * (BLOCK - 1))]
    widths = np.ceil(np.log2(covered.astype(np.float64) + 1)).astype(np.uint8)
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        packed = _pack(rest[at], int(width))
        over = rest[at] >> np.uint32(width) if width < 32 else np.zeros_like(rest[at])
        row, place = np.nonzero(over)
        firsts = np.searchsorted(row, np.arange(len(at) + 1))
        values = rest[at][row, place].astype("<u4")
        for k, block in enumerate(at):
            here = slice(firsts[k], firsts[k + 1])
            n = min(BLOCK, len(ids) - block * BLOCK)
            head = np.array((minimum[block], width, 0, n, firsts[k + 1] - firsts[k]), HEADER)
            out[block] = b"".join((head.tobytes(), packed[k].tobytes(), place[here].astype("<u2").tobytes(), values[here].tobytes()))
    return out


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` values as rows of ``width`` words for each lane."""
    lanes = rest.reshape(len(rest), 32, LANES)
    words = np.zeros((len(rest), width, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        value = lanes[:, i] & mask
        words[:, word] |= value << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= value >> np.uint32(32 - shift)
    return words.reshape(len(rest), width * LANES).astype("<u4", copy=False)


def unpack_blocks(data: memoryview, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts`` in ``data``, in order."""
    heads = np.concatenate([np.frombuffer(data, HEADER, 1, int(s)) for s in starts]) if len(starts) else np.empty(0, HEADER)
    out = np.empty((len(starts), BLOCK), np.uint32)
    for width in np.unique(heads["width"]):
        at = np.flatnonzero(heads["width"] == width)
        size = int(width) * LANES
        words = np.stack([np.frombuffer(data, "<u4", size, int(starts[b]) + HEADER.itemsize) for b in at]).reshape(len(at), int(width), LANES)
        out[at] = _unpack(words, int(width))
        for b in at[heads["exceptions"][at] > 0]:
            place = int(starts[b]) + HEADER.itemsize + 4 * size
            n = int(heads["exceptions"][b])
            out[b][np.frombuffer(data, "<u2", n, place)] = np.frombuffer(data, "<u4", n, place + 2 * n)
    out += heads["minimum"][:, None]
    if len(starts) and (heads["ids"] < BLOCK).any():
        return np.concatenate([row[:n] for row, n in zip(out, heads["ids"])])
    return out.reshape(-1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), 32, LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(32 if width else 0):
        word, shift = divmod(i * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | words[:, word + 1] << np.uint32(32 - shift)
        out[:, i] = value & mask
    return out.reshape(len(words), BLOCK)


class TokenFileWriter:
    """Writes one file as ids come; holds a batch of blocks and the index."""

    def __init__(self, out, percentile: float = 0.95):
        self.out, self.percentile = out, percentile
        self.at = out.write(MAGIC)
        self.pending: list[np.ndarray] = []
        self.held, self.tokens, self.nulls = 0, 0, 0
        self.starts: list[int] = []
        self.ids, self.lengths = [], []

    def add(self, doc_ids: np.ndarray, lengths: np.ndarray, tokens: np.ndarray, nulls: int = 0) -> None:
        """Documents in order; the first ``nulls`` of a file, which come before all others, have no id."""
        self.nulls += nulls
        self.ids.append(doc_ids.astype("<i8"))
        self.lengths.append(lengths.astype("<i8"))
        self.pending.append(tokens)
        self.held += len(tokens)
        self.tokens += len(tokens)
        self._flush(self.held - self.held % BLOCK)

    def _flush(self, n: int) -> None:
        if n == 0:
            return
        tokens = np.concatenate(self.pending)
        for block in pack_blocks(tokens[:n], self.percentile):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.pending, self.held = [tokens[n:]], self.held - n

    def close(self) -> None:
        self._flush(self.held)
        tail = np.array((len(self.starts), sum(map(len, self.ids)), self.at, self.nulls, MAGIC), TAIL)
        for part in (np.array(self.starts, "<u8"), *self.ids, *self.lengths, tail):
            self.out.write(part.tobytes())


@dataclass
class TokenFile:
    """An open file: its index, and documents read through the block starts."""

    data: memoryview
    starts: np.ndarray
    doc_ids: np.ndarray
    ends: np.ndarray
    #: Documents at the beginning that have no id.
    nulls: int = 0

    @classmethod
    def open(cls, data) -> TokenFile:
        tail = np.frombuffer(data, TAIL, 1, len(data) - TAIL.itemsize)[0]
        if bytes(data[:8]) != MAGIC or tail["magic"] != MAGIC:
            raise ValueError("not a complete token file")
        at, documents = int(tail["starts_at"]), int(tail["documents"])
        starts = np.frombuffer(data, "<u8", int(tail["blocks"]), at)
        at += starts.nbytes
        ids = np.frombuffer(data, "<i8", documents, at)
        return cls(memoryview(data), starts, ids, np.cumsum(np.frombuffer(data, "<i8", documents, at + ids.nbytes)), int(tail["nulls"]))

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file; only their blocks are decoded."""
        first = start // BLOCK
        found = unpack_blocks(self.data, self.starts[first:-(-end // BLOCK)])
        return found[start - first * BLOCK:end - first * BLOCK]

    def runs(self, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """Documents ``i`` to ``j`` with their ids, about ``most`` ids at a time."""
        i = 0
        while i < len(self.ends):
            begin = int(self.ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(self.ends, begin + most, side="right")))
            yield i, j, self.tokens(begin, int(self.ends[j - 1]))
            i = j


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                      text: str = "text", percentile: float = 0.95) -> DataFrame:
    """Encode ``text`` and write the files of ``folder``, in ascending ``doc_id`` order over all files.

    Documents are exchanged once, by ranges of ``doc_id``; each task sorts its
    range and writes one file. Null texts are empty, repeated ids are ordered
    by text, rows without an id come first and stay without one. The returned list of files (path, first key, tokens, documents) is
    itself written to ``folder``: a file that a lost or repeated task left
    behind is not in it.
    """
    spark = docs.sparkSession
    ordered = (id_and_text(docs, doc_id, text).withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, first, name = chunk_encoder(tokenizer), None, None, f"{uuid.uuid4().hex}.tok"
        store, base = shared_store(folder)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            if writer is None:
                store.create_dir(f"{base}/files", recursive=True)
                writer = TokenFileWriter(store.open_output_stream(f"{base}/files/{name}"), percentile)
                first = batch.column("doc_id")[0].as_py()
            tokens, ends = encoder.encode(batch.column("text"))
            lengths = np.diff(ends, prepend=0) + 1
            own = batch.column("doc_id")
            writer.add(own.fill_null(0).to_numpy(), lengths, np.insert(tokens, ends, end_id), own.null_count)
        if writer is not None:
            writer.close()
            writer.out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"files/{name}"], "part": pa.array([_task_partition()], pa.int64()),
                                              "first_id": [first], "tokens": pa.array([writer.tokens], pa.int64()),
                                              "documents": pa.array([sum(map(len, writer.ids))], pa.int64())})

    files = ordered.mapInArrow(write, "path string, part long, first_id long, tokens long, documents long")
    files.write.parquet(f"{folder}/list")
    return spark.read.parquet(f"{folder}/list")


def _task_partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def read_token_files(spark, folder: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, and the file, its order and the place in it."""
    files = spark.read.parquet(f"{folder}/list")
    # One row for each file, in the order in which the tasks' ranges lie.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = shared_store(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            with store.open_input_file(f"{base}/{row['path']}") as source:
                opened = TokenFile.open(source.read_buffer())
            for i, j, tokens in opened.runs():
                ends = opened.ends[i:j]
                begins = np.concatenate([opened.ends[i - 1:i] if i else [0], ends[:-1]]).astype(np.int64)
                shift = int(begins[0])
                crc = [crc32_of(tokens[b - shift:e - shift]) for b, e in zip(begins, ends)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(opened.doc_ids[i:j], mask=np.arange(i, j) < opened.nulls), "start": pa.array(begins + row["before"]),
                    "n_tokens": pa.array(ends - begins), "ids_crc32": pa.array(crc, pa.int64()),
                    "file": [row["path"]] * (j - i)})

    # The list is small but each file is a task's work: the number keeps the rows apart.
    return (placed.select("path", "before").repartition(max(1, files.count()), "path")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string"))


def token_output(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write all documents as token files (in the shared folder if none is given) and read them back.

    Null and empty texts are the end id alone, repeated rows are documents of their own, a null id stays null.
    """
    folder = folder or staging_path(docs.sparkSession)
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder)
