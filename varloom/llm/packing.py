"""Packing of token sequences by cutting-stock column generation.

Documents longer than a sequence give whole sequences; what is left of each
document is a piece shorter than a sequence. The pieces are a cutting-stock
problem on their length histogram, which has at most ``size - 1`` bins however
many documents there are: a linear program over patterns (how many pieces of
each length share a sequence) is grown column by column, a knapsack dynamic
program pricing the next pattern by the program's dual values. Rounded down,
the patterns tell the piece of each rank within its length where it goes.

All sequences lie on one line of tokens: whole ones first, then the runs of each
pattern (full patterns first), then the pieces that rounding left over. A
pattern that does not fill a sequence is laid out without gaps and cut at the
sequence ends, so only the end of the line is not full; it becomes sequences of
power-of-two lengths, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, crc32_of, id_and_text
from varloom.llm.encoding import chunk_encoder
from varloom.staging import staged

BATCH_BYTES = 8 << 20


@dataclass
class Pattern:
    """``runs`` sequences of ``counts[length]`` pieces of each length."""

    counts: dict[int, int]
    runs: int

    @property
    def filled(self) -> int:
        return sum(length * n for length, n in self.counts.items())


def price_pattern(values: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of lengths within ``size``."""
    lengths = np.flatnonzero(values > 1e-12) + 1
    best, choice = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    worth = values[lengths - 1]
    for room in range(1, size + 1):
        fits = np.searchsorted(lengths, room, side="right")
        if fits:
            total = worth[:fits] + best[room - lengths[:fits]]
            k = int(total.argmax())
            best[room], choice[room] = total[k], lengths[k]
        if best[room - 1] > best[room]:
            best[room], choice[room] = best[room - 1], 0
    pattern, room = np.zeros(len(values)), size
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(best[size]), pattern


def cutting_stock(histogram: np.ndarray, size: int, gap: float = 0.005, rounds: int = 60) -> list[Pattern]:
    """Patterns with whole runs that use at most ``histogram[i]`` pieces of length ``i + 1``.

    Revised simplex on equality rows, one for each length that occurs, from a
    greedy start. It ends when the dual bound is within ``gap`` of the
    program's value, no pattern prices out, or after ``rounds``; any basis
    gives a right packing.
    """
    rows = np.flatnonzero(histogram)
    if not len(rows):
        return []
    demand = histogram[rows].astype(float)
    basis = _greedy_basis(histogram, rows, size)
    inverse = np.linalg.inv(basis)
    used = np.maximum(inverse @ demand, 0)
    for step in range(rounds):
        duals = inverse.sum(axis=0)
        values = np.zeros(len(histogram))
        values[rows] = duals
        worth, pattern = price_pattern(values, size)
        if worth <= 1 + 1e-9 or 1 - 1 / worth <= gap:
            break
        column = inverse @ pattern[rows]
        ratio = np.where(column > 1e-9, used / np.where(column > 1e-9, column, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        used = np.maximum(used - ratio[out] * column, 0)
        used[out] = ratio[out]
        basis[:, out] = pattern[rows]
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
    found = [Pattern({int(rows[i]) + 1: int(n) for i, n in enumerate(basis[:, k]) if n}, int(used[k] + 1e-7)) for k in range(len(rows))]
    # Rounding errors must not use a piece twice.
    left = histogram.astype(np.int64).copy()
    for p in found:
        p.runs = min([p.runs, *(int(left[length - 1]) // n for length, n in p.counts.items())])
        for length, n in p.counts.items():
            left[length - 1] -= n * p.runs
    return sorted((p for p in found if p.runs), key=lambda p: (-p.filled, sorted(p.counts.items())))


def _greedy_basis(histogram: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """One column for each length: a greedy pattern that uses it up, with only lengths left after earlier ones.

    Ordered that way the matrix is triangular, so it has an inverse, and the
    demand is a sum of its columns with weights of zero or more.
    """
    left = histogram.astype(float).copy()
    at = {int(r): i for i, r in enumerate(rows)}
    basis = np.zeros((len(rows), len(rows)))
    open_rows = left > 0
    for _ in rows:
        pattern, room = np.zeros(len(left)), size
        while room:
            fits = np.flatnonzero(open_rows[:room])
            if not len(fits):
                break
            k = int(fits[-1])
            n = min(room // (k + 1), max(1, int(left[k])))
            pattern[k] = n
            room -= n * (k + 1)
            open_rows[k] = False
        used = np.flatnonzero(pattern)
        open_rows[used] = True
        ratio = left[used] / pattern[used]
        spent = int(used[ratio.argmin()])
        left = np.maximum(left - ratio.min() * pattern, 0)
        left[spent], open_rows[spent] = 0, False
        basis[:, at[spent]] = pattern[rows]
    return basis


@dataclass
class Layout:
    """Where the piece of a length and rank starts on the line of tokens."""

    base: int
    end: int
    slots: dict[int, tuple[np.ndarray, ...]]

    @classmethod
    def of(cls, patterns: list[Pattern], base: int) -> Layout:
        lists: dict[int, list[tuple[int, ...]]] = {}
        supplied: dict[int, int] = {}
        at = base
        for p in patterns:
            inside = 0
            for length, n in sorted(p.counts.items(), reverse=True):
                first = supplied.get(length, 0)
                lists.setdefault(length, []).append((first, n, at + inside, p.filled))
                supplied[length] = first + n * p.runs
                inside += length * n
            at += p.filled * p.runs
        slots = {length: tuple(np.array(column, np.int64) for column in zip(*rows, (supplied[length], 0, 0, 0))) for length, rows in lists.items()}
        return cls(base, at, slots)

    def place(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Starts on the line; -1 for pieces that the patterns left over."""
        out = np.full(len(length), -1, np.int64)
        for value in np.unique(length):
            if int(value) not in self.slots:
                continue
            first, n, start, filled = self.slots[int(value)]
            here = np.flatnonzero((length == value) & (rank < first[-1]))
            k = np.searchsorted(first, rank[here], side="right") - 1
            run, spot = np.divmod(rank[here] - first[k], n[k])
            out[here] = start[k] + run * filled[k] + spot * value
        return out


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", size: int = 1024) -> DataFrame:
    """Token ids of each document (16 or 32 bits each, as the vocabulary needs), stored in the shared folder.

    ``part`` and ``row`` name the document for the later joins, as ``doc_id`` may
    repeat. ``rank`` counts the earlier pieces of the same length in the part,
    ``whole`` the earlier full sequences. All four hold once they are stored.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, row, whole = chunk_encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        kind = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        seen = np.zeros(size, np.int64)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            tokens, ends = encoder.encode(batch.column("text"))
            tokens = np.insert(tokens, ends, end_id).astype(kind)
            counts = np.diff(ends, prepend=0) + 1
            rest, full = counts % size, counts // size
            data = tokens.tobytes()
            offsets = np.concatenate([[0], np.cumsum(counts)]) * tokens.itemsize
            order = np.argsort(rest, kind="stable")
            firsts = np.searchsorted(rest[order], rest[order])
            rank = np.empty(len(rest), np.int64)
            rank[order] = np.arange(len(rest)) - firsts
            rank += seen[rest]
            seen += np.bincount(rest, minlength=size)
            before = whole + np.cumsum(full) - full
            whole += int(full.sum())
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "part": np.full(n, part, np.int64), "row": np.arange(row, row + n), "doc_id": batch.column("doc_id"),
                "n_tokens": counts.astype(np.int64), "rest": rest.astype(np.int64), "rank": rank, "whole": before.astype(np.int64),
                "ids": pa.array([data[b:e] for b, e in zip(offsets[:-1], offsets[1:])], pa.binary())})
            row += n

    schema = "part long, row long, doc_id long, n_tokens long, rest long, rank long, whole long, ids binary"
    return staged(id_and_text(docs, doc_id, text).mapInArrow(encode, schema))


def pack_documents(encoded: DataFrame, size: int = 1024) -> tuple[DataFrame, int]:
    """The pieces (part, row, start, length, address on the line), and the line's length.

    Ranks inside a part come with the stored documents; the sums of earlier
    parts, one small row for each part and length, make them ranks over all.
    """
    by_length = encoded.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(size, np.int64)
    # At most ``size`` rows, whatever the number of documents.
    for rest, n in by_length.groupBy("rest").agg(F.sum("n")).collect():
        histogram[rest] = n
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = encoded.groupBy("part").agg(F.sum(F.floor(F.col("n_tokens") / size)).alias("full"))
    parts = parts.select("part", F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("whole_before"))
    lengths = by_length.select("part", "rest", F.coalesce(F.sum("n").over(
        Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rank_before"))
    full = encoded.agg(F.sum(F.floor(F.col("n_tokens") / size))).first()[0] or 0
    layout = Layout.of(cutting_stock(histogram[1:], size), int(full) * size)

    @F.pandas_udf("long")
    def place(rest, rank):
        import pandas as pd

        return pd.Series(layout.place(rest.to_numpy(), rank.to_numpy()))

    light = encoded.select("part", "row", "n_tokens", "rest", "rank", "whole")
    ranked = (light.join(parts, "part").join(lengths, ["part", "rest"])
              .select("part", "row", "n_tokens", "rest", (F.col("whole") + F.col("whole_before")).alias("whole"),
                      (F.col("rank") + F.col("rank_before")).alias("rank"))
              .withColumn("address", F.when(F.col("rest") > 0, place("rest", "rank"))))
    ranked = staged(ranked)
    # What rounding leaves over: fewer pieces than one run of each pattern holds,
    # so a bounded number for any input.
    over = (ranked.where("address < 0").withColumn("address", F.coalesce(
        F.sum("rest").over(Window.orderBy(F.desc("rest"), "rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + layout.end))
    left = ranked.where("address < 0").agg(F.sum("rest")).first()[0] or 0
    pieces = ranked.where("address IS NULL OR address >= 0").unionByName(over)
    return pieces.select("part", "row", (F.col("whole") * size).alias("whole_address"), "rest", "address"), layout.end + int(left)


def sequence_of(address: int, total: int, size: int) -> tuple[int, int, int]:
    """Sequence, offset and room left in it for a place on a line of ``total`` tokens."""
    sequence, offset = divmod(address, size)
    last, tail = divmod(total, size)
    if sequence < last:
        return sequence, offset, size - offset
    # The end of the line: one sequence for each power of two in its length.
    for bit in (1 << i for i in reversed(range(size.bit_length()))):
        if tail & bit:
            if offset < bit:
                return last, offset, bit - offset
            offset, last = offset - bit, last + 1
    raise ValueError("the address is beyond the line")


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, doc_id: str = "doc_id", text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document in a sequence of at most ``size`` tokens.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if
    asked for, the ids as little-endian 32-bit integers. Null texts are empty:
    one piece with the end id. Documents with equal ids are packed separately.
    The ids are exchanged once, to meet their places.
    """
    encoded = encode_documents(docs, tokenizer, end_id, doc_id, text, size)
    pieces, total = pack_documents(encoded, size)
    joined = encoded.select("part", "row", "doc_id", "n_tokens", "ids").join(pieces, ["part", "row"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            for doc, n, raw, whole_address, rest, address in zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "n_tokens", "ids", "whole_address", "rest", "address"))):
                ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                starts = [*range(0, n - rest, size)]
                spots = [(s, whole_address + s) for s in starts] + ([(n - rest, address)] if rest else [])
                for start, place in spots:
                    length = min(size, n - start)
                    while length > 0:
                        sequence, offset, room = sequence_of(place, total, size)
                        take = min(length, room)
                        part = ids[start:start + take]
                        for name, value in zip(out, (doc, start, take, crc32_of(part), n, sequence, offset, part.tobytes() if with_ids else None)):
                            out[name].append(value)
                        start, place, length = start + take, place + take, length - take
            kinds = {"ids": pa.binary()}
            yield pa.RecordBatch.from_pydict({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()})

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    found = joined.mapInArrow(cut, schema)
    return found if with_ids else found.drop("ids")
