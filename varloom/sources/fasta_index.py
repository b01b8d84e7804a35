"""Sequence windows of an indexed FASTA, plain or bgzipped, without reading the genome.

The index has a line for each contig: bases, place of the first base, bases and
bytes of a line. Lines of a contig are equally long, so the byte of any base is
arithmetic, and a window is one byte range. For a bgzipped file those are bytes
of the text, and a second index tells in which members they lie.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.sequence import reverse_complement
from varloom.operators.joins import lookup_join
from varloom.operators.start_lost import WINDOW
from varloom.sources.bgzf import DEFAULT_SPLIT, byte_ranges, first_member, members
from varloom.sources.vcf import open_input, open_output
from varloom.staging import staged

FAI, GZI = ".fai", ".gzi"

_PIECE = 8 << 20

#: Bytes of a line that are kept: a header may have as many, a sequence line may be of any length.
_HEAD = 1 << 16


# ── Building ────────────────────────────────────────────────────────────────


def _pieces(file, start: int, end: int, size: int, gzipped: bool) -> Iterator[tuple[bool, int, bytes]]:
    """(belongs to the range, offset in the file, text) of a range and of what follows it."""
    if gzipped:
        for offset, _, text in members(file, first_member(file, start, size), size):
            yield offset < end, offset, text
        return
    file.seek(start)
    while start < size:
        text = file.read(min(_PIECE, end - start) if start < end else _PIECE)
        yield start < end, start, text
        start += len(text)


def _lines(pieces: Iterator[tuple[bool, int, bytes]], skip: bool) -> Iterator[tuple[int, bytes, int, int]]:
    """(start, first bytes, length, end) of the lines of a range, in text from its first byte.

    With ``skip`` the text before the first newline is left to the range before; a
    range reads on to the first newline after its last byte.
    """
    base = began = length = 0
    head = b""
    for own, _, text in pieces:
        at = 0
        if skip:
            cut = text.find(b"\n") if own else -1
            if not own:
                return
            if cut < 0:
                base += len(text)
                continue
            at, skip, began = cut + 1, False, base + cut + 1
        while (cut := text.find(b"\n", at)) >= 0:
            yield began, (head + text[at:min(cut, at + _HEAD)])[:_HEAD], length + cut - at, base + cut + 1
            at, began, length, head = cut + 1, base + cut + 1, 0, b""
            if not own:
                return
        head = (head + text[at:at + _HEAD])[:_HEAD]
        length += len(text) - at
        base += len(text)
    if length:
        yield began, head, length, base


def _scan(file, start: int, end: int, size: int, gzipped: bool) -> Iterator[tuple]:
    """What a range says about its file: (kind, name, a, b, c, d), offsets in text from the range's first byte.

    ``text``: its bytes; ``member``: offset and bytes of each; ``contig``: start and end of each header;
    ``lines``: for the sequence lines of one length after one header (or before all): which header, length,
    number, first and last start (the name is their carriage return).
    """
    sizes: list[int] = []

    def watched():
        for own, offset, text in _pieces(file, start, end, size, gzipped):
            if own:
                sizes.append(len(text))
                found.append(offset)
            yield own, offset, text

    found: list[int] = []
    contig, kinds = -1, {}
    for began, head, length, stop in _lines(watched(), start > 0):
        if head.startswith(b">"):
            contig += 1
            yield "contig", head[1:].split(maxsplit=1)[0].decode() if head[1:].strip() else "", began, stop, 0, 0, 0
        else:
            kind = kinds.setdefault((contig, length, head[-1:] == b"\r"), [0, began, began])
            kind[0] += 1
            kind[2] = began
    # A range without a newline ends before its text has been read.
    for (at, length, is_return), (count, first, last) in kinds.items():
        yield "lines", "\r" if is_return else "", at, length, count, first, last
    yield "text", "", sum(sizes), 0, 0, 0, 0
    if gzipped:
        yield from (("member", "", offset, n, 0, 0, 0) for offset, n in zip(found, sizes))


_EVENTS = "path string, start long, kind string, name string, a long, b long, c long, d long, e long"


def index_fasta(files: DataFrame, split_bytes: int = DEFAULT_SPLIT) -> DataFrame:
    """Write the index of every FASTA in ``files`` (``path, length``) beside it; returns ``path, n_contigs``.

    Files are read in byte ranges by many tasks; each says in a few rows which
    contigs start in it and how long its lines are. A file whose lines differ
    within a contig has no such index and is refused.
    """
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.path) as file:
                    gzipped = file.read(2) == b"\x1f\x8b"
                    rows = [(row.path, row.start, *event) for event in _scan(file, row.start, min(row.start + split_bytes, row.length), row.length, gzipped)]
                yield pd.DataFrame(rows, columns=["path", "start", "kind", "name", "a", "b", "c", "d", "e"])

    def write(key: tuple, events: pd.DataFrame) -> pd.DataFrame:
        lines, gzi = _index_lines(key[0], events)
        with open_output(key[0] + FAI) as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        if gzi is not None:
            with open_output(key[0] + GZI) as out:
                out.write(gzi)
        return pd.DataFrame({"path": [key[0]], "n_contigs": [len(lines)]})

    return byte_ranges(files, split_bytes).mapInPandas(look, _EVENTS).groupBy("path").applyInPandas(write, "path string, n_contigs long")


def _index_lines(path: str, events: pd.DataFrame) -> tuple[list[str], bytes | None]:
    texts = events[events["kind"] == "text"].sort_values("start")
    base = dict(zip(texts["start"], texts["a"].cumsum() - texts["a"]))
    contigs = events[events["kind"] == "contig"].copy()
    contigs["at"] = contigs["a"] + contigs["start"].map(base)
    contigs["first"] = contigs["b"] + contigs["start"].map(base)
    contigs = contigs.sort_values("at").reset_index(drop=True)
    contigs["in_range"] = contigs.groupby("start").cumcount()
    numbers = {(s, k): i for i, (s, k) in enumerate(zip(contigs["start"], contigs["in_range"]))}
    kinds: list[list[tuple]] = [[] for _ in range(len(contigs))]
    for row in events[events["kind"] == "lines"].itertuples():
        offset = base[row.start]
        own = numbers[row.start, row.a] if row.a >= 0 else int(np.searchsorted(contigs["at"].to_numpy(), offset + row.d)) - 1
        if own < 0:
            if row.b:
                raise ValueError(f"{path}: sequence before the first header")
            continue
        kinds[own].append((row.b, row.name == "\r", row.c, offset + row.d, offset + row.e))
    lines = []
    for name, first, own in zip(contigs["name"], contigs["first"], kinds):
        full = max((k[0] for k in own), default=0)
        ends = max((k[4] for k in own if k[0] == full), default=0)
        is_return = any(k[1] for k in own if k[0] == full)
        shorter = [k for k in own if 0 < k[0] < full]
        blank = min((k[3] for k in own if k[0] == 0), default=None)
        last = max((k[4] for k in own if k[0]), default=0)
        if sum(k[2] for k in shorter) > 1 or any(k[3] < ends for k in shorter) or (blank is not None and blank < last) or len({k[1] for k in own if k[0]}) > 1:
            raise ValueError(f"{path}: the lines of {name} are not equally long")
        bases = sum((k[0] - is_return) * k[2] for k in own if k[0])
        lines.append(f"{name}\t{bases}\t{first}\t{full - is_return}\t{full + 1}")
    held = events[events["kind"] == "member"].sort_values("a")
    if not len(held):
        return lines, None
    places = held["b"].cumsum() - held["b"]
    pairs = [(c, u) for c, u in zip(held["a"].tolist(), places.tolist()) if c]
    return lines, struct.pack("<Q", len(pairs)) + b"".join(struct.pack("<QQ", *pair) for pair in pairs)


# ── Reading ─────────────────────────────────────────────────────────────────


def read_fasta_index(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Contigs of indexed FASTA files (path or glob): ``path, contig, bases, first, line_bases, line_bytes``."""
    names = [f"{p}{FAI}" for p in ([paths] if isinstance(paths, str) else paths)]
    part = F.split("value", "\t")
    return spark.read.text(names).select(
        F.regexp_replace("_metadata.file_path", rf"\{FAI}$", "").alias("path"), part[0].alias("contig"),
        *[part[i].cast("bigint").alias(name) for i, name in enumerate(("bases", "first", "line_bases", "line_bytes"), start=1)])


class _Text:
    """Byte ranges of the text of a file, of a bgzipped one by its members."""

    def __init__(self, path: str):
        self.file = open_input(path)
        self.size = self.file.size()
        self.places = None
        if self.file.read(2) == b"\x1f\x8b":
            with open_input(path + GZI) as index:
                pairs = np.frombuffer(index.read()[8:], "<u8").astype(np.int64).reshape(-1, 2)
            self.offsets, self.places = np.concatenate([[0], pairs[:, 0]]), np.concatenate([[0], pairs[:, 1]])

    def read(self, start: int, end: int) -> bytes:
        if self.places is None:
            self.file.seek(start)
            return self.file.read(end - start)
        k = int(np.searchsorted(self.places, start, side="right")) - 1
        at, parts = int(self.places[k]), []
        for _, _, text in members(self.file, int(self.offsets[k]), self.size):
            parts.append(text[max(0, start - at):end - at])
            at += len(text)
            if at >= end:
                break
        return b"".join(parts)


def fetch_indexed(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``fetch_sequences`` from indexed files: ``seq`` of each 0-based half-open window, reverse-complemented on ``-1``.

    Each distinct window is a byte range, and nothing of the genome besides those
    is read or shuffled. Windows near each other go to one task, in order. A window past
    the contig's end is shortened; one on an unknown contig gives no row.
    """
    asked = windows.select(*WINDOW).distinct().where("w_end > w_start").withColumn("contig", F.col("w_chrom"))
    known = lookup_join(staged(asked), staged(index), ["contig"], "inner")
    end = F.least("w_end", "bases")

    def place(base):
        return F.col("first") + F.floor(base / F.col("line_bases")) * F.col("line_bytes") + base % F.col("line_bases")

    found = known.where((F.col("w_start") < end) & (F.col("w_start") >= 0)).select(*WINDOW, "path", place(F.col("w_start")).alias("low"), (place(end - 1) + 1).alias("high"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, text = None, None
        for batch in batches:
            seqs = []
            for row in batch.itertuples():
                if row.path != path:
                    path, text = row.path, _Text(row.path)
                seqs.append(text.read(row.low, row.high).replace(b"\n", b"").replace(b"\r", b"").decode())
            yield batch[WINDOW].assign(seq=seqs)

    types = dict(found.dtypes)
    ordered = found.repartitionByRange("path", "low").sortWithinPartitions("path", "low")
    seqs = ordered.mapInPandas(read, ", ".join(f"{c} {types[c]}" for c in WINDOW) + ", seq string")
    return seqs.withColumn("seq", F.when(F.col("w_strand") == "-1", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
