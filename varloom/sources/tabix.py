"""Region reads of bgzipped VCF files through their index.

The index of a file says for each bin (a window of 512 Mb, 64 Mb, ... 16 kb)
where the records lie that fit in that bin and in no smaller one, and for each
16 kb where the first record lies that reaches into it. A region read asks the
bins that overlap it, drops what ends before its first window, and reads the
members that are left; one row for each range goes to Spark, so a region of a
whole contig is read by many tasks. Places are virtual offsets: of a member in the
file, and of a byte in the member's text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.operators.filters import parse_region, region_filter
from varloom.sources.bgzf import DEFAULT_SPLIT, as_member, byte_ranges, first_member, members, task_count
from varloom.sources.vcf import open_input, open_output, read_sites

SUFFIX = ".tbi"

# Fixed values of the format: magic, VCF columns, bin levels and the size of the smallest bin.
_MAGIC = b"TBI\1"
_LAYOUT = (2, 1, 2, 0, ord("#"), 0)
_FIRST_BINS = (0, 1, 9, 73, 585, 4681)
_SMALLEST = 14
_LARGEST = 29


def smallest_bin(start: int, end: int) -> int:
    """The smallest bin that holds all of ``[start, end)``."""
    for level in range(5, -1, -1):
        shift = _SMALLEST + 3 * (5 - level)
        if start >> shift == (end - 1) >> shift:
            return _FIRST_BINS[level] + (start >> shift)
    raise ValueError(f"positions beyond {1 << _LARGEST} need another kind of index")


def overlapping_bins(start: int, end: int) -> list[tuple[int, int]]:
    """First and last number of the bins of each level that overlap ``[start, end)``."""
    return [(_FIRST_BINS[level] + (start >> (shift := _SMALLEST + 3 * (5 - level))), _FIRST_BINS[level] + ((end - 1) >> shift)) for level in range(6)]


# ── Building ────────────────────────────────────────────────────────────────


def placed_lines(file, start: int, end: int, size: int) -> Iterator[tuple[bytes, int, int]]:
    """The lines of one byte range, each with the virtual offsets of its first byte and of the next line.

    As everywhere, a range gives up the text before its first newline and
    reads on to the first newline after its last member.
    """
    skipping, rest, began = start > 0, [], None
    for offset, following, text in members(file, first_member(file, start, size), size):
        at = 0
        if offset < end and skipping:
            cut = text.find(b"\n")
            if cut < 0:
                continue
            at, skipping = cut + 1, False
        elif skipping:
            return
        while at < len(text):
            cut = text.find(b"\n", at)
            began = offset << 16 | at if began is None else began
            if cut < 0:
                rest.append(text[at:])
                break
            after = offset << 16 | cut + 1 if cut + 1 < len(text) else following << 16
            yield b"".join([*rest, text[at:cut]]), began, after
            rest, began, at = [], None, cut + 1
            if offset >= end:
                return
    if rest:
        yield b"".join(rest), began, size << 16


_PARTS = "path string, contig string, bin int, first long, last long, low long, high long"


def index_vcf(files: DataFrame, split_bytes: int = DEFAULT_SPLIT) -> DataFrame:
    """Write the index of every bgzipped VCF in ``files`` (``path, length``) beside it; returns ``path, n_bins``.

    Files are read in byte ranges. Each range reduces its records to one row
    for each run of a bin (``first`` and ``last`` offset, ``low`` and ``high``
    position) and one for each window (bin -1); the rows of a file are put together by one
    task, and there are as many as the file has windows, not records. Records must
    be in coordinate order, contig by contig.
    """
    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.path) as file:
                    rows = list(_runs(placed_lines(file, row.start, row.start + split_bytes, row.length)))
                yield pd.DataFrame([(row.path, *r) for r in rows], columns=["path", "contig", "bin", "first", "last", "low", "high"])

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        data, n_bins = _index_bytes(rows)
        with open_output(key[0] + SUFFIX) as out:
            for start in range(0, len(data), 1 << 15):
                out.write(as_member(data[start:start + (1 << 15)]))
            out.write(as_member(b""))
        return pd.DataFrame({"path": [key[0]], "n_bins": [n_bins]})

    return byte_ranges(files, split_bytes).mapInPandas(reduce, _PARTS).groupBy("path").applyInPandas(write, "path string, n_bins long")


def _runs(lines: Iterator[tuple[bytes, int, int]]) -> Iterator[tuple]:
    """(contig, bin, first, last, low, high) of runs of records in one bin, and (contig, -1, first, first, window, window)."""
    run, windows, now = None, {}, None
    for line, first, last in lines:
        if not line or line.startswith(b"#"):
            continue
        contig, pos, _, ref = line.split(b"\t", 4)[:4]
        start = int(pos) - 1
        end = start + max(1, len(ref))
        if contig != now:
            yield from ((now.decode(), -1, at, at, w, w) for w, at in windows.items())
            windows, now = {}, contig
        for window in range(start >> _SMALLEST, ((end - 1) >> _SMALLEST) + 1):
            windows.setdefault(window, first)
        number = smallest_bin(start, end)
        if run is not None and run[:2] == [contig, number]:
            if start < run[5]:
                raise ValueError(f"records are not in coordinate order at {contig.decode()}:{start + 1}")
            run[3], run[5] = last, start
        else:
            if run is not None and run[0] == contig and start < run[5]:
                raise ValueError(f"records are not in coordinate order at {contig.decode()}:{start + 1}")
            if run is not None:
                yield (run[0].decode(), *run[1:])
            run = [contig, number, first, last, start, start]
    if run is not None:
        yield (run[0].decode(), *run[1:])
        yield from ((now.decode(), -1, at, at, w, w) for w, at in windows.items())


def _index_bytes(rows: pd.DataFrame) -> tuple[bytes, int]:
    runs = rows[rows["bin"] >= 0].sort_values("first")
    contigs = list(dict.fromkeys(runs["contig"]))
    changes = int((runs["contig"] != runs["contig"].shift()).sum())
    body, n_bins = [], 0
    for contig in contigs:
        own = runs[runs["contig"] == contig]
        if changes > len(contigs) or (own["low"].to_numpy()[1:] < own["high"].to_numpy()[:-1]).any():
            raise ValueError(f"records of {contig} are not in coordinate order")
        bins: dict[int, list[list[int]]] = {}
        for number, first, last in zip(own["bin"], own["first"], own["last"]):
            spans = bins.setdefault(int(number), [])
            if spans and spans[-1][1] == first:
                spans[-1][1] = int(last)
            else:
                spans.append([int(first), int(last)])
        seen = rows[(rows["bin"] < 0) & (rows["contig"] == contig)].groupby("low")["first"].min()
        linear = seen.reindex(range(int(seen.index.max()) + 1)).ffill().fillna(0).astype("int64").tolist()
        body.append(struct.pack("<i", len(bins)))
        for number, spans in sorted(bins.items()):
            body.append(struct.pack("<Ii", number, len(spans)) + b"".join(struct.pack("<QQ", *span) for span in spans))
        body.append(struct.pack(f"<i{len(linear)}Q", len(linear), *linear))
        n_bins += len(bins)
    names = b"".join(c.encode() + b"\0" for c in contigs)
    return _MAGIC + struct.pack("<i6ii", len(contigs), *_LAYOUT, len(names)) + names + b"".join(body), n_bins


# ── Reading ─────────────────────────────────────────────────────────────────


def ranges_of(index: bytes, regions: Sequence[str], split_bytes: int = DEFAULT_SPLIT) -> list[tuple[int, int]]:
    """Virtual offsets ``(first, last)`` of the ranges that hold all records of ``regions``, in order and apart."""
    if index[:4] != _MAGIC:
        raise ValueError("not a tabix index")
    n_contigs, = struct.unpack_from("<i", index, 4)
    length, = struct.unpack_from("<i", index, 32)
    names = index[36:36 + length].split(b"\0")[:n_contigs]
    wanted: dict[str, list[tuple[int, int]]] = {}
    for contig, start, end in map(parse_region, regions):
        # A region that ends before it starts holds nothing.
        last = 1 << _LARGEST if end is None else min(end, 1 << _LARGEST)
        if last > (first := max(0, (start or 1) - 1)):
            wanted.setdefault(contig, []).append((first, last))
    at, found, cuts = 36 + length, [], []
    for name in names:
        asked = wanted.get(name.decode(), [])
        spans = []
        n_bins, = struct.unpack_from("<i", index, at)
        at += 4
        overlapping = [[pair for pair in overlapping_bins(*region)] for region in asked]
        for _ in range(n_bins):
            number, n_spans = struct.unpack_from("<Ii", index, at)
            at += 8
            for k, pairs in enumerate(overlapping):
                if any(low <= number <= high for low, high in pairs):
                    spans += [(k, *struct.unpack_from("<QQ", index, at + 16 * i)) for i in range(n_spans)]
            at += 16 * n_spans
        n_windows, = struct.unpack_from("<i", index, at)
        linear = struct.unpack_from(f"<{n_windows}Q", index, at + 4)
        at += 4 + 8 * n_windows
        for k, first, last in spans:
            window = asked[k][0] >> _SMALLEST
            least = linear[window] if window < n_windows else (1 << 64) - 1
            if last > least:
                found.append((max(first, least), last))
        if asked:
            cuts += linear
    return _cut(_merged(found), sorted(set(cuts)), split_bytes)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order; those that overlap, touch, or share a member are one, so no member is read twice."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first >> 16 <= out[-1][1] >> 16:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _cut(spans: list[tuple[int, int]], cuts: list[int], split_bytes: int) -> list[tuple[int, int]]:
    """Spans over ``split_bytes`` in parts, at offsets where a record starts."""
    out = []
    for first, last in spans:
        for cut in cuts:
            if first < cut < last and (cut >> 16) - (first >> 16) >= split_bytes:
                out.append((first, cut))
                first = cut
        out.append((first, last))
    return out


def region_ranges(files: DataFrame, regions: Sequence[str], split_bytes: int = DEFAULT_SPLIT) -> DataFrame:
    """Rows ``path, length, first, last, bytes`` to read for ``regions``; the index of each file is read by a task."""
    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.path + SUFFIX) as file:
                    size = file.size()
                    index = b"".join(text for _, _, text in members(file, 0, size))
                spans = ranges_of(index, regions, split_bytes)
                yield pd.DataFrame([(row.path, row.length, a, b, min((b >> 16) + (1 << 16 if b & 0xFFFF else 0), row.length) - (a >> 16)) for a, b in spans],
                                   columns=["path", "length", "first", "last", "bytes"])

    return files.select("path", "length").mapInPandas(plan, "path string, length long, first long, last long, bytes long")


def read_range_lines(ranges: DataFrame) -> DataFrame:
    """The lines of ``region_ranges`` as rows ``value, path``; a range is one task's, which may have several."""
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.path) as file:
                    held = []
                    for offset, _, text in members(file, row.first >> 16, row.length):
                        low = row.first & 0xFFFF if offset == row.first >> 16 else 0
                        high = row.last & 0xFFFF if offset == row.last >> 16 else len(text)
                        if offset > row.last >> 16:
                            break
                        held.append(text[low:high])
                        if sum(map(len, held)) > 1 << 23 and b"\n" in text[low:high]:
                            whole, _, rest = b"".join(held).rpartition(b"\n")
                            yield pd.DataFrame({"value": whole.split(b"\n"), "path": row.path})
                            held = [rest]
                        if offset == row.last >> 16:
                            break
                    text = b"".join(held)
                    if text:
                        yield pd.DataFrame({"value": text.removesuffix(b"\n").split(b"\n"), "path": row.path})

    size = ranges.agg(F.count("*"), F.sum("bytes")).first()
    dealt = ranges.repartition(task_count(ranges.sparkSession, size[0], size[1] or 0))
    found = dealt.mapInPandas(lines, "value binary, path string")
    return found.select(F.rtrim(F.col("value").cast("string"), F.lit("\r")).alias("value"), "path")


def read_regions(spark: SparkSession, files: DataFrame, regions: str | Sequence[str], info: Sequence[str] = ("AC", "AN", "AF", "CSQ", "ANN"),
                 split_bytes: int = DEFAULT_SPLIT) -> DataFrame:
    """Site records of ``files`` that overlap ``regions``, as ``region_filter(read_sites(...))`` but reading only their ranges."""
    from varloom.staging import staged

    listed = [regions] if isinstance(regions, str) else list(regions)
    ranges = staged(region_ranges(files, listed, split_bytes))
    return region_filter(read_sites(spark, [], info, read_range_lines(ranges)), listed)
