"""Shards of near equal bytes by histogram sort.

Documents are ordered by a key: a hash of the text, then the id. Equal texts are
neighbours in that order. Splitters for the shards (and for slices inside them)
are found by counting: in each round every task counts the exact bytes of its
rows between candidate keys, the counts are added up, and the candidates close
in around each target until the splitter's bytes are within the tolerance or
no key is left between. Then the rows are exchanged once.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import text_or_empty
from varloom.staging import staged

#: Candidate keys tried at once for one splitter.
PROBES = 31
_NO_ID = -(1 << 63)

Key = tuple[int, int]
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def keyed_sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """hash, at (the id; null is the smallest), doc_id, size, text_crc32."""
    body = text_or_empty(text)
    return docs.select(F.xxhash64(body, F.octet_length(body)).alias("hash"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("at"),
                       F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"))


def _intervals(keys: list[Key], hashes: np.ndarray, ats: np.ndarray) -> np.ndarray:
    """For each row how many of the sorted ``keys`` are at or below it."""
    edges = np.array([k[0] for k in keys], np.int64)
    low, high = np.searchsorted(edges, hashes, side="left"), np.searchsorted(edges, hashes, side="right")
    inner = np.array([k[1] for k in keys], np.int64)
    tied = np.flatnonzero(low < high)
    for a in np.unique(low[tied]):
        rows = tied[low[tied] == a]
        b = int(high[rows[0]])
        low[rows] = a + np.searchsorted(inner[a:b], ats[rows], side="right")
    return low


def interval_of(keys: list[Key]):
    """A column function: the interval between sorted splitter keys that a row is in."""
    @F.pandas_udf("int")
    def interval(hashes, ats):
        import pandas as pd

        return pd.Series(_intervals(keys, hashes.to_numpy(), ats.to_numpy()).astype(np.int32))

    return interval


def bytes_between(rows: DataFrame, keys: list[Key]) -> np.ndarray:
    """Exact bytes in each interval between the sorted ``keys``.

    Each task adds up its own rows; one row for each interval comes out.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(keys) + 1, np.int64)
        for batch in batches:
            spot = _intervals(keys, batch.column("hash").to_numpy(), batch.column("at").to_numpy())
            np.add.at(total, spot, batch.column("size").to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"interval": pa.array(used, pa.int64()), "bytes": pa.array(total[used], pa.int64())})

    parts = rows.select("hash", "at", "size").mapInArrow(count, "interval long, bytes long")
    found = np.zeros(len(keys) + 1, np.int64)
    for interval, size in parts.groupBy("interval").agg(F.sum("bytes")).collect():
        found[interval] = size
    return found


def _spread(low: Key, high: Key, count: int) -> list[Key]:
    """Candidate keys strictly inside (low, high): over the hashes, or over the ids where the hash is one."""
    if high[0] - low[0] > 1:
        step = max(1, (high[0] - low[0]) // (count + 1))
        return [(low[0] + step * k, _LEAST) for k in range(1, count + 1) if low[0] + step * k < high[0]] + [(high[0], _LEAST)] * (high[1] > _LEAST)
    if high[0] - low[0] == 1 and (low[0], low[1]) < (high[0], _LEAST) < high:
        return [(high[0], _LEAST)]
    top = high[1] if high[0] == low[0] else _MOST
    step = max(1, (top - low[1]) // (count + 1))
    return [(low[0], low[1] + step * k) for k in range(1, count + 1) if low[1] + step * k < top]


def find_splitters(rows: DataFrame, targets: list[int], tolerance: int) -> list[Key]:
    """For each target the key with the nearest count of bytes below it, to within ``tolerance`` bytes.

    Where rows with one key are larger than the tolerance, the key itself is the splitter.
    """
    first = rows.agg(F.min("hash"), F.max("hash"), F.min("at"), F.max("at")).first()
    if first[0] is None:
        return [(_LEAST, _LEAST)] * len(targets)
    least, most = (first[0], first[2]), (first[1], first[3] + 1 if first[3] < _MOST else _MOST)
    total = int(rows.agg(F.sum("size")).first()[0])
    #: Known keys with the bytes below them.
    below: dict[Key, int] = {least: 0, most: total}
    while True:
        known = sorted(below)
        counts = [below[k] for k in known]
        probes: set[Key] = set()
        for target in targets:
            k = bisect.bisect_right(counts, target)
            low, high = known[k - 1], known[min(k, len(known) - 1)]
            if min(target - below[low], below[high] - target) > tolerance:
                probes.update(p for p in _spread(low, high, PROBES) if low < p < high)
        if not probes:
            break
        tried = sorted(probes)
        sums = np.cumsum(bytes_between(rows, tried))
        below.update(zip(tried, sums[:-1].tolist()))
    return sorted(min(known, key=lambda k: (abs(below[k] - target), k)) for target in targets)


def byte_shards(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", slice_bytes: int = 64 << 20,
                tolerance: float = 0.001) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's bytes plus one, null texts are empty. Shard sizes differ
    from an equal share by ``tolerance`` of it or by the rows of one key. A
    group of equal texts is in one shard unless a splitter falls inside it, so a
    group of any size is cut between shards. Slots are gapless from 0 in key
    order; they are numbered in slices, none of which grows with the input.
    """
    rows = staged(keyed_sizes(docs, doc_id, text))
    total = rows.agg(F.sum("size")).first()[0] or 0
    inner = max(1, -(-int(total) // (shards * slice_bytes)), -(-rows.count() // (shards * 1_000_000)))
    count = shards * inner
    splitters = find_splitters(rows, [total * k // count for k in range(1, count)], max(1, int(tolerance * total / shards)))
    placed = rows.withColumn("slice", interval_of(splitters)("hash", "at"))
    sizes = placed.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", F.floor(F.col("slice") / inner).cast("int"))
    # One small row for each slice.
    base = sizes.withColumn("base", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("slice", "shard", "base")
    ordered = placed.withColumn("own", F.row_number().over(Window.partitionBy("slice").orderBy("hash", "at", "size", "text_crc32")) - 1)
    return ordered.join(F.broadcast(base) if count <= 1 << 16 else base, "slice").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("own")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
