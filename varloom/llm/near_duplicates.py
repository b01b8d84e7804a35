"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, and an exact check.

1. Each text becomes the set of its word shingles and a signature of ``SYMBOLS``
   16-bit MinHash values. Documents with the same set are one class from here on.
2. Two sets with the wanted similarity differ in at most ``distance`` symbols
   (five standard deviations above the mean). The symbols are split into
   ``distance // 2 + 1`` chunks; by the pigeonhole principle two such
   signatures have a chunk with at most one differing symbol. A class enters
   one bucket for each chunk and each symbol of it that may differ, so all
   pairs within the distance meet in a bucket.
3. Within a bucket, classes within the distance are joined by a spanning
   forest, never by all pairs; the forests' components are candidate clusters.
4. Within a cluster every pair is compared on the full sets, as matrix
   products; a spanning forest of the true links comes out.
Buckets and clusters above a block size are compared block against block in
separate tasks, so no task holds an unbounded group and no pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, free_names, text_or_empty
from varloom.llm.components import connected_components
from varloom.operators.joins import lookup_join
from varloom.staging import staged

SYMBOLS = 48
DEVIATIONS = 5

#: Most members that are compared in one task at once.
BUCKET_BLOCK = 16_384
CLUSTER_BLOCK = 1_024
#: Bytes of full sets in a block of a cluster, on average; one set may be larger.
CLUSTER_BYTES = 32 << 20

#: Bytes of text that a task turns into sets at once.
BATCH_BYTES = 8 << 20

_NO_ID = -(1 << 63)


def allowed_distance(percent: int, symbols: int = SYMBOLS) -> int:
    """Differing symbols that a pair of the similarity exceeds about once in a million."""
    miss = 1 - percent / 100
    return min(symbols - 1, math.ceil(symbols * miss + DEVIATIONS * math.sqrt(symbols * miss * (1 - miss))))


class WordHashes(dict):
    """64-bit hash of each word, computed once per worker and word (emptied at a million)."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = WordHashes()


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z folded, words end at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """16 bits of the smallest product for each factor; the high half decides the order."""
    best = np.full(symbols, np.iinfo(np.uint64).max, np.uint64)
    factors = _FACTORS[:symbols]
    for start in range(0, len(shingles), 4096):
        np.minimum(best, (shingles[start:start + 4096, None] * factors).min(axis=0), out=best)
    best ^= best >> np.uint64(31)
    return ((best * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype("<u2")


def set_key(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_or_empty(text).alias("text"),
                       F.xxhash64(text_or_empty(text)).alias("tie"))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, tie, n_shingles, node (the set's key; null without words), signature."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            counts, nodes, signs = [], [], []
            for text in batch.column("text").to_pylist():
                shingles = shingle_set(text, size)
                counts.append(len(shingles))
                nodes.append(set_key(shingles) if len(shingles) else None)
                signs.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                                              pa.array(signs, pa.binary())], ["doc_id", "tie", "n_shingles", "node", "signature"])

    return docs.mapInArrow(sign, "doc_id long, tie long, n_shingles long, node binary, signature binary")


def bucket_keys(signs: np.ndarray, distance: int) -> np.ndarray:
    """Keys of each signature: one for each chunk and symbol of it that is left open."""
    chunks = np.array_split(np.arange(signs.shape[1]), distance // 2 + 1)
    wide = signs.astype(np.uint64)
    keys = np.empty((len(signs), signs.shape[1]), np.uint64)
    at = 0
    for chunk in chunks:
        for left_open in chunk:
            mixed = np.full(len(signs), int(left_open) + 1, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            for k in chunk[chunk != left_open]:
                mixed = (mixed ^ wide[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
            keys[:, at] = mixed
            at += 1
    return keys.view(np.int64)


def shared_buckets(classes: DataFrame, distance: int) -> DataFrame:
    """(bucket, node) for buckets that at least two classes enter: one exchange, groups streamed."""
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                keys = bucket_keys(_matrix(part.column("signature")), distance)
                nodes = part.column("node").take(pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), nodes], ["bucket", "node"])

    def keep_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last_shared = None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                batch = _joined(held, batch)
            keys = batch.column("bucket").to_numpy()
            same = keys[1:] == keys[:-1]
            shared = np.concatenate([[last_shared], same]) | np.concatenate([same, [False]])
            last_shared = bool(shared[-1])
            held = batch.slice(batch.num_rows - 1)
            shared[-1] = False
            yield batch.filter(pa.array(shared))
        if held is not None and last_shared:
            yield held

    entered = classes.select("node", "signature").mapInArrow(enter, "bucket long, node binary")
    return entered.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(keep_shared, "bucket long, node binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length binary values as rows of 16-bit symbols."""
    values = b"".join(column.to_pylist())
    return np.frombuffer(values, "<u2").reshape(len(column), -1) if len(column) else np.empty((0, SYMBOLS), "<u2")


def in_blocks(members: DataFrame, group: str, block: int, weight: str | None = None, limit: int = 0) -> DataFrame:
    """Rows of ``members`` under every task (group, i, j) that compares their block; i = j where the group is one block.

    A group of n rows has about n / block blocks, dealt by the node's hash, or
    more where the sum of ``weight`` would be over ``limit`` in a block.
    """
    blocks = F.ceil(F.count(F.lit(1)) / block)
    if weight is not None:
        blocks = F.greatest(blocks, F.ceil(F.sum(weight) / limit))
    # Groups of more than one block are few (each holds a block's rows or bytes), so a hot one is not dealt by its key.
    large = staged(members.groupBy(group).agg(blocks.cast("int").alias("blocks")).where("blocks > 1"))
    sized = lookup_join(members, large, [group]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    small = sized.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    tasks = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(others)
    return small.withColumn("task", F.explode(tasks)).select(*[f"`{c}`" for c in members.columns], "task.i", "task.j")


def _joined(first: pa.RecordBatch, second: pa.RecordBatch) -> pa.RecordBatch:
    parts = pa.Table.from_batches([first, second]).combine_chunks().to_batches()
    if len(parts) != 1:
        raise RuntimeError(f"rows of a group came back in {len(parts)} batches instead of one")
    return parts[0]


def _wide(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Binary columns with 64-bit offsets: with 32-bit ones Arrow leaves over 2 GiB in several chunks."""
    return batch.cast(pa.schema([(f.name, pa.large_binary() if pa.types.is_binary(f.type) else f.type) for f in batch.schema]))


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows with equal ``names`` from sorted batches, many small groups at once; binary columns are large."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = _wide(batch)
        if held is not None:
            batch = _joined(held, batch)
        changes = _changes(batch, names)
        if len(changes) < 2:
            held = batch
            continue
        cut = int(changes[-1])
        yield batch.slice(0, cut)
        held = batch.slice(cut)
    if held is not None:
        yield held


def _changes(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Where groups start."""
    differs = np.zeros(batch.num_rows - 1, bool)
    for name in names:
        column = batch.column(name)
        codes = column.to_numpy() if pa.types.is_integer(column.type) else column.dictionary_encode().indices.to_numpy()
        differs |= codes[1:] != codes[:-1]
    return np.concatenate([[0], np.flatnonzero(differs) + 1])


def spanning_forest(count: int, near) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest; ``near(i, others)`` tells which others are joined to i."""
    left = np.arange(count)
    while len(left):
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            hit = near(node, left)
            for other in left[hit]:
                yield node, int(other)
            frontier += left[hit].tolist()
            left = left[~hit]


def candidate_links(buckets: DataFrame, classes: DataFrame, distance: int) -> DataFrame:
    """(a, b): spanning forests of the classes within the distance, by bucket."""
    signed = in_blocks(buckets, "bucket", BUCKET_BLOCK).join(classes.select("node", "signature"), "node")
    names = ["bucket", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, names):
            starts = _changes(batch, names)
            signs, nodes = _matrix(batch.column("signature")), batch.column("node").cast(pa.binary())
            sizes = np.diff(np.append(starts, batch.num_rows))
            firsts = starts[sizes == 2]
            close = (signs[firsts] != signs[firsts + 1]).sum(axis=1) <= distance
            left, right = firsts[close].tolist(), (firsts[close] + 1).tolist()
            for start, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                own = signs[start:start + n]
                for x, y in spanning_forest(n, lambda x, others: (own[others] != own[x]).sum(axis=1) <= distance):
                    left.append(start + x)
                    right.append(start + y)
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))], ["a", "b"])

    return (signed.select(*names, "node", "signature").repartition(*names).sortWithinPartitions(*names)
            .mapInArrow(compare, "a binary, b binary").distinct())


def confirmed_links(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): spanning forests of the true links within each cluster, from the full sets.

    ``members``: node, doc_id and tie (of a row whose text has the set), cluster.
    """
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            sets = [shingle_set(text, size) for text in batch.column("text").to_pylist()]
            same = pa.array([set_key(s) == node for s, node in zip(sets, batch.column("node").to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column("cluster"), batch.column("node"), pa.array([s.nbytes for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["cluster", "node", "n_bytes", "shingles"]).filter(same)

    # An id may stand for many texts, so the text's hash is part of the key; one row for each set stays.
    texts = docs.join(members, ["doc_id", "tie"]).select("cluster", "node", "text")
    sets = texts.mapInArrow(rebuild, "cluster binary, node binary, n_bytes long, shingles binary")
    names = ["cluster", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, names):
            nodes, shingles = batch.column("node").cast(pa.binary()), batch.column("shingles").to_pylist()
            starts = _changes(batch, names)
            left: list[int] = []
            right: list[int] = []
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                linked = linked_pairs([np.frombuffer(s, np.uint64) for s in shingles[start:end]], percent)
                for x, y in spanning_forest(end - start, lambda x, others: linked[x, others]):
                    left.append(start + x)
                    right.append(start + y)
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))], ["a", "b"])

    return (in_blocks(staged(sets.dropDuplicates(["node"])), "cluster", CLUSTER_BLOCK, "n_bytes", CLUSTER_BYTES).select(*names, "node", "shingles")
            .repartition(*names).sortWithinPartitions(*names).mapInArrow(compare, "a binary, b binary"))


def linked_pairs(sets: list[np.ndarray], percent: int, width: int = 4096) -> np.ndarray:
    """Matrix of 100 * intersection >= percent * union, exactly (counts below 2**24 are whole in 32-bit floats)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    joined, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Shingles of one set only add nothing to an intersection.
    shared = np.bincount(codes, minlength=len(joined)) > 1
    dense = np.cumsum(shared) - 1
    keep = shared[codes]
    codes, owner = dense[codes[keep]], owner[keep]
    common = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    total = int(codes[-1]) + 1 if len(codes) else 0
    for start in range(0, total, width):
        a, b = np.searchsorted(codes, [start, start + width])
        part = np.zeros((len(sets), min(width, total - start)), np.float32)
        part[owner[a:b], codes[a:b] - start] = 1
        common += (part @ part.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return 100 * common >= percent * union


def classified(keyed: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows of ``keyed`` (doc_id, text, tie), and (node, component, component_id) of every class."""
    signed = staged(signatures(keyed, size))
    distance = allowed_distance(percent)
    classes = staged(signed.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "tie")).alias("first"), F.min("signature").alias("signature"))
                     .select("node", F.col("first.doc_id").alias("first_id"), F.col("first.tie").alias("tie"), "signature"))
    buckets = staged(shared_buckets(classes, distance))
    clusters = connected_components(candidate_links(buckets, classes, distance))
    members = clusters.join(classes, "node").select("node", F.col("first_id").alias("doc_id"), "tie", F.col("component").alias("cluster"))
    found = connected_components(confirmed_links(keyed, members, size, percent))
    grouped = found.join(classes.select("node", "first_id"), "node")
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return signed, (classes.select("node", "first_id").join(found, "node", "left").join(smallest, "component", "left")
                    .select("node", F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "first_id").alias("component_id")))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Texts without words (null, empty, white space) are linked with nothing.
    Repeated rows and equal texts are one class; a null id counts as the
    smallest id inside and comes out as null. Each row is returned once.
    """
    signed, of_class = classified(_keyed(docs, doc_id, text), size, percent)
    own: Column = F.coalesce("component_id", "doc_id")
    return (signed.select("doc_id", "n_shingles", "node").join(of_class, "node", "left")
            .select(_shown("doc_id").alias("doc_id"), "n_shingles", _shown(own).alias("component_id"), (F.col("doc_id") == own).alias("kept")))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the smallest id, of several rows with it one text, and that once.

    Rows without words are groups of their own, except that rows with the same
    id and text stay once. The texts are exchanged once more, by id.
    """
    signed, of_class = classified(_keyed(docs, doc_id, text), size, percent)
    named = signed.select("doc_id", "tie", "node").join(of_class.select("node", "component"), "node", "left")
    grouped = named.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    stay = grouped.select("first.doc_id", "first.tie").union(named.where("component IS NULL").select("doc_id", "tie").distinct())
    at, tie, row = free_names(docs.columns, "at", "tie", "row")
    own = docs.withColumns({at: F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)), tie: F.xxhash64(text_or_empty(text))})
    once = own.withColumn(row, F.row_number().over(Window.partitionBy(at, tie).orderBy(F.lit(0)))).where(F.col(row) == 1)
    return (once.join(stay.select(F.col("doc_id").alias(at), F.col("tie").alias(tie)), [at, tie], "left_semi")
            .select(*[f"`{c}`" for c in docs.columns]))


def _shown(value) -> Column:
    return F.nullif(value if isinstance(value, Column) else F.col(value), F.lit(_NO_ID))
