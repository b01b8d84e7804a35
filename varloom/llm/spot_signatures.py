"""Document fingerprints from spot signatures, compared by pruned Jaccard.

A spot signature is a common word and the chain of content words that follows
it. Its hashes, as a set, are the fingerprint, with those of word runs where
common words are too rare for chains to cover the text (lists, tables, other
languages). Fingerprints are text (see ``fingerprint``), so they can be stored,
joined and compared later.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, text_or_empty
from varloom.llm.near_duplicates import WordHashes

# Common words of English, German, French and Spanish prose.
ANCHORS = frozenset("""
    a an and are as at be by for from has he in is it its of on that the this to was were will with
    auf aus das dem den der des die ein eine er es für im in ist mit nicht sich sie und von zu zum
    au aux ce dans de des du elle en est et il la le les par pas plus pour que qui sur un une
    al con como del el en es la las lo los más no para por que se su un una y
""".split())

#: Content words in a chain.
CHAIN = 2

_WORD = re.compile(r"\w+")
_ANCHOR_BYTES = frozenset(w.encode() for w in ANCHORS)
_HASHES = WordHashes()


def spot_hashes(text: str, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the text's spot signatures.

    Where no chain reaches, every run of ``chain`` + 1 such words is hashed too
    (of a shorter text all its words), so that the hashes stand for the whole
    text but stretches of at most ``chain`` words between chains. The rule is
    local: an edit changes the hashes around it and no others.
    """
    words = [w.encode() for w in _WORD.findall(text.lower())]
    if not words:
        return np.empty(0, np.uint32)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    common = np.fromiter(map(_ANCHOR_BYTES.__contains__, words), bool, len(words))
    content = np.flatnonzero(~common)
    anchors = np.flatnonzero(common)
    first = np.searchsorted(content, anchors)
    full = first + chain <= len(content)
    anchors, first = anchors[full], first[full]
    spots = _mixed(hashes[anchors], [hashes[content[first + k]] for k in range(chain)])
    # Chains open minus chains closed before each word.
    after = content[first + chain - 1] + 1
    bare = np.cumsum(np.bincount(anchors, minlength=len(words) + 1) - np.bincount(after, minlength=len(words) + 1))[:-1] == 0
    size = min(chain + 1, len(words))
    count = len(words) - size + 1
    starts = np.flatnonzero(np.logical_and.reduce([bare[k:k + count] for k in range(size)]))
    runs = _mixed(np.full(len(starts), size, np.uint64), [hashes[starts + k] for k in range(size)])
    return np.unique((np.concatenate([spots, runs]) >> np.uint64(16)).astype(np.uint32))


def _mixed(start: np.ndarray, links: list[np.ndarray]) -> np.ndarray:
    mixed = start
    for link in links:
        mixed = (mixed ^ link) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def fingerprint(hashes: np.ndarray) -> str:
    """Eight hexadecimal digits for each hash, in ascending order."""
    return hashes.astype(">u4").tobytes().hex()


def hashes_of(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity; 1 for two empty sets. Below ``least`` it may end early with 0.

    Set lengths alone bound the similarity, so sets of very different length are
    never intersected; that is also why comparisons are partitioned by length.
    """
    longest = max(len(a), len(b))
    if longest == 0:
        return 1.0
    if min(len(a), len(b)) / longest < least:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    similarity = common / (len(a) + len(b) - common)
    return similarity if similarity >= least else 0.0


def length_partition(length: int, least: float) -> int:
    """Partition of a set length: sets in partitions that are not neighbours cannot reach ``least``."""
    return int(np.floor(np.log(max(1, length)) / -np.log(least)))


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Per row: doc_id, fingerprint, spots (its set's length). Null texts are empty, with an empty fingerprint."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spot_hashes(t, chain) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(fingerprint, found), pa.string()),
                                              pa.array([len(f) for f in found], pa.int64())], ["doc_id", "fingerprint", "spots"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(mark, "doc_id long, fingerprint string, spots long")


def similar_fingerprints(queries: DataFrame, prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(query_id, doc_id, similarity) of a stated set of queries against all ``prints``, at ``least`` or above.

    Both as ``document_fingerprints`` returns them; an id does not find itself,
    and empty fingerprints are like nothing. Fingerprints are partitioned by set
    length: a query meets its own partition and the two beside it, and there
    only sets that share a hash of both prefixes (the smallest hashes of a set,
    so many that two sets this similar must share one).
    """
    def prefixes(reach: tuple[int, ...]):
        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows: list[tuple[int, int, int]] = []
                for own, text in zip(batch.column("id").to_pylist(), batch.column("fingerprint").to_pylist()):
                    spots = hashes_of(text)
                    part = length_partition(len(spots), least)
                    prefix = spots[:len(spots) - int(np.ceil(least * len(spots) - 1e-9)) + 1].tolist()
                    rows += [(own, part + shift, value) for shift in reach for value in prefix]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["id", "part", "hash"])
        return expand

    def keyed(side: DataFrame, reach: tuple[int, ...]) -> DataFrame:
        rows = side.where("spots > 0").select(F.col("doc_id").alias("id"), "fingerprint")
        return rows.mapInArrow(prefixes(reach), "id long, part long, hash long")

    asked = keyed(queries, (-1, 0, 1)).withColumnRenamed("id", "query_id")
    pairs = asked.join(keyed(prints, (0,)), ["part", "hash"]).where("query_id <> id").select("query_id", "id").distinct()

    @F.pandas_udf("double")
    def compare(x, y):
        import pandas as pd

        return pd.Series([likeness(hashes_of(p), hashes_of(q), least) for p, q in zip(x, y)])

    found = (pairs.join(queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("x")), "query_id")
             .join(prints.select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("y")), "id"))
    return found.select("query_id", F.col("id").alias("doc_id"), compare("x", "y").alias("similarity")).where(F.col("similarity") >= least)


#: Rows of a slice of the order, at least; the driver holds two keys for each slice.
SLICE_ROWS = 50_000


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) in slices of the descending order, each with the row that follows it.

    Adds at, tie (the order: id, then a hash of the text; a null id is the
    smallest), slice, and tail: true for the copies of a row that only end the
    slice before it. After the last row comes the first. Keys alone are sorted
    to find the slices; the texts then move once.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("at"), F.xxhash64("text").alias("tie"))
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keyed.count() // SLICE_ROWS)
    ranges = (keyed.select("at", "tie").repartitionByRange(slices, "at", "tie").groupBy(F.spark_partition_id().alias("part"))
              .agg(F.max(F.struct("at", "tie")).alias("top")))
    # Two numbers for each slice.
    tops = sorted((row.top.at, row.top.tie) for row in ranges.collect())
    ats, ties = np.array([t[0] for t in tops], np.int64), np.array([t[1] for t in tops], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tie = batch.column("at").to_numpy(), batch.column("tie").to_numpy()
            found = np.searchsorted(ats, at)
            # Among tops with the same id the hash decides.
            for row in np.flatnonzero(ats[np.minimum(found, len(ats) - 1)] == at):
                while ats[found[row]] == at[row] and ties[found[row]] < tie[row]:
                    found[row] += 1
            top = (ats[found] == at) & (ties[found] == tie)
            yield _placed(batch, found, np.zeros(len(found), bool))
            yield _placed(batch.filter(pa.array(top)), (found[top] + 1) % len(ats), np.ones(int(top.sum()), bool))

    schema = "doc_id long, text string, at long, tie long, slice int, tail boolean"
    return (keyed.mapInArrow(place, schema).repartition(slices, "slice")
            .sortWithinPartitions("slice", "tail", F.desc("at"), F.desc("tie"), F.desc("text")))


def _placed(batch: pa.RecordBatch, slices: np.ndarray, tail: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(slices.astype(np.int32)), pa.array(tail)], [*batch.schema.names, "slice", "tail"])


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how near the two, and the next row's, are.

    The edited text ends with the beginning of the next row's text instead of
    its own last third. Rows follow each other by descending id (null is the
    smallest), then by text; repeated rows follow each other. Null and empty
    texts have an empty fingerprint; two of those are alike. A table of one row
    is followed by itself, an empty one gives no rows.
    """
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        before = None
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            out: dict[str, list] = {name: [] for name in names}
            for own, body, part, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "slice", "tail"))):
                spots = spot_hashes(body, chain)
                if before is not None and before[2] == part:
                    values = compared(*before[:2], before[3], body, spots, chain)
                    for name, value in zip(names, values):
                        out[name].append(value)
                # Of the copies that end a slice one is enough.
                before = None if tail else (own, body, part, spots)
            yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), (
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))})

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return in_order_with_next(rows).mapInArrow(report, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                               "edited_fingerprint string, near_edited double, near_next double")


BATCH_BYTES = 4 << 20


def compared(own: int | None, body: str, spots: np.ndarray, following: str, next_spots: np.ndarray, chain: int = CHAIN) -> tuple:
    third = len(body) // 3
    edited = body[:len(body) - third] + following[:third]
    edited_spots = spot_hashes(edited, chain)
    return (own, len(body), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(spots), fingerprint(edited_spots),
            likeness(spots, edited_spots), likeness(spots, next_spots))
