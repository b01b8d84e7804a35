"""Spelling variants among the words of a corpus, found by k-d trees over letter counts.

A word is the vector of its letter counts. Words of one length that differ by
one replaced letter have vectors at L1 distance 2; a word and one with a letter
more have vectors at distance 1. For each length there is a k-d tree:

1. Its upper part cuts the words of the length into cells. It is fitted on a
   bounded sample (about ``SAMPLE`` words of a length); the boxes of its cells cover
   everything, so each word lies in one cell whatever the sample was.
2. Each word also goes as a query to every cell, of its own length and of the
   next one, whose box is within the distance. A cell is at most two cuts away
   from the word's own for that, so a word goes to few cells.
3. In a cell the tree is continued over its distinct vectors; queries go down
   it together, pruned by the boxes, and the letter order of the words behind
   the vectors found is verified.
Each pair meets in exactly one cell.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, id_and_text
from varloom.staging import staged

BATCH_BYTES = 8 << 20

#: Words that a task counts before it hands the counts on.
HELD_WORDS = 400_000

#: Words of a length that the cuts are fitted on (about; more are never needed), and words that a cell should hold.
SAMPLE = 20_000
CELL_WORDS = 8192
#: Vectors in a leaf of a cell's own tree, and word pairs compared at once.
LEAF, PAIRS = 24, 1 << 19

LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 6, 5, 5, 199

# a-z, then the 64 code points from U+00C0: the alphabet after folding A-Z.
LETTERS = 26 + 64
_RUNS = re.compile("[a-zÀ-ÿ]+").findall


def damaged(run: str, start: int, every: int = EVERY) -> str:
    """The folded run without one code point where ``every`` divides its checksum; ``start``: that of the text before it."""
    h = zlib.crc32(run.encode(), start)
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): occurrences of the words of ``LEAST_LENGTH`` or more code points, over all texts.

    Null texts have no words; a null id is written as nothing before the colon.
    Each task adds up its own words first.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own: dict[str, int] = {}
                # Bytes fold A-Z only.
                for run in _RUNS(body.encode().lower().decode()):
                    own[run] = own.get(run, 0) + 1
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in own.items():
                    word = damaged(run, start)
                    if len(word) >= LEAST_LENGTH:
                        total[word] = total.get(word, 0) + n
            if len(total) > HELD_WORDS:
                yield _counted(total)
                total = {}
        yield _counted(total)

    parts = id_and_text(docs, doc_id, text).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def word_codes(words: list[str], length: int) -> np.ndarray:
    """Letters of words of one length as numbers below ``LETTERS``."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)
    return np.where(raw < 0xC0, raw - 97, raw - (0xC0 - 26)).astype(np.uint8)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    flat = np.bincount((np.arange(n)[:, None] * LETTERS + codes).ravel(), minlength=n * LETTERS)
    return flat.reshape(n, LETTERS).astype(np.int16 if length < 1 << 14 else np.int32)


class Tree:
    """A k-d tree as nested (letter, cut, left, right) with leaf numbers; left has fewer than ``cut`` of the letter."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.leaves: list[np.ndarray] = []
        self.root = self._grow(vectors, np.arange(len(vectors)), leaf)

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, leaf: int):
        if len(rows) > leaf:
            own = vectors[rows]
            letter = int(own.var(axis=0).argmax())
            values = own[:, letter]
            cut = max(int(np.median(values)), int(values.min()) + 1)
            left = values < cut
            if left.any() and not left.all():
                return letter, cut, self._grow(vectors, rows[left], leaf), self._grow(vectors, rows[~left], leaf)
        self.leaves.append(rows)
        return len(self.leaves) - 1

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``queries`` whose distance to the leaf's box is at most ``radius``)."""
        low, high = np.zeros(LETTERS, np.int32), np.full(LETTERS, 1 << 30, np.int32)
        stack = [(self.root, np.arange(len(queries)), np.zeros(len(queries), np.int32), low, high)]
        while stack:
            node, rows, far, low, high = stack.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                yield node, rows
                continue
            letter, cut, left, right = node
            own = queries[rows, letter]
            outside = np.maximum(low[letter] - own, 0) + np.maximum(own - high[letter], 0)
            for child, bottom, top in ((left, low[letter], cut - 1), (right, cut, high[letter])):
                further = far - outside + np.maximum(bottom - own, 0) + np.maximum(own - top, 0)
                keep = further <= radius
                lower, upper = low.copy(), high.copy()
                lower[letter], upper[letter] = bottom, top
                stack.append((child, rows[keep], further[keep], lower, upper))


def fit_cells(words: DataFrame, cell_words: int = CELL_WORDS, sample: int = SAMPLE) -> dict[int, Tree]:
    """The upper tree of each length that occurs; of a length with more than ``sample`` words about so many are read, by hash.

    A length has as many cells as it should need for ``cell_words`` each, but a
    cell holds four words of the sample at least.
    """
    sized = words.groupBy(F.char_length("word").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in sized.collect()}
    share = F.lit(1 << 32)
    for length, n in counts.items():
        if n > sample:
            share = F.when(F.char_length("word") == length, F.lit((sample << 32) // n)).otherwise(share)
    drawn: dict[int, list[str]] = {}
    for row in words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < share).select("word").collect():
        drawn.setdefault(len(row.word), []).append(row.word)
    return {length: Tree(letter_counts(word_codes(found, length)), max(4, cell_words * len(found) // n))
            for length, n in counts.items() for found in [drawn.get(length, [])]}


def dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(length, cell, role, word, n): 0 the words of a cell, 1 and 2 queries of the same length and of one letter less."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = batch.column("word").to_pylist(), batch.column("n")
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                vectors = letter_counts(word_codes([found[i] for i in rows], length))
                for role, tree, radius in ((0, trees.get(length), 0), (1, trees.get(length), 2), (2, trees.get(length + 1), 1)):
                    for cell, hit in tree.within(vectors, radius) if tree else ():
                        at = pa.array(rows[hit])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(hit), length + (role == 2)), pa.int32()), pa.array(np.full(len(hit), cell), pa.int32()),
                             pa.array(np.full(len(hit), role), pa.int32()), batch.column("word").take(at), counts.take(at)],
                            ["length", "cell", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(deal, "length int, cell int, role int, word string, n long")


class Cell:
    """The words of one cell under the continued tree, for batches of queries."""

    def __init__(self, length: int, words: list[str], counts: np.ndarray):
        self.length, self.words, self.counts = length, np.array(words, object), counts
        self.codes = word_codes(words, length)
        self.vectors, members = np.unique(letter_counts(self.codes), axis=0, return_inverse=True)
        self.tree = Tree(self.vectors, LEAF)
        self.order, self.starts = _by_class(members.reshape(-1), len(self.vectors))

    def near(self, role: int, words: list[str], counts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(query word, word of the cell, their counts) of the pairs that one edit turns into each other."""
        codes = word_codes(words, self.length - (role == 2))
        vectors, members = np.unique(letter_counts(codes), axis=0, return_inverse=True)
        order, starts = _by_class(members.reshape(-1), len(vectors))
        radius, names = (2, 1)[role - 1], np.array(words, object)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for leaf, rows in self.tree.within(vectors, radius):
            own = self.tree.leaves[leaf]
            away = np.abs(vectors[rows][:, None, :] - self.vectors[own][None, :, :]).sum(axis=2)
            a, b = np.nonzero(away == radius)
            held.append((rows[a], own[b]))
            size += len(a)
            if size > PAIRS >> 4:
                yield from self._verified(held, role, codes, names, counts, order, starts)
                held, size = [], 0
        yield from self._verified(held, role, codes, names, counts, order, starts)

    def _verified(self, held, role, codes, names, counts, order, starts) -> Iterator[tuple[np.ndarray, ...]]:
        """Pairs of vectors to pairs of words, a bounded number at once, kept where the order of letters fits."""
        if not held:
            return
        a, b = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        wide = np.diff(self.starts)[b]
        many = np.diff(starts)[a] * wide
        ends = np.cumsum(many)
        step = max(1, min(PAIRS, (1 << 23) // self.length))
        for low in range(0, int(ends[-1]) if len(ends) else 0, step):
            flat = np.arange(low, min(low + step, int(ends[-1])))
            pair = np.searchsorted(ends, flat, side="right")
            within = flat - (ends[pair] - many[pair])
            left, right = order[starts[a[pair]] + within // wide[pair]], self.order[self.starts[b[pair]] + within % wide[pair]]
            fits = one_replaced(codes[left], self.codes[right]) if role == 1 else one_more(codes[left], self.codes[right])
            left, right = left[fits], right[fits]
            yield names[left], self.words[right], counts[left], self.counts[right]


def _by_class(members: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    return np.argsort(members, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(members, minlength=count))])


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_more(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is b the word a with one letter more: where they part first, the rest of a follows one place later in b."""
    same = a == b[:, :-1]
    later = a == b[:, 1:]
    ahead = np.cumprod(same, axis=1).sum(axis=1)
    behind = np.cumprod(later[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= a.shape[1]


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, near, near_n) of all pairs of ``words`` (word, n) one edit apart, each pair both ways.

    Words are of the alphabet above and distinct. A cell's words are held by
    its task, its queries pass by in batches.
    """
    trees = fit_cells(words, cell_words)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell, now = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("length", "cell", "role")], axis=1)
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]]) if len(keys) else np.array([0])
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                place, role = tuple(keys[start, :2].tolist()), int(keys[start, 2])
                if place != now:
                    held, cell, now = [], None, place
                part = batch.slice(start, end - start)
                if role == 0:
                    held.append(part)
                    continue
                if cell is None and held:
                    points = pa.Table.from_batches(held)
                    cell = Cell(place[0], points["word"].to_pylist(), points["n"].to_numpy())
                if cell is not None:
                    for a, b, n, m in cell.near(role, part.column("word").to_pylist(), part.column("n").to_numpy()):
                        yield _pairs(a, b, m)
                        if role == 2:
                            yield _pairs(b, a, n)

    cells = dealt(words, trees).repartition("length", "cell").sortWithinPartitions("length", "cell", "role")
    return cells.mapInArrow(search, "word string, near string, near_n long")


def _pairs(words: np.ndarray, near: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(near, pa.string()), pa.array(counts, pa.int64())], ["word", "near", "near_n"])


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    The form is the most frequent near word (ties: the smallest) if it has at
    least ``RATIO`` times the word's occurrences, else null; the root is the
    last of a chain of forms. Null and empty texts have no words, repeated rows
    count again, an empty table gives no rows. Counts grow by ``RATIO`` along a
    chain, so it is short and its ends are found by a few rounds of doubling.
    """
    words = staged(word_counts(docs, doc_id, text).where(F.col("n") >= LEAST_COUNT))
    best = near_words(words, cell_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    fits = -F.col("best.less") >= RATIO * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n")))
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")))
        steps = moved.select("word", "root")
        if moved.where("on").isEmpty():
            break
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# The checksum by half bytes, low half first, over the hexadecimal form of the text.
_TABLE = []
for _half in range(16):
    for _ in range(4):
        _half = _half >> 1 ^ (0xEDB88320 if _half & 1 else 0)
    _TABLE.append(_half)


def sql_crc32(text: str) -> str:
    """A DuckDB expression for the unsigned crc32 of a text."""
    halves = (f"[strpos('0123456789ABCDEF', substr(hex(encode({text})), CAST(i + (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) AS bigint), 1)) - 1 "
              f"FOR i IN range(1, length(hex(encode({text}))) + 1)]")
    step = f"xor(c >> 4, list_extract({_TABLE}, CAST((xor(c, x) & 15) + 1 AS bigint)))"
    return f"xor(list_reduce(list_prepend(4294967295, {halves}), lambda c, x: {step}), 4294967295)"


SPELLING_SQL = f"""
WITH t AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM t),
d AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
h AS (SELECT run, n, {sql_crc32("coalesce(CAST(doc_id AS varchar), '') || ':' || run")} AS h FROM d),
e AS (SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, CAST(h % length(run) AS bigint)) || substr(run, CAST(h % length(run) AS bigint) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS bigint) AS n FROM e WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
c AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
x AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM c),
p AS (SELECT l.word, r.word AS near, r.n AS near_n FROM x AS l JOIN x AS r ON l.i = r.i AND l.a = r.a AND l.b = r.b WHERE l.word <> r.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.a || x.b = w.word UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.a || x.b = w.word),
o AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM p),
f AS (SELECT w.word, CASE WHEN near_n >= {RATIO} * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * n THEN near_n END AS form_n
  FROM w LEFT JOIN o ON w.word = o.word AND k = 1),
s AS (WITH RECURSIVE chain(word, spot, depth) AS (SELECT word, word, 0 FROM f
    UNION ALL SELECT chain.word, f.form, depth + 1 FROM chain JOIN f ON chain.spot = f.word WHERE f.form IS NOT NULL)
  SELECT word, arg_max(spot, depth) AS root FROM chain GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN s ON f.word = s.word"""
