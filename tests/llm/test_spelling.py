"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from varloom.llm import spelling
from varloom.llm.spelling import LETTERS, Tree, letter_counts, near_words, one_more, one_replaced, spelling_variants, word_codes


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(docs):
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            found[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def brute_variants(docs):
    words = brute_words(docs)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()}


def made(seed, n_docs=60):
    """Words that repeat unevenly, with edits of all kinds, anagrams, and letters outside a-z."""
    rng = random.Random(seed)
    letters = "abcdéÿ÷xyz"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(30)]
    words = list(base)
    for w in base:
        for _ in range(4):
            k = rng.randrange(len(w))
            words += [w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:], "".join(rng.sample(w, len(w)))]
    weights = [rng.choice([1, 2, 6, 40, 300]) for _ in words]
    return [(i, " ".join(w.upper() if rng.random() < .1 else w for w in rng.choices(words, weights, k=150)) + rng.choice(["", ".", "1x2"])) for i in range(n_docs)]


@pytest.mark.parametrize("cell_words", [16, 8192])
def test_variants_equal_brute_force(spark, cell_words):
    docs = made(cell_words) + [(7, None), (None, "Wörter wörter " * 9), (8, ""), (9, "straße " * 5000), (9, "straße " * 5000), (10, "stráße straÿe strase " * 50), (11, "ſtrange " * 9),
                                  (12, "kettena " * 6 + "kettenb " * 40 + "kettenbb " * 300)]
    table = spark.createDataFrame([(d, t, "w", 1, 2) for d, t in docs], "doc_id long, text string, word string, n int, cell int").repartition(5)
    found = spelling_variants(table, cell_words=cell_words).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == brute_variants(docs)
    assert any(r.root not in (r.word, r.form) for r in found)


def test_no_words(spark):
    table = spark.createDataFrame([(1, None), (2, "short a b")], "doc_id long, text string")
    assert spelling_variants(table).count() == 0 and spelling_variants(table.limit(0)).count() == 0


def test_many_words_of_one_vector_and_a_sample_of_few(spark, monkeypatch):
    """Anagrams cannot be cut apart; cells fitted on few words still cover all."""
    monkeypatch.setattr(spelling, "PAIRS", 1000)
    rng = random.Random(5)
    words = {"".join(rng.sample("aabbccd", 7)) for _ in range(400)} | {"".join(rng.sample("aabbccde", 8)) for _ in range(400)}
    words |= {"".join(rng.sample("aabbcce", 7)) for _ in range(400)}
    table = spark.createDataFrame([(w, 5 + len(w)) for w in words], "word string, n long")
    found = near_words(table, cell_words=32).collect()
    wanted = {(a, b, 5 + len(b)) for a in words for b in words if a != b and one_edit(a, b)}
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted


def test_boxes_lose_nothing():
    rng = np.random.default_rng(1)
    points, queries = rng.integers(0, 4, (500, LETTERS)) * (rng.random((500, LETTERS)) < .1), rng.integers(0, 4, (80, LETTERS)) * (rng.random((80, LETTERS)) < .1)
    points, queries = points.astype(np.int16), queries.astype(np.int16)
    queries[:40] = points[:40]
    queries[:40, 3] += 1
    tree = Tree(points, 8)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(500))
    for radius in (0, 1, 2, 9):
        met = {(q, p) for leaf, rows in tree.within(queries, radius) for q in rows for p in tree.leaves[leaf]}
        assert {(q, p) for q in range(80) for p in range(500) if abs(queries[q] - points[p]).sum() <= radius} <= met
    assert all(len([leaf for leaf, rows in tree.within(points[i:i + 1], 0)]) == 1 for i in range(500))


def test_letter_order():
    rng = random.Random(2)
    words = ["".join(rng.choice("abÀÿ".lower()) for _ in range(6)) for _ in range(80)]
    longer = ["".join(rng.choice("abÀÿ".lower()) for _ in range(7)) for _ in range(80)] + [words[0] + "a", "b" + words[1]]
    for other, test in ((words, one_replaced), (longer, one_more)):
        pairs = [(a, b) for a in words for b in other]
        a, b = word_codes([p[0] for p in pairs], 6), word_codes([p[1] for p in pairs], len(other[0]))
        assert test(a, b).tolist() == [one_edit(*p) for p in pairs]
    assert letter_counts(word_codes(["aab", "ÿbz"], 3)).sum(axis=1).tolist() == [3, 3]
