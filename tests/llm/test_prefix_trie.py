"""The trie of conversations against a brute-force one."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from varloom.llm import prefix_trie as pt
from varloom.llm.prefix_trie import fattest, placed_turns, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, owner string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        block = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        found[c] = tuple(own.get(block, [])[:h] + turns[h:])
    return found


def brute_trie(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    saved, leaves, children = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * words
            leaves[node[:d]] += children[node] == 0
    return {(min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node)))).encode()).hexdigest())
            for node, own in members.items()}


def made(seed, n_convs, depth, kinds):
    rng = random.Random(seed)
    rows = []
    for c in range(n_convs):
        for t in range(rng.randint(1, depth)):
            rows.append((c * rng.choice([1, 1, 3]) - 9, t, rng.choice(["user", "user", None]), " ".join(["a b", "c", "", "d\te f"][rng.randrange(kinds) % 4:][:2])))
    return list({(r[0], r[1]): r for r in rows}.values())


def compared(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(6)
    found = [tuple(r) for r in prefix_trie(table).collect()]
    assert len(found) == len(set(found)) and set(found) == brute_trie(rows)


@pytest.mark.parametrize("chunk", [64, 2])
def test_trie_equals_brute_force(spark, monkeypatch, chunk):
    """Short chunks make every conversation long."""
    monkeypatch.setattr(pt, "CHUNK", chunk)
    compared(spark, made(chunk, 150, 9, 2) + [(None, 0, "user", "lost"), (400, None, None, None), (420, 0, "user", "x"), (423, 0, "user", "y"), (424, 0, "user", "y")])


def test_long_conversations_that_part_late(spark):
    """A comb, conversations that end within others, exact copies, and a long tail."""
    turn = lambda c, t, x="same": (c, t, "user", x)
    rows = [turn(c, t, "other" if t == c - 1000 else "same") for c in range(1000, 1150, 7) for t in range(c - 1000 + 3)]
    rows += [turn(c, t) for c in (2000, 2001, 2002, 2020) for t in range(200)] + [turn(c, t) for c in (2040, 2041) for t in range(70)]
    compared(spark, rows)


def test_ties_repeated_rows_and_places(spark):
    rows = [(40, 1, "user", "a"), (40, 1, "user", "a"), (40, 1, "user", "a"), (40, None, "user", "z"), (60, 0, "user", "q")]
    compared(spark, rows)
    many = spark.range(5000).select(F.lit(1).alias("conv_id"), F.lit(3).alias("turn"), F.lit("r").alias("role"), F.lit("t t").alias("text")).repartition(8)
    assert sorted(r.pos for r in placed_turns(many).collect()) == list(range(1, 5001))
    hot = [r.pos for r in placed_turns(many.withColumn("turn", F.monotonically_increasing_id())).collect()]
    assert sorted(hot) == list(range(1, 5001))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty).count() == 0
    only = spark.createDataFrame([(None, 1, "user", "a", 1, "x")], SCHEMA)
    assert prefix_trie(only).count() == 0


def test_handles(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    found = spark.createDataFrame(pairs, "a long, b long").select("a", "b", fattest("a", "b").alias("f")).collect()
    for a, b, f in found:
        assert f == max(range(a + 1, b + 1), key=lambda v: v & -v)
