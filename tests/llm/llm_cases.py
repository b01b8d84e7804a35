"""Rows for the edge-case tests."""

import hashlib

LONG = " ".join(f"w{i}" for i in range(30_000))

#: Nulls, empty and very long texts, ties, repeated rows, odd white space and characters.
EDGE_ROWS = [
    (1, "", "a"), (2, None, "a"), (3, "   \n\t ", None), (4, LONG, "b"), (5, "same text here", "c"), (5, "same text here", "c"),
    (5, "another text under one id", "c"), (6, "same text here", "d"), (None, "a text without an id", "d"), (None, None, None),
    (7, "Ünïcode 日本語 😀 text. And, more\n\nlines  with   runs \n x", "e"), (8, "x" * 5000, "e"), (9, "nul \0 and <|endoftext|> inside", "e"),
]


def texts_of(rows=EDGE_ROWS):
    return [(row[0], row[1] or "") for row in rows]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
