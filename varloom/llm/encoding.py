"""Token ids of many texts by the tokenizers library, one call per distinct chunk.

Texts are cut before single spaces that a non-space character follows. Both
kinds of vocabulary used here never form a token, or look ahead, across such a
place, so the ids of a text are those of its chunks in order. Chunks repeat a
lot: Arrow finds the distinct ones of a batch, the library encodes those that
the worker's cache lacks, and numpy gathers the ids.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from varloom.llm.common import tokenizer_path

#: The cache is emptied when it holds so many chunks; this bounds a worker's memory.
CACHE_CHUNKS = 600_000

#: Texts above this many characters are cut at safe places first.
LONG_TEXT = 1 << 22

# Latin letters; other letters go to the library. The dotted capital I is left
# out: folded, it ends in a mark.
_LATIN = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
_LETTERS = re.compile(_LATIN).fullmatch
_SAFE_CUT = re.compile(r"(?= \S)")
LINE = "\0"


class ChunkEncoder(dict):
    """Maps a chunk to its ids as little-endian 32-bit bytes."""

    def __init__(self, name: str):
        super().__init__()
        # Loaded where it is used: the driver plans without the library.
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        #: A normalizer means that white space only separates (and case is folded).
        self.drops_space = self.tokenizer.normalizer is not None
        self.byte_letters = _byte_letters()
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.line = b"" if self.drops_space else self._library("\n")
        self.marks = {mark: self._library(mark) for mark in ".,"}
        self.spaced: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self._encode(chunk)
        return ids

    def _encode(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if plain_letters(chunk[1:] if chunk[0] == " " else chunk):
            return self._word(chunk)
        return self._library(chunk)

    def _library(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, chunk: str) -> bytes:
        """A run of letters is one piece, so the model can take it directly."""
        if self.drops_space:
            folded = chunk.lower() if chunk.isascii() else self.tokenizer.normalizer.normalize_str(chunk)
            if not folded.isalpha():
                return self._library(chunk)
            chunk = folded
        if chunk[0] == " " or not chunk.isascii():
            chunk = chunk.encode().decode("latin-1").translate(self.byte_letters)
        as_bytes = self.as_bytes
        return b"".join([as_bytes[t.id] for t in self.model.tokenize(chunk)])

    def _chunk(self, chunk: str, before: str) -> bytes:
        """Ids of a chunk and of the space or line break before it; a mark after a letter is a token of its own."""
        head = tail = b""
        if chunk[:1] == LINE and not self.drops_space:
            head, chunk, before = self.line, chunk[1:], ""
        if chunk[-1:] in self.marks and len(chunk) > 1 and plain_letters(chunk[-2]):
            chunk, tail = chunk[:-1], self.marks[chunk[-1]]
        if self.drops_space and chunk.isascii() and "<|" not in chunk:
            chunk = chunk.lower()
        return head + self[before + chunk] + tail

    def _after_space(self, chunk: str) -> bytes:
        """Ids of a chunk with the space before it, remembered as a whole."""
        found = self.spaced.get(chunk)
        if found is None:
            found = self.spaced[chunk] = self._chunk(chunk, "" if self.drops_space else " ")
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (no nulls) in order, and where each text's ids end."""
        for cache in (self, self.spaced):
            if len(cache) > CACHE_CHUNKS:
                cache.clear()
        if len(texts) and pc.max(pc.utf8_length(texts)).as_py() > LONG_TEXT:
            return self._encode_long(texts)
        return self._encode_batch(texts.cast(pa.string()))

    def _encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " " if self.drops_space else f" {LINE}"), " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        flat = split.flatten().dictionary_encode()
        codes, chunks = flat.indices.to_numpy(), flat.dictionary
        if self.drops_space:
            table, sizes = _strung([self._after_space(c) for c in chunks.to_pylist()])
        else:
            # Runs of white space may be cut otherwise by the library.
            first, last = bounds[:-1], bounds[1:] - 1
            plain = plain_chunks(chunks)
            others = chunks.filter(pa.array(~plain)).to_pylist()
            odd, loose = np.zeros((2, len(chunks)), bool)
            odd[~plain] = [not c or c[0].isspace() or c[0] == LINE and (len(c) == 1 or c[1].isspace() or LINE in c[1:]) for c in others]
            loose[~plain] = [LINE in c[1:] or c[0:2] == LINE + LINE for c in others]
            if odd.any() or loose.any() or _has_nul(texts):
                at = odd[codes]
                ending = last[at[last] & (last > first)]
                at[ending] = [c != LINE for c in chunks.take(pa.array(codes[ending])).to_pylist()]
                at[first] = [c[:1] == LINE for c in chunks.take(pa.array(codes[first])).to_pylist()]
                at |= loose[codes]
                rows = np.logical_or.reduceat(at, first) | _nul_rows(texts)
                if rows.any():
                    return self._encode_odd(texts, rows)
            opening, places = np.unique(codes[first], return_inverse=True)
            codes = codes.copy()
            codes[first] = len(chunks) + places
            follows = np.zeros(len(chunks) + len(opening), bool)
            follows[codes] = True
            table, sizes = self._values(chunks, plain, follows[:len(chunks)], opening)
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        places = np.repeat(starts[codes] - ends + lengths, lengths)
        places += np.arange(len(places))
        return table[places], np.concatenate([[0], ends])[bounds[1:]]

    def _values(self, chunks: pa.Array, plain: np.ndarray, follows: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``chunks`` (those that ``follows`` marks have a space before them, the others are empty), then of the ``opening`` ones, and how many each has."""
        names = chunks.to_pylist()
        return _strung([self._after_space(c) if f else b"" for c, f in zip(names, follows)] + [self._chunk(names[i], "") for i in opening])

    def _encode_odd(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with runs of spaces are cut one by one, the others as usual."""
        plain, ends = (np.empty(0, "<u4"), np.empty(0, np.int64)) if odd.all() else self._encode_batch(texts.filter(pa.array(~odd)))
        usual, parts = iter(np.split(plain, ends[:-1]) if len(ends) else []), []
        for text, is_odd in zip(texts, odd):
            parts.append(self._one(text.as_py()) if is_odd else next(usual))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate(parts), np.cumsum(sizes)

    def _encode_long(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts, ends, at = [], [], 0
        for text in texts:
            for piece in _pieces(text.as_py()):
                ids, _ = self._encode_batch(pa.array([piece], pa.string()))
                parts.append(ids)
                at += len(ids)
            ends.append(at)
        return np.concatenate(parts), np.array(ends, np.int64)

    def _one(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, _SAFE_CUT.split(text))), "<u4")


def _strung(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(encoded), "<u4"), np.fromiter(map(len, encoded), np.int64, len(encoded)) >> 2


def plain_chunks(chunks: pa.Array) -> np.ndarray:
    """Which chunks are letters, with at most a line break before them and a mark after them."""
    return pc.match_substring_regex(chunks, f"^\\x00?{_LATIN}[.,]?$").to_numpy(zero_copy_only=False)


def _has_nul(texts: pa.Array) -> bool:
    return bool(pc.any(pc.match_substring(texts, LINE)).as_py())


def _nul_rows(texts: pa.Array) -> np.ndarray:
    return pc.match_substring(texts, LINE).to_numpy(zero_copy_only=False)


def _pieces(text: str):
    """A long text in pieces that start at safe places; where none comes, the piece stays whole."""
    start = 0
    while len(text) - start > LONG_TEXT:
        cut = _SAFE_CUT.search(text, start + LONG_TEXT // 2)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def plain_letters(word: str) -> bool:
    """Letters only, which stay letters when folded."""
    return _LETTERS(word) is not None


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def chunk_encoder(name: str) -> ChunkEncoder:
    """One encoder and cache per Python worker and vocabulary."""
    return ChunkEncoder(name)
