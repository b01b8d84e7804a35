"""A worker of the byte-level BPE holds each word of its block once."""

import pyarrow as pa
import pyarrow.parquet as pq

from varloom.llm import byte_bpe

NAME = "byte_bpe_multi_50k.tiktoken"


def test_words_at_hand_are_not_cached_again():
    words = {"a": b"1", " cat": b"2", " über": b"3", " 12": b"4", "\n": b"n", ".": b".", ",": b","}
    chunks = byte_bpe.WordChunks(words.__getitem__)
    ids, ends = [c.tolist() for c in byte_bpe.WordChunks(lambda w: words[w].ljust(4, b"\0")).encode(pa.array(["a cat 12", "a über cat."]))]
    assert bytes(ids) == b"1241" + b"32." and ends == [3, 7]
    assert [chunks[c] for c in ("a", " cat", " über", " 12")] == [b"1", b"2", b"3", b"4"]
    assert set(chunks) == {" 12"}


def test_a_word_table_is_read_in_small_batches(tmp_path, monkeypatch):
    monkeypatch.setattr(byte_bpe, "TABLE_ROWS", 2)
    words = ["a", "bc", "d" * 3000, "", "e", "fg", "h"]
    ids = [[5], [6, 7], None, [], [8], [9, 10, 11], [12]]
    (tmp_path / "split=-3").mkdir()
    for k, cut in enumerate((slice(0, 4), slice(4, 7))):
        rows = pa.table({"word": pa.array([w.encode() for w in words[cut]], pa.binary()), "ids": pa.array(ids[cut], pa.list_(pa.int32()))})
        pq.write_table(rows, tmp_path / "split=-3" / f"part-{k}.parquet")
    found = byte_bpe._word_table(str(tmp_path), -3, NAME)
    expected = [i if i is not None else byte_bpe._library(NAME)(w) for w, i in zip(words, ids)]
    assert [found(w) for w in words] == [b"".join(i.to_bytes(4, "little") for i in e) for e in expected]
