import numpy as np
import pyarrow as pa

from ledgerwatch.llm import common


def test_words_of_slices():
    texts = ["Été  à la\tPlage", None, "", " \n", "x\x0b\x0cY", "né " * 9] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = []
    for part in common.slices(iter([batch]), 7):
        bounds, words = common.words_of(part.column(0))
        words = words.to_pylist()
        got += [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    lower = [(t or "").translate({ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}) for t in texts]
    assert got == [t.split() for t in lower]


def test_slices_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(common, "BYTES_AT_ONCE", 1000)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 400] * 20 + ["b" * 5000])], names=["text"])
    parts = list(common.slices(iter([batch])))
    assert sum(p.num_rows for p in parts) == 21
    assert all(p.num_rows == 1 or p.nbytes <= 1000 for p in parts)


def test_shingles_of_short_texts():
    bounds = np.array([0, 0, 1, 3, 8])
    hashes = np.arange(8, dtype=np.uint64)
    starts, _ = common.shingle_hashes(bounds, hashes, 3)
    assert np.diff(starts).tolist() == [0, 1, 1, 3]


def test_gathered_puts_pieces_together():
    got = common.gathered([b"ab", b"", b"c"], np.array([0, 2, 1, 0]), np.array([0, 2, 2, 4]))
    assert got.to_pylist() == [b"abc", b"", b"ab"]


def test_words_hash_to_what_pandas_has_for_them():
    from pandas.util import hash_array

    words = ["", "a", "abcdefg", "abcdefgh", "é" * 9, "日本語の文章", "x" * 255, "x" * 256, "x" * 5000, *(f"word{k}" * (k % 40) for k in range(500))]
    for array in (pa.array(words * 2), pa.array(words, pa.large_string())[2:300], pa.array([""]), pa.array(["y" * 300])):
        want = hash_array(np.asarray(array.to_pylist(), dtype=object), categorize=False)
        assert (common.word_hashes(array) == want).all()
