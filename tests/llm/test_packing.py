import zlib

import numpy as np
import public_tokenizers
import pytest
from odd_rows import no_documents, odd_documents
from tokenizers import Tokenizer

from ledgerwatch.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def laid_out(rows, capacity):
    """Sequences are gapless and within the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_sequences(spark, texts):
    docs = odd_documents(spark, texts)
    rows = packing.pack_documents(docs, PATH).collect()
    count = laid_out(rows, 1024)
    library = Tokenizer.from_file(PATH)
    given = {}
    for r in docs.select("doc_id", "text").collect():
        given.setdefault(r.doc_id, []).append(library.encode(r.text or "", add_special_tokens=False).ids + [2])
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.piece), []).append(r)
    total = 0
    for doc, copies in given.items():
        ids, total = copies[0], total + sum(map(len, copies))
        first = len(ids) % 1024 or min(len(ids), 1024)
        starts = [0, *range(first, len(ids), 1024)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            for r in pieces[doc, n]:
                assert (r.start, r.length) == (a, b - a)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            assert len(pieces[doc, n]) == len(copies)
        assert (doc, len(starts)) not in pieces
    assert count <= 1.03 * -(-total // 1024) + 1


def test_empty_table(spark):
    assert packing.pack_documents(no_documents(spark), PATH).collect() == []


def test_too_long_an_item(spark):
    items = spark.createDataFrame([(1, 2000)], "item long, length long")
    with pytest.raises(Exception, match="over the capacity"):
        packing.pack(items).collect()


def test_hot_length_and_many_blocks(spark):
    items = spark.range(3000).selectExpr("id AS item", "if(id % 3 = 0, 341, 1 + id * 37 % 700) AS length")
    how = packing.Evolution(block=256)
    rows = packing.pack(items, 1024, how).join(items, "item").collect()
    assert len(rows) == 3000
    total = sum(r.length for r in rows)
    assert laid_out(rows, 1024) <= 1.02 * total / 1024 + 1


def test_children_lose_nothing():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 600, 300).tolist()
    one = packing.best_fit(list(range(300)), sizes, 1024, [])
    other = packing.best_fit(sorted(range(300), key=lambda k: -sizes[k]), sizes, 1024, [])
    child = packing.cross(one, other, sizes, 1024, rng)
    assert sorted(i for own in child for i in own) == list(range(300))
    assert all(sum(sizes[i] for i in own) <= 1024 for own in child)
    best = packing.evolve(sizes, 1024, [one], packing.Evolution(), rng)
    assert len(best) <= min(len(one), len(other))
