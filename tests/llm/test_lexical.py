import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import no_documents, odd_documents

from ledgerwatch.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def by_force(docs, items, k=20):
    """The score of every document for every item, as it is defined."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    count, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        scored = []
        for i, tf, n in held:
            m = 75 + (25 * n * count) // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in terms(text) if t in tf
            )
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=str)


def test_terms():
    import pyarrow as pa

    text = ["The cat's 2nd éÉ-Ä_x", None, "", "...", "A\tB\x7fC d"]
    bounds, words = lexical.terms_of(pa.array(text))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(bounds, bounds[1:])] == [terms(t) for t in text]


@pytest.mark.parametrize("bucket", [7, 4096])
def test_equals_brute_force(spark, texts, bucket, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    docs = list(enumerate(texts)) + [(1000 + k, texts[3]) for k in range(40)] + [(None, texts[3]), (2000, None), (2001, "- -")]
    items = [(k, t[:300]) for k, t in enumerate(texts[:12])] + [(100, "the the of"), (101, None), (102, "?"), (103, "zzzz"), (104, texts[3])]
    got = result(lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)))
    assert got == by_force(docs, items)
    assert {r[0] for r in got}.isdisjoint({101, 102, 103})


def test_queries_in_several_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(lexical, "QUERIES", 3)
    docs, items = list(enumerate(texts)), [(k, t[:200]) for k, t in enumerate(texts[:10])]
    got = result(lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), 4))
    assert got == by_force(docs, items, 4)


def test_bounds_lose_nothing_and_prune():
    """In buckets of random vectors no vector at or above the threshold is dropped, and most others are."""
    rng = np.random.default_rng(2)
    dropped = 0
    for _ in range(60):
        width, n = 30, 200
        weights = rng.integers(0, 9000, width)
        sizes = rng.integers(1, 6, n)
        found = [np.sort(rng.choice(width, s, replace=False)).astype(np.int32) for s in sizes]
        value = rng.integers(1, 10**6, sizes.sum())
        value = value // rng.choice([1, 1, 1, 30], len(value))
        flat = np.concatenate(found)
        norms = np.sqrt(np.bincount(np.repeat(np.arange(n), sizes), weights[flat] * value.astype(float) ** 2))
        row = {
            "ids": np.arange(n).tobytes(), "known": np.ones(n, bool).tobytes(), "sizes": sizes.astype(np.int32).tobytes(),
            "terms": flat.tobytes(), "impacts": value.tobytes(), "longest": float(norms.max()),
        }
        bucket = lexical.Bucket(row, weights)
        asked = rng.choice(width, 4, replace=False)
        repeats = rng.integers(1, 4, 4)
        full = np.zeros(width, np.int64)
        full[asked] = repeats * weights[asked]
        scores = bucket.scores(np.arange(n), full)
        length = math.sqrt(float((repeats**2 * weights[asked]).sum()))
        strength = repeats * np.sqrt(weights[asked])
        order = np.argsort(-strength)
        least = int(np.sort(scores)[-5])
        alive = bucket.survivors(asked[order], strength[order] / max(length, 1e-9), least / max(length, 1e-9))
        if least > 0:
            assert set(np.flatnonzero(scores >= least)) <= set(alive)
            assert (bucket.scores(alive, full) == scores[alive]).all()
            dropped += n - len(alive)
    assert dropped > 60 * 100


def test_odd_rows(spark, texts):
    docs = odd_documents(spark, texts)
    items = spark.createDataFrame([(1, "word"), (1, "word"), (2, texts[0]), (None, texts[1])], ITEMS).selectExpr("*", "1 AS doc_id", "2 AS score")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(lexical.rank(docs, items)) == by_force(rows, [(1, "word"), (2, texts[0]), (None, texts[1])])


def test_equal_scores_go_by_id(spark):
    rng = random.Random(1)
    docs = [(k, "one two three") for k in rng.sample(range(500), 300)] + [(900, "four")]
    got = result(lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "two four")], ITEMS)))
    assert got == by_force(docs, [(1, "two four")])


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a")], ITEMS)
    assert lexical.rank(no_documents(spark), some).collect() == []
    assert lexical.rank(some.withColumnRenamed("item_id", "doc_id"), none).collect() == []
