import random

import numpy as np
import pytest
from odd_rows import no_documents, odd_documents

from ledgerwatch.llm import runs
from ledgerwatch.llm.queries import told_again


def by_force(words, shortest=12):
    """Every stretch that a period fits and no neighbour extends, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((start, period, length) for (start, length), period in found.items())


def some_texts(rng, alphabet):
    texts = []
    for _ in range(rng.randint(0, 6)):
        n = rng.choice([0, 1, 5, 30, 60, 120])
        words = [rng.randrange(alphabet) for _ in range(n)]
        if n and rng.random() < 0.4:
            first = rng.randrange(n)
            period = 1 + (n - first) // rng.randint(3, 10)
            words = words[:first] + [words[first + (i - first) % period] for i in range(first, n)]
        texts.append(words)
    return texts


@pytest.mark.parametrize("alphabet", [1, 2, 3, 20])
@pytest.mark.parametrize("shortest", [2, 12])
def test_equals_brute_force(alphabet, shortest):
    rng = random.Random(alphabet)
    for _ in range(40):
        texts = some_texts(rng, alphabet)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        codes = np.array([w for t in texts for w in t], np.int64)
        got = [[] for _ in texts]
        for start, end, period in zip(*runs.runs_of(codes, bounds, shortest)):
            r = int(np.searchsorted(bounds, start, side="right") - 1)
            got[r].append((int(start - bounds[r]), int(period), int(end - start)))
        assert got == [by_force(t, shortest) for t in texts]


def test_children_in_several_portions(monkeypatch):
    words = ([1, 2, 1, 2, 1, 2, 3] * 20 + [5] * 40) * 3
    whole = runs.runs_of(np.array(words), np.array([0, len(words)]))
    monkeypatch.setattr(runs, "EXPANDED", 5)
    cut = runs.runs_of(np.array(words), np.array([0, len(words)]))
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert sorted(zip(*(x.tolist() for x in (cut[0], cut[2], cut[1] - cut[0])))) == by_force(words)


def test_collapsed_text(spark):
    twice = "p " + "a b c d e f " * 2 + "q"
    rows = [(0, twice), (1, "x " * 11), (2, "x\t\n " * 12), (3, "a b c"), (4, "a " * 12 + "b " * 12)]
    got = {r.row.doc_id: r for r in runs.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == "p a b c d e f q" and [tuple(r) for r in got[0].runs] == [(1, 12, 6)]
    assert got[1].runs == [] and got[1].text == " ".join("x" * 11)
    assert [tuple(r) for r in got[2].runs] == [(0, 12, 1)] and got[2].text == "x"
    assert got[3].text == "a b c" and got[4].text == "a b"


def test_odd_rows(spark, texts):
    docs = odd_documents(spark, texts)
    rows = runs.find(docs).collect()
    assert len(rows) == docs.count()
    assert set(rows[0].row.asDict()) == set(docs.columns) - {"text"}
    by_text = {r.row.doc_id: r for r in rows}
    base = len(texts)
    assert by_text[base].text is None and by_text[base].n_words == 0
    assert [by_text[base + k].text for k in (1, 2, 3)] == ["", "a", ""]
    assert [tuple(r) for r in by_text[base + 4].runs] == [(0, 60_000, 1)] and by_text[base + 4].text == "word"
    for k, text in enumerate(texts):
        words = text.split()
        want = by_force(words) if len(words) < 2000 else None
        if want is not None:
            assert [(r.start, r.period, r.length) for r in by_text[k].runs] == want


def test_texts_told_again(spark):
    import zlib

    rows = [(k, " ".join(f"w{j}" for j in range(50 + k))) for k in range(60)]
    found = runs.find(spark.createDataFrame(rows, "doc_id long, text string"), told_again).collect()
    for r in found:
        n = 50 + r.row.doc_id
        tens, rest = divmod(zlib.crc32(str(r.row.doc_id).encode()), 10)
        words = list(range(n))
        if rest == 0:
            first = tens % n
            period = 1 + (n - first) // (3 + tens % 8)
            words = [i if i < first else first + (i - first) % period for i in words]
        assert [(x.start, x.period, x.length) for x in r.runs] == by_force(words)
    assert any(r.runs for r in found)
    nameless = runs.find(spark.createDataFrame([(None, "a b c")], "doc_id long, text string"), told_again).collect()
    assert nameless[0].text == "a b c"


def test_empty_table(spark):
    assert runs.find(no_documents(spark)).collect() == []
