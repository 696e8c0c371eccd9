import math
import re
import statistics
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import no_documents, odd_documents
from pyspark.sql import functions as F

from ledgerwatch.llm import perplexity
from ledgerwatch.llm.common import cut_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    words = WORD.findall(text or "")
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for found in places.values() if len(found) > 1 for i in found for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


class Force:
    """Interpolated modified Kneser-Ney as the textbook has it, over strings of bytes."""

    def __init__(self, texts, order):
        self.order = order
        counts = Counter(g for t in texts for g in self.grams(t))
        self.levels = [counts]
        for k in range(order - 1, 0, -1):
            self.levels.insert(0, Counter(g[1:] for g in self.levels[0]))
        self.cuts = [perplexity.discounts(*[sum(c == n for c in level.values()) for n in (1, 2, 3, 4)]) for level in self.levels]
        self.followers = []
        for level in self.levels:
            held = defaultdict(list)
            for g, c in level.items():
                held[g[:-1]].append(c)
            self.followers.append(held)

    def grams(self, text):
        words = WORD.findall(text or "")
        if not words:
            return []
        line = b"\0" * (self.order - 1) + " ".join(words).encode() + b"\0"
        return [line[i : i + self.order] for i in range(len(line) - self.order + 1)]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / 256
        below = self.p(gram[1:])
        held = self.followers[k - 1].get(gram[:-1])
        if not held:
            return below
        d1, d2, d3 = self.cuts[k - 1]
        cut = {0: 0, 1: d1, 2: d2}
        c = self.levels[k - 1].get(gram, 0)
        back = sum(cut.get(x, d3) for x in held) / sum(held)
        return (c - cut.get(c, d3)) / sum(held) + back * below

    def perplexity(self, text):
        grams = self.grams(text)
        return 2 ** (-sum(math.log2(self.p(g)) for g in grams) / len(grams)) if grams else None


def found(frame):
    return {r.row.doc_id: r for r in frame.collect()}


def close(value, want):
    return value is None if want is None else value == pytest.approx(want, rel=1e-3)


@pytest.fixture(scope="module")
def some(texts):
    short = sorted(texts, key=len)[:60]
    return short + ["aaa " * 30, "x", "naïve Ääh — ok", "# $ % a|b <c>", None, "", " \n "]


def test_base_statistics(spark, texts):
    extra = ["a\nb\na\n\n \na \nb", "\t#*$\x0b%&|<> é€\n" * 3, "one two three four five six seven eight " * 3, "a b " * 3, None, ""]
    rows = [*texts, *extra]
    text = pa.array(rows, pa.string())
    bounds, words = cut_words(text)
    codes = np.asarray(words.dictionary_encode().indices, dtype=np.int64)
    got = zip(np.diff(bounds), perplexity.repeated_lines(text), perplexity.words_repeated(codes, bounds))
    want = [base_of(t) for t in rows]
    assert [tuple(map(int, x)) for x in got] == [(w[0], w[3], w[4]) for w in want]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for i, r in found(perplexity.judge(docs)).items():
        assert tuple(r[c] for c in perplexity.BASE) == want[i]
        assert r.base_failed == (want[i][0] < 20 or 100 * want[i][4] > 30 * want[i][0])


@pytest.mark.parametrize("order", [1, 3, 5])
def test_equals_brute_force(spark, some, order):
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    force = Force(some, order)
    model = perplexity.train(docs, order)
    for i, r in found(perplexity.judge(docs, model=model)).items():
        assert close(r.perplexity, force.perplexity(some[i]))


@pytest.mark.parametrize("head", [0, 50])
def test_what_no_task_holds_is_joined(spark, some, head):
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    whole, cut = perplexity.train(docs), perplexity.train(docs, head=head)
    assert len(cut.hashes) <= head < len(whole.hashes)
    columns = ["row", "length", "bits", "milli"]
    same = [sorted(perplexity.score(docs, m).select(*columns).collect(), key=str) for m in (whole, cut)]
    assert same[0] == same[1]


def test_unseen_texts_back_off(spark, some):
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    new = ["ZZ9 plural Z alpha", "the quick brown fox", "\x01\x02 漢字", some[3]]
    force = Force(some, 5)
    other = spark.createDataFrame(list(enumerate(new)), "doc_id long, text string")
    for i, r in found(perplexity.judge(other, model=perplexity.train(docs))).items():
        assert close(r.perplexity, force.perplexity(new[i]))
    # a model of nothing: every byte is as likely as another
    nothing = perplexity.train(no_documents(spark))
    assert all(close(r.perplexity, 256) for r in found(perplexity.judge(other, model=nothing)).values())


def test_held_hashes():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    hashes = perplexity.mixed(keys.astype(np.uint64))
    order = np.argsort(hashes)
    held = perplexity.Held(hashes[order], np.arange(len(keys))[order].astype(np.int32))
    assert (held.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000), keys)
    assert (held.find(other) == -1).all()
    assert (perplexity.Held(hashes[:0], np.zeros(0, np.int32)).find(keys) == -1).all()


def test_counts_are_handed_on_in_portions(spark, some, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, perplexity.counted(docs, 4).collect()))
    monkeypatch.setattr(perplexity, "HELD", 20)
    assert sorted(map(tuple, perplexity.counted(docs, 4).collect())) == want
    force = Force(some, 4)
    assert want == sorted((int.from_bytes(g, "big"), c) for g, c in force.levels[-1].items())


def test_bands(spark):
    rows = [("en", 9, 2000 + k) for k in range(101)] + [(None, 9, 3000 + 2 * k) for k in range(51)] + [("fr", 9, 2500)]
    rows += [("en", 12, 2040)] * 2 + [("fr", 12, 2600)]
    frame = spark.createDataFrame(rows, "lang string, size int, milli long")
    got = {(r.lang, r.size): r for r in perplexity.bands(frame, 4).collect()}
    assert (got["en", 9].low, got["en", 9].high, got["en", 9].n) == (2050 - 100, 2050 + 100, 101)
    assert (got[None, 9].low, got[None, 9].high) == (3050 - 4 * 26, 3050 + 4 * 26)
    # few of their class: around the middle of the language, as wide as their length is elsewhere
    middle = {"en": statistics.median(m for x, _, m in rows if x == "en"), None: 3050, "fr": 2550}
    off = statistics.median(abs(m - middle[x]) for x, size, m in rows if size == 9)
    assert (got["fr", 9].low, got["fr", 9].high) == (2550 - 4 * off, 2550 + 4 * off)
    # few of that length, too: as wide as the widest
    other = statistics.median(abs(m - middle[x]) for x, size, m in rows if size == 12)
    assert got["fr", 12].high == 2550 + 4 * max(off, other)


def test_junk_goes_and_clean_text_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = perplexity.judge(docs).select("row.doc_id", "base_failed", "kept").join(labels, "doc_id").where("NOT base_failed")
    clean, junk = (rows.where(F.col("quality") == q) for q in (1, 0))
    assert clean.where("kept").count() >= 0.99 * clean.count()
    assert junk.where("NOT kept").count() >= 0.2 * junk.count()


def test_odd_rows(spark, texts):
    docs = odd_documents(spark, texts).withColumn("bits", F.lit(1)).withColumn("row", F.lit("x")).withColumn("milli", F.lit(None))
    rows = perplexity.judge(docs).collect()
    assert len(rows) == docs.count()
    assert set(rows[0].row.asDict()) == set(docs.columns) - {"text"}
    by_id = {r.row.doc_id: r for r in rows}
    base = len(texts)
    for k in (0, 1, 3):
        r = by_id[base + k]
        assert r.perplexity is None and r.base_failed and not r.kept and r.n_words == 0
    assert by_id[base + 2].n_words == 1 and by_id[base + 2].perplexity > 1
    assert by_id[base + 4].n_repeat_words == 60_000 and not by_id[base + 4].kept


def test_empty_table(spark):
    assert perplexity.judge(no_documents(spark)).collect() == []
