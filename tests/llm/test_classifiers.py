import random

import numpy as np
import pyarrow as pa
from odd_rows import no_documents, odd_documents
from pyspark.sql import functions as F

from ledgerwatch.llm import quality, toxicity


def auc(labels, scores):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


# --- factorisation machine ----------------------------------------------------------


def test_margins_equal_all_pairs():
    rng = np.random.default_rng(0)
    model = quality.Model(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    bounds, features = np.array([0, 3, 8, 9]), rng.integers(0, 20, 9)
    values = rng.normal(size=9)
    got = quality.margins(model, bounds, features, values)
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        want = model.bias + sum(model.weights[features[i]] * values[i] for i in range(a, b))
        for i in range(a, b):
            for j in range(i + 1, b):
                want += model.vectors[features[i]] @ model.vectors[features[j]] * values[i] * values[j]
        assert abs(got[row] - want) < 1e-9


def test_pairs_are_learned():
    # a label that no single feature tells: whether two of them agree
    rng = np.random.default_rng(1)
    one, two = rng.integers(0, 2, 4000), rng.integers(0, 2, 4000)
    features = np.stack([one, 2 + two], 1).ravel()
    bounds, values = np.arange(0, 8001, 2), np.ones(8000, np.float32)
    labels = (one == two).astype(float)
    model = quality.fit(bounds, features, values, labels, 4)
    found = quality.margins(model, bounds, features, values) > 0
    assert (found == (labels == 1)).mean() > 0.95


def test_quality_of_held_out_rows(spark):
    from ledgerwatch.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op3_quality"](spark, sf_dir).toPandas()
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    both = rows.merge(spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas(), on="doc_id")
    out = both[both.held_out]
    assert auc(out.quality.to_numpy(), out.score.to_numpy()) > 0.97
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_quality_of_odd_rows(spark, sf_dir, texts):
    docs = odd_documents(spark, texts)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, "quality", F.lit(True), ("n_chars", "lang"))
    rows = quality.score(docs, model, ("n_chars", "lang")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.row.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    assert quality.score(no_documents(spark), model, ("n_chars", "lang")).collect() == []


def test_without_labels_the_model_says_one_half(spark, sf_dir, texts):
    docs, none = odd_documents(spark, texts), spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, none, "quality", F.lit(True))
    rows = quality.score(docs, model).collect()
    assert all(abs(r.score - 0.5) < 0.2 for r in rows)


def test_labels_that_contradict_or_repeat(spark):
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.one_label(labels, "quality").collect() == [(1, 0)]


# --- lexicon and automaton ----------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    terms = ["abcab", "abcabcabc", "bca", "cabab", "bcabcabca"]
    automaton = toxicity.TermAutomaton(terms)
    for _ in range(4000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 11)))
        want = sorted((t, d) for t in terms if (d := distance(t, word)) <= toxicity.allowed(t))
        assert automaton.find(word) == want


def test_stems_take_any_ending():
    automaton = toxicity.TermAutomaton(["lowei*", "idiot"])
    assert automaton.find("loweichen") == [("lowei*", 0)] and automaton.find("lowe") == []
    assert automaton.find("idlot") == [("idiot", 1)]
    strict = toxicity.TermAutomaton(["idiot"], frozenset({"idiot"}))
    assert strict.find("idlot") == [] and strict.find("idiot") == [("idiot", 0)]


def evidence(*texts):
    found = toxicity.Finder(["idiot", "worthless"]).evidence(pa.array(texts))
    return [dict(zip(toxicity.FEATURES, row)) for row in found]


def test_context_tells_quotation_from_abuse():
    abuse, quoted, spelled, none, empty, null = evidence(
        "You IDIOT, go away", 'He said "idiot" in court', "such an idlot, worthles", "nothing here", "", None
    )
    assert abuse["exact"] > 0 and abuse["addressed"] > 0 and abuse["quoted"] == 0
    assert quoted["quoted"] > 0 and quoted["exact"] == 0
    assert spelled["misspelled"] > 0.9 and spelled["exact"] == 0
    assert evidence("an 1d10t")[0]["exact"] > 0
    assert not any(none.values()) and not any(empty.values()) and not any(null.values())


def test_learned_terms_need_different_texts(spark):
    rng = random.Random(3)
    plain = [f"plain{k}" for k in range(400)]
    rows = [(0, " ".join(rng.sample(plain, 30))) for _ in range(300)]
    rows += [(1, " ".join([*rng.sample(plain, 30), f"grobi{k % 40}an", "vilest"])) for k in range(80)]
    rows += [(1, " ".join([*plain[:30], "copied"]))] * 60
    terms = toxicity.learned_terms(spark.createDataFrame(rows, "label int, text string"))
    assert "vilest" in terms and "copied" not in terms
    assert any(t.startswith("grob") and t.endswith("*") for t in terms)


def test_near_misses_that_are_other_words_do_not_count(spark):
    rows = [(0, f"the other one {k}") for k in range(30)] + [(1, f"you moron, such a looser {k}") for k in range(20)]
    sample = spark.createDataFrame(rows, "label int, text string")
    assert toxicity.terms_as_written(sample, ["loser", "moron"]) == frozenset()
    rows += [(0, f"the loger and the moser {k}") for k in range(30)] + [(0, "a maron tree")] * 3
    sample = spark.createDataFrame(rows, "label int, text string")
    assert toxicity.terms_as_written(sample, ["loser", "moron"]) == {"loser", "moron"}


def test_toxicity_scores(spark, sf_dir, texts):
    docs = odd_documents(spark, [*texts, "You stupid pathetic moron, worthless scum", "you stupld m0ron"])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = toxicity.train(docs, labels, "toxic", F.lit(True))
    rows = {r.row.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert rows[len(texts)] > 0.5 and rows[len(texts) + 1] > rows[len(texts) + 2]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    untaught = toxicity.train(docs, none, "toxic", F.lit(True))
    assert {r.row.doc_id: r.score for r in toxicity.score(docs, untaught).collect()}[len(texts)] > 0.5
    assert toxicity.score(no_documents(spark), lexicon).collect() == []
