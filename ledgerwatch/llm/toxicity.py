"""Toxicity scores from a lexicon whose terms are also found when they are misspelled.

The lexicon's terms form a trie. Its product with the Levenshtein automata of the terms is one
automaton that reads a word and tells which terms are within their distance; its states are sets
of (trie node, edits so far) and are worked out when a word first reaches them. Around each hit a
window of words tells quotation from abuse: quote marks and words of reporting against words that
address someone. A small logistic model weighs the evidence.

Terms are a list of common insults and whatever words, or stems of words, the labels show to be much
more frequent in toxic texts, near copies of a text counting as one. A stem stands for any ending. Of
terms whose near misses are words that other texts have as well, no misspellings count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm.common import slices
from ledgerwatch.llm.quality import sample_labels, sigmoid
from ledgerwatch.session import settle

TRAIN_ROWS = 20_000  # bound on the labelled rows that are learned from
TERMS = 512  # bound on the terms learned
LEAST_TEXTS = 5  # different toxic texts that a learned term must be in
STEMS = (4, 5, 6, 7, 8)  # letters of a stem that any ending may follow
MARKED = 20  # times as frequent in toxic texts as in others, for a learned term
WINDOW = 8  # words on either side of a hit
REMEMBERED = 200_000  # words whose hits a task remembers

# Common insults of English, as a base for corpora without labels.
INSULTS = (
    "idiot", "idiots", "idiotic", "imbecile", "moron", "morons", "moronic", "stupid", "stupidity", "dumbass",
    "loser", "losers", "scum", "scumbag", "trash", "clown", "pathetic", "worthless", "disgusting", "vermin",
    "bastard", "bitch", "asshole", "fuck", "fucking", "fucker", "shit", "shithead", "bullshit", "cunt", "whore",
    "slut", "retard", "retarded", "dickhead", "wanker", "twat", "prick", "jackass", "douchebag", "degenerate",
)
QUOTES = "\"“”„«»‹›`"
REPORTING = frozenset(
    "said says saying quote quoted quotes wrote writes written called calls word words term terms phrase"
    " title titled cited insult insults slur slurs dit disait mot mots sagte wort zitat dijo palabra".split()
)
ADDRESSING = frozenset("you your youre you're yourself u ur ya tu toi te vous du dich dir ihr tú te usted eres".split())
FEATURES = ("exact", "misspelled", "quoted", "addressed", "share", "terms")
PRIOR = np.array([-3.5, 2.0, 1.0, -0.5, 0.5, 1.0, 0.5])  # bias first; the weights where nothing is learned
STRENGTH = 0.1  # pull towards the prior


LEET = str.maketrans("013457@$", "oieastas")  # marks that stand for letters
NEAR = 5  # times as frequent in toxic texts, for the near misses of a term to count


def allowed(term: str) -> int:
    """Edits that a misspelling may have: short terms would turn into other words."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TermAutomaton:
    """The trie of the terms crossed with their Levenshtein automata, worked out as it is used."""

    def __init__(self, terms: list[str], as_written: frozenset[str] = frozenset()):
        self.edits = {t: 0 if t in as_written or t.endswith("*") else allowed(t) for t in terms}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.most = [0]  # edits that some term below a node allows
        self.stems: list[str | None] = [None]
        for term in sorted(set(terms)):
            stem = term.endswith("*")
            node, edits = 0, self.edits[term]
            self.most[0] = max(self.most[0], edits)
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stems.append(None)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], edits)
            if stem:
                self.stems[node] = term
            else:
                self.ends[node] = term
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, best: dict[int, int]) -> int:
        """The number of a state: fewest edits by node, letters of the term left out included; -1 if dead."""
        queue = list(best)
        while queue:
            node = queue.pop()
            for child in self.children[node].values():
                if best[node] < self.most[child] and best[node] + 1 < best.get(child, 99):
                    best[child] = best[node] + 1
                    queue.append(child)
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        best: dict[int, int] = {}
        for node, edits in self.sets[state]:
            moves = [(node, edits + 1)]  # a letter too many
            moves += [(child, edits + (own != letter)) for own, child in self.children[node].items()]
            for to, cost in moves:
                if cost <= self.most[to] and cost < best.get(to, 99):
                    best[to] = cost
        return self._state(best)

    def find(self, word: str) -> list[tuple[str, int]]:
        """(term, edits) for every term within its distance of the word, or a stem that begins it."""
        state, node = self.start, 0
        for letter in word[: max(STEMS)]:
            node = self.children[node].get(letter)
            if node is None:
                break
            if self.stems[node]:
                return [(self.stems[node], 0)]
        for letter in word:
            step = self.steps[state].get(letter)
            if step is None:
                step = self.steps[state][letter] = self._step(state, letter)
                if len(self.steps[state]) > 4096:  # a corpus of many scripts
                    self.steps[state].clear()
            if step < 0:
                return []
            state = step
        return sorted(
            (self.ends[node], edits)
            for node, edits in self.sets[state]
            if self.ends[node] is not None and edits <= self.edits[self.ends[node]]
        )


@dataclass
class Lexicon:
    """Terms (a stem ends in a star), and the weights of the evidence (bias first)."""

    terms: list[str]
    as_written: frozenset[str] = frozenset()  # terms of which no misspellings count
    weights: np.ndarray = field(default_factory=PRIOR.copy)


PART = re.compile(r"[^\W_]+(?:['’@$][^\W_]+)*")


class Finder:
    """Hits in words, remembered by word."""

    def __init__(self, terms: list[str], as_written: frozenset[str] = frozenset()):
        self.automaton, self.known = TermAutomaton(terms, as_written), {}

    def hits(self, chunk: str) -> list[tuple[str, int]]:
        """The nearest term of each word in a text without white space, whatever marks are around."""
        found = self.known.get(chunk)
        if found is None:
            found = []
            for word in PART.findall(chunk):
                near = self.automaton.find(word)
                if (plain := word.translate(LEET)) != word:
                    near = near + self.automaton.find(plain)
                if near:
                    found.append(min(near, key=lambda hit: (hit[1], hit[0])))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(chunk) < 64:
                self.known[chunk] = found
        return found

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """A row of FEATURES for each text; null and empty texts have none."""
        texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
        lists = pc.utf8_split_whitespace(texts)
        bounds = np.asarray(lists.offsets)
        bounds = (bounds - bounds[0]).astype(np.int64)
        flat = lists.flatten()
        coded = pc.dictionary_encode(flat)
        chunks = coded.dictionary.to_pylist()
        found = [self.hits(chunk) for chunk in chunks]
        hit = np.fromiter((bool(f) for f in found), bool, len(found))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        places = np.flatnonzero(hit[codes]) if len(codes) else np.zeros(0, np.int64)
        out = np.zeros((len(texts), len(FEATURES)))
        rows = np.searchsorted(bounds, places, side="right") - 1
        terms: dict[int, set] = {}
        for place, row in zip(places.tolist(), rows.tolist()):
            low, high = bounds[row], bounds[row + 1]
            before = [chunks[c] for c in codes[max(low, place - WINDOW) : place]]
            after = [chunks[c] for c in codes[place + 1 : min(high, place + 1 + WINDOW)]]
            quoted, addressed = context(before, chunks[codes[place]], after)
            for term, edits in found[codes[place]]:
                terms.setdefault(row, set()).add(term)
                if quoted:
                    out[row, 2] += 1
                else:
                    out[row, 0 if not edits else 1] += 1
                    out[row, 3] += addressed
        words = np.maximum(np.diff(bounds), 1)
        out[:, 4] = np.minimum(1.0, 20 * out[:, :2].sum(1) / words)
        for row, own in terms.items():
            out[row, 5] = len(own) if out[row, :2].any() else 0
        out[:, [0, 1, 2, 3, 5]] = np.log1p(out[:, [0, 1, 2, 3, 5]])
        return out


def context(before: list[str], chunk: str, after: list[str]) -> tuple[bool, bool]:
    """Whether a hit is quoted (marks on both sides, or a mark and a word of reporting near), and
    whether someone is addressed near it."""
    opened = any(c[:1] in QUOTES for c in before + [chunk] if c) or chunk[:1] in "'‘"
    closed = any(c.rstrip(".,;:!?")[-1:] in QUOTES for c in [chunk] + after if c.rstrip(".,;:!?")) or chunk[-1:] in "'’"
    near = {c.strip(".,;:!?()" + QUOTES) for c in before + after}
    reported = bool(near & REPORTING)
    quoted = (opened and closed) or (reported and (opened or closed))
    return quoted, bool(near & ADDRESSING)


def learned_terms(sample: DataFrame) -> list[str]:
    """Words of at least four letters, or stems of them, that are much more frequent in toxic texts of the sample (text, label).

    Counted over distinct sketches of a text, so that copies and near copies count once.
    """
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}'’]+"))
    least = [F.expr(f"array_min(transform(words, w -> xxhash64(w, {salt})))") for salt in range(3)]
    sketch = F.concat_ws("-", *[part.cast("string") for part in least])
    texts = sample.where("text IS NOT NULL").select("label", words.alias("words")).select(
        "label", sketch.alias("sketch"), "words"
    ).dropDuplicates(["label", "sketch"])
    totals = texts.agg(F.count_if(F.expr("label = 1")).alias("t"), F.count_if(F.expr("label = 0")).alias("c")).first()
    if not totals.t:
        return []
    # each text's words of four letters or more, and the stems that its words begin with
    forms = F.expr(
        "array_distinct(flatten(transform(filter(words, w -> length(w) >= 4),"
        f" w -> concat(array(w), transform(sequence({min(STEMS)}, {max(STEMS)}),"
        " n -> if(length(w) > n, concat(left(w, n), '*'), w))))))"
    )
    counts = (
        texts.select("label", F.explode(forms).alias("form"))
        .groupBy("form").agg(F.count_if(F.expr("label = 1")).alias("t"), F.count_if(F.expr("label = 0")).alias("c"))
        .where(F.col("t") >= max(LEAST_TEXTS, totals.t * 0.002))
        .where((F.col("t") / totals.t) >= MARKED * (F.col("c") + 0.5) / (totals.c + 1))
        .orderBy(F.desc("t"), "form").limit(8 * TERMS)
    )
    return chosen_terms([(row.form, row.t) for row in counts.collect()])


def chosen_terms(counted: list[tuple[str, int]]) -> list[str]:
    """Stems that many endings share, and the words that begin with none of them; TERMS at most.

    A stem is worth more than its words if it is in half as many texts again as any of them.
    """
    most: dict[str, int] = {}
    for form, texts in counted:
        if not form.endswith("*"):
            for n in STEMS:
                most[form[:n] + "*"] = max(most.get(form[:n] + "*", 0), texts)
    stems: list[str] = []
    for form, texts in sorted(counted, key=lambda x: (len(x[0]), x[0])):
        if form.endswith("*") and texts >= 1.5 * most.get(form, 0) and not form.startswith(tuple(s[:-1] for s in stems)):
            stems.append(form)
    covered = tuple(s[:-1] for s in stems)
    words = [form for form, _ in counted if not form.endswith("*") and not form.startswith(covered)]
    return sorted((stems + words)[:TERMS])


def terms_as_written(sample: DataFrame, terms: list[str]) -> frozenset[str]:
    """Terms whose near misses are other words: the sample has them in other texts about as often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        for batch in slices(batches):
            found = [
                (label, term)
                for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist())
                for term in {t for chunk in (text or "").lower().split() for t, edits in finder.hits(chunk) if edits}
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int32()), pa.array([t for _, t in found], pa.string())], names=["label", "term"]
            )

    ones, all_ = sample.agg(F.count_if(F.expr("label = 1")), F.count(F.lit(1))).first()
    counts = sample.select("label", "text").mapInArrow(run, "label int, term string").groupBy("term").agg(
        F.count_if(F.expr("label = 1")).alias("t"), F.count_if(F.expr("label = 0")).alias("c")
    )
    # at most a row for each term
    return frozenset(
        r.term for r in counts.collect() if r.c >= 2 and r.t / max(ones, 1) < NEAR * r.c / max(all_ - ones, 1)
    )


def fit_weights(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn to the prior."""
    x = np.concatenate([np.ones((len(rows), 1)), rows], 1)
    weights = PRIOR.copy()
    for _ in range(25 if len(rows) else 0):
        p = sigmoid(x @ weights)
        pull = np.full(len(PRIOR), STRENGTH)
        gradient = x.T @ (p - labels) + pull * (weights - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, most: int = TRAIN_ROWS) -> Lexicon:
    """Terms and weights from the labelled rows that `learn_from` allows, `most` at most."""
    chosen = sample_labels(labels, label, learn_from, most)
    text = F.col("text").cast("string").alias("text")
    sample = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    sample, _ = settle(sample)
    terms = sorted({*INSULTS, *learned_terms(sample)})
    as_written = terms_as_written(sample, terms)
    kind = sample.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms, as_written)
        for batch in slices(batches):
            found = finder.evidence(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *[pa.array(found[:, k]) for k in range(len(FEATURES))]],
                names=["doc_id", "label", *FEATURES],
            )

    columns = ", ".join(f"{name} double" for name in FEATURES)
    table = sample.select("doc_id", "text", "label").mapInArrow(run, f"doc_id {kind}, label int, {columns}").toArrow().sort_by("doc_id")
    rows = np.stack([table[name].to_numpy() for name in FEATURES], 1) if table.num_rows else np.zeros((0, len(FEATURES)))
    return Lexicon(terms, as_written, fit_weights(rows, table["label"].to_numpy().astype(float)))


def score(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """All columns of the rows, nested as `row`, and the score from 0 to 1. Empty and null texts get that of no hit."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most TERMS and the fixed list
    inputs = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, weights = Finder(held.value.terms, held.value.as_written), held.value.weights
        for batch in slices(batches):
            values = sigmoid(weights[0] + finder.evidence(batch.column("text")) @ weights[1:])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values, pa.float64())], names=["row", name])

    schema = T.StructType([inputs.schema["row"], T.StructField(name, T.DoubleType())])
    return inputs.mapInArrow(run, schema)
