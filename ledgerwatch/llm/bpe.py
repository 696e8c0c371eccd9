"""Byte-level BPE encoding and decoding through a memory-mapped transducer lexicon.

Frequent words are compiled into a minimal acyclic automaton: words share prefixes and
suffixes, and the count of words passed on a walk numbers each word, which finds its ids. The
automaton is one file of 32-bit numbers that Spark hands to every executor and tasks map into
memory. Words it lacks are merged exactly, pair by pair in the order of the merge list. The
tokenizer file is a parameter and must be readable on every executor.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import gathered, slices

LEXICON_CHUNKS = 20_000  # most frequent chunks that are compiled; rarer words are merged, with the same ids
CACHE = 500_000  # texts between spaces and words whose ids a task remembers, twice
NEVER = (1 << 31) - 1
SPREAD = 2654435769  # 2^32 over the golden ratio, spreads automaton keys

# The word pattern of the byte-level tokenizer.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# White space by any definition, besides the space and the line end. Where a single space or line
# end stands between two other characters, no word reaches over it: what follows can be encoded on
# its own, with the space before it, or after the line end, which is a word.
RARE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def uneven(text: str) -> bool:
    """Whether some space or line end is not single between two characters that are no white space."""
    return (
        "  " in text or " \n" in text or "\n " in text or "\n\n" in text
        or text[:1] == " " or text[-1:] == " " or RARE.search(text) is not None
    )


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizer:
    """Vocabulary, merges and special tokens of a tokenizer file, and exact merging of one word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.pieces = {i: bytes(letters[c] for c in word) for word, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.pieces |= {i: text.encode() for text, i in self.special.items()}
        of_byte = {piece[0]: i for i, piece in self.pieces.items() if len(piece) == 1}
        self.bytes = [of_byte[b] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.made = np.array([made for _, made in self.merges.values()], np.int32)  # by rank
        self.slots = self._hashed()
        self.cut = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None

    def _hashed(self) -> np.ndarray:
        """The merges as an open hash table: pair, rank."""
        size = 1 << (4 * len(self.merges)).bit_length()
        slots = np.full((size, 2), -1, np.int64)
        for (left, right), (rank, _) in self.merges.items():
            at = (left << 20 | right) * SPREAD >> 12 & (size - 1)
            while slots[at, 0] >= 0:
                at = (at + 1) & (size - 1)
            slots[at] = left << 20 | right, rank
        return slots

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the merge list, NEVER if it is not in it or has a part below 0."""
        out = np.full(left.shape, NEVER, np.int32)
        left, right = left.ravel(), right.ravel()
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[open_].astype(np.int64) << 20 | right[open_]
        at = keys * SPREAD >> 12 & (len(self.slots) - 1)
        flat = out.ravel()
        while len(open_):
            seen = self.slots[at, 0]
            same = seen == keys
            flat[open_[same]] = self.slots[at[same], 1]
            more = ~same & (seen >= 0)
            open_, keys, at = open_[more], keys[more], (at[more] + 1) & (len(self.slots) - 1)
        return out

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words, merged side by side: in each step every word joins its earliest pair."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 8), (8, 16), (16, 32)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for start in range(0, len(rows), 1 << 12):  # what is merged at once stays in a processor's cache
                self._side_by_side(words, rows[start : start + (1 << 12)], sizes, high, out)
        for k in np.flatnonzero(sizes > 32):
            out[k] = np.array(self.merge(words[k]), "<u4").tobytes()
        return out

    def _side_by_side(self, words: list[bytes], rows: np.ndarray, sizes: np.ndarray, width: int, out: list) -> None:
        # linked lists, one in each row; the column behind the last place is their end and has no id
        ids = np.full((len(rows), width + 1), -1, np.int32)
        ids[np.arange(width + 1) < sizes[rows, None]] = np.array(self.bytes, np.int32)[
            np.frombuffer(b"".join(words[k] for k in rows), np.uint8)
        ]
        ranks = np.full(ids.shape, NEVER, np.int32)
        ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        after, before = (np.tile(places.astype(np.int8), (len(rows), 1)) for places in (
            np.minimum(np.arange(1, width + 2), width), np.concatenate([[width], np.arange(width)])
        ))
        while len(rows):
            each = np.arange(len(rows))
            at = ranks.argmin(1)
            best = ranks[each, at]
            live = best < NEVER
            if not live.all():
                done = ids[~live]
                ends = np.cumsum((done >= 0).sum(1)) * 4
                raw, last = done[done >= 0].astype("<u4").tobytes(), 0
                for k, end in zip(rows[~live].tolist(), ends.tolist()):
                    out[k], last = raw[last:end], end
                rows, ids, ranks, after, before, at, best = (x[live] for x in (rows, ids, ranks, after, before, at, best))
                each = each[: len(rows)]
            gone = after[each, at]
            behind, ahead = after[each, gone], before[each, at]
            ids[each, at], ids[each, gone], ranks[each, gone] = self.made[best], -1, NEVER
            after[each, at], before[each, behind] = behind, at
            ranks[each, at] = self.ranks(ids[each, at], ids[each, behind])
            ranks[each, ahead] = self.ranks(ids[each, ahead], ids[each, at])

    def merge(self, word: bytes) -> list[int]:
        """Join the earliest pair of the merge list until none is left, by a heap over a linked list."""
        ids = [self.bytes[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        end, heap = len(ids), []

        def look(k: int) -> None:
            if k >= 0 and after[k] < end and (found := self.merges.get((ids[k], ids[after[k]]))):
                heapq.heappush(heap, (found[0], k, ids[k], ids[after[k]], found[1]))

        for k in range(end):
            look(k)
        while heap:
            _, k, left, right, made = heapq.heappop(heap)
            if ids[k] != left or after[k] >= end or ids[after[k]] != right:
                continue
            gone = after[k]
            ids[k], ids[gone], after[k] = made, -1, after[gone]
            if after[k] < end:
                before[after[k]] = k
            look(before[k])
            look(k)
        return [i for i in ids if i >= 0]


# --- the automaton ------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Words and their ids as a minimal acyclic transducer in one block of 32-bit numbers.

    Words are added in sorted order; as soon as no later word can reach a state it is replaced by
    an equal state seen before. Layout: sizes, a hash table of edges (key, target, words passed),
    the final states, and the ids with their bounds.
    """
    words = sorted(entries)
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # finished states: final, edges

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path: list[list] = [[False, []]]  # the open states of the last word
    last = b""
    for word in words:
        same = len(os.path.commonprefix([last, word]))
        while len(path) > same + 1:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], finish(done)))
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((last[len(path) - 1], finish(done)))
    root = finish(path[0])
    count = [0] * len(states)  # words that can be read from a state; targets come first
    edges = []
    for k, (final, out) in enumerate(states):
        total = int(final)
        for byte, target in out:
            edges.append((k << 8 | byte, target, total))
            total += count[target]
        count[k] = total
    size = 1 << max(4, (2 * len(edges)).bit_length())
    table = np.full((size, 3), -1, np.int32)
    for key, target, passed in edges:
        at = (key * SPREAD >> 8) & (size - 1)
        while table[at, 0] >= 0:
            at = (at + 1) & (size - 1)
        table[at] = key, target, passed
    finals = np.array([final for final, _ in states], np.int32)
    bounds = np.concatenate([[0], np.cumsum([len(entries[w]) for w in words])]).astype(np.int32)
    ids = np.array([i for w in words for i in entries[w]], np.int32)
    head = np.array([size, len(states), len(words), len(ids), root], np.int32)
    return b"".join(x.tobytes() for x in (head, table.ravel(), finals, bounds, ids))


class Lexicon:
    """A compiled lexicon, read where it lies."""

    def __init__(self, block: memoryview):
        numbers = block.cast("B").cast("i")
        size, states, words, ids, self.root = numbers[:5].tolist()
        self.mask, at = size - 1, 5
        self.table, at = numbers[at : at + 3 * size], at + 3 * size
        self.finals, at = numbers[at : at + states], at + states
        self.bounds, at = numbers[at : at + words + 1], at + words + 1
        self.ids = numbers[at : at + ids]

    @staticmethod
    def mapped(path: str) -> Lexicon:
        with open(path, "rb") as file:
            return Lexicon(memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))

    def find(self, word: bytes) -> bytes | None:
        """The ids of a word as little-endian numbers, or None if the lexicon lacks it."""
        table, mask, state, number = self.table, self.mask, self.root, 0
        for byte in word:
            key = state << 8 | byte
            at = (key * SPREAD >> 8) & mask
            while (seen := table[3 * at]) != key:
                if seen < 0:
                    return None
                at = (at + 1) & mask
            state, number = table[3 * at + 1], number + table[3 * at + 2]
        if not self.finals[state]:
            return None
        return self.ids[self.bounds[number] : self.bounds[number + 1]].tobytes()


# --- encoding in tasks --------------------------------------------------------------


def words_of(text: str) -> list[str]:
    """The words of a text by the pattern; the commonest shapes are told without it."""
    body = text[1:] if text[:1] in (" ", "\n") else text
    if body.isalpha():
        return ["\n", body] if text[0] == "\n" else [text]
    if body[-1:] in (".", ",") and body[:-1].isalpha():
        return ["\n", body[:-1], body[-1]] if text[0] == "\n" else [text[:-1], body[-1]]
    return PATTERN.findall(text)


class Remembered:
    """A bounded cache in two generations: a full one becomes the old one, and what is used again stays."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get_all(self, keys: list[str]) -> list[bytes | None]:
        found, old = list(map(self.young.get, keys)), self.old
        if old:
            for k in [k for k, ids in enumerate(found) if ids is None]:
                if (ids := old.get(keys[k])) is not None:
                    found[k] = self.young[keys[k]] = ids
        return found

    def put_all(self, keys: list[str], found: list[bytes]) -> None:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        if max(map(len, keys), default=0) < 64:
            self.young.update(zip(keys, found))
        else:
            self.young.update((key, ids) for key, ids in zip(keys, found) if len(key) < 64)


class Encoder:
    """Ids of texts as little-endian 32-bit numbers."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon | None):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.known = Remembered(CACHE)  # a text between spaces that is one word is remembered once

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts between spaces, each with the space or the line end before it, if one comes before it."""
        forms = list(map(words_of, chunks))
        words = self.looked_up(set(chain.from_iterable(forms)))
        found = [b"".join(map(words.__getitem__, form)) for form in forms]
        self.known.put_all(chunks, found)
        return found

    def looked_up(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words: remembered, from the lexicon, or merged side by side."""
        every = list(words)
        found = self.known.get_all(every)
        new = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(new, self.merged([every[k] for k in new])):
            found[k] = ids
        return dict(zip(every, found))

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not remembered."""
        raw = [word.encode() for word in words]
        found = list(map(self.lexicon.find, raw)) if self.lexicon else [None] * len(raw)
        unseen = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(unseen, self.tokenizer.merge_all([raw[k] for k in unseen])):
            found[k] = ids
        self.known.put_all(words, found)
        return found

    def part(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        form = words_of(text)
        words = self.looked_up(set(form))
        return b"".join(map(words.__getitem__, form))

    def encode(self, text: str) -> bytes:
        """One text, whatever it holds."""
        special = self.tokenizer.special
        if not any(s in text for s in special):
            return self.part(text)
        parts = self.tokenizer.cut.split(text)
        return b"".join(
            np.array([special[p]], "<u4").tobytes() if p in special else self.part(p) for p in parts if p
        )

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Texts cut at their spaces and before their line ends; each distinct chunk is looked up once."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        special = self.tokenizer.special
        odd = {
            k: self.encode(t)
            for k, t in enumerate(texts.to_pylist())
            if not t or uneven(t) or any(s in t for s in special)
        }
        if odd:
            keep = np.ones(len(texts), bool)
            keep[list(odd)] = False
            texts = pc.if_else(pa.array(keep), texts, "")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat, bounds = lists.flatten(), np.asarray(lists.offsets)
        bounds = (bounds - bounds[0]).astype(np.int64)
        coded = flat.dictionary_encode()
        chosen = np.array(coded.indices, np.int64)
        none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        before = pc.if_else(pc.starts_with(coded.dictionary, "\n"), none, space)
        chunks = pc.binary_join_element_wise(before, coded.dictionary, none).to_pylist()
        alpha = np.asarray(pc.ascii_is_alpha(coded.dictionary)).tolist()  # letters alone are one word
        known = self.known.get_all(chunks)
        new = [k for k, ids in enumerate(known) if ids is None]
        plain = [k for k in new if alpha[k]]
        for k, ids in zip(plain, self.merged([chunks[k] for k in plain])):
            known[k] = ids
        new = [k for k in new if not alpha[k]]
        heads = flat.take(pa.array(bounds[:-1])).to_pylist()  # no space comes before the first chunk
        learned = self.learn([chunks[k] for k in new] + heads)
        for k, ids in zip(new, learned):
            known[k] = ids
        own = learned[len(new) :]
        own = [odd.get(k, ids) for k, ids in enumerate(own)]
        chosen[bounds[:-1]] = len(known) + np.arange(len(own))
        return gathered(known + own, chosen, bounds, 4)


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str, lexicon_file: str | None = None) -> Encoder:
    """One for each Python worker, kept over its tasks."""
    lexicon = Lexicon.mapped(SparkFiles.get(lexicon_file)) if lexicon_file else None
    return Encoder(Tokenizer(tokenizer_path), lexicon)


@lru_cache(maxsize=2)
def pieces(tokenizer_path: str) -> list[bytes]:
    """The bytes of each id; ids that stand for nothing have none."""
    known = Tokenizer(tokenizer_path).pieces
    return [known.get(i, b"") for i in range(max(known) + 1)]


def frequent_chunks(docs: DataFrame, text: str = "text", most: int = LEXICON_CHUNKS) -> list[str]:
    """The most frequent texts between spaces, counted over all documents."""
    counted = (
        docs.select(F.explode(F.split(text, "[ \n]")).alias("chunk"))
        .where("length(chunk) BETWEEN 1 AND 40")
        .groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .orderBy(F.desc("n"), "chunk")
        .limit(most)
    )
    return [row.chunk for row in counted.collect()]


def build_lexicon(tokenizer_path: str, chunks: Iterable[str]) -> bytes:
    """The words of the chunks, with and without a space before them, and their merged ids."""
    tokenizer = Tokenizer(tokenizer_path)
    words = {w for c in chunks for form in (c, " " + c) for w in PATTERN.findall(form)}
    return compile_lexicon({w.encode(): tokenizer.merge(w.encode()) for w in words})


def ship_lexicon(docs: DataFrame, tokenizer_path: str, text: str = "text") -> str:
    """Compile the corpus' lexicon and let Spark hand the file to all executors; its name there.

    The file is bounded by LEXICON_CHUNKS, about 3 MB. Executors that join later fetch it too.
    """
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as file:
        file.write(build_lexicon(tokenizer_path, frequent_chunks(docs, text)))
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode(
    docs: DataFrame, tokenizer_path: str, lexicon_file: str | None = None, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, ids): the ids of each whole text as little-endian unsigned 32-bit numbers.

    Ids equal the tokenizer's own without special tokens added; the strings of special tokens in
    a text are encoded as such. A null or empty text has no ids. One row for each input row,
    repeated rows and null ids included; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, lexicon_file)
        for batch in slices(batches):
            ids = own.encode_all(batch.column(1)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    keyed = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, ids binary").withColumnRenamed("id", id)


def decoded(ids: pa.Array, tokenizer_path: str) -> pa.Array:
    """Texts of arrays of ids given as bytes."""
    bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(ids), 0).to_numpy())]) // 4
    flat = np.frombuffer(b"".join(x or b"" for x in ids.to_pylist()), "<u4")
    raw = gathered(pieces(tokenizer_path), flat.astype(np.int64), bounds)
    try:
        texts = raw.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())
    return pc.if_else(pc.is_valid(ids), texts, pa.scalar(None, pa.string()))


def decode(encoded: DataFrame, tokenizer_path: str, id: str = "doc_id") -> DataFrame:
    """(id, ids, text): ids turned back into text, special tokens included; null ids give null.

    Bytes that form no UTF-8 become replacement characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = decoded(batch.column(1), tokenizer_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["id", "ids", "text"])

    keyed = encoded.select(F.col(id).alias("id"), "ids")
    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, ids binary, text string").withColumnRenamed("id", id)


def round_trip(docs: DataFrame, tokenizer_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, text) of every document, encoded with the corpus' lexicon and decoded again in the same task."""
    lexicon = ship_lexicon(docs, tokenizer_path, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, lexicon)
        for batch in slices(batches):
            ids = own.encode_all(batch.column(1)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, decoded(ids, tokenizer_path)], names=["id", "ids", "text"])

    keyed = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, ids binary, text string").withColumnRenamed("id", id)
