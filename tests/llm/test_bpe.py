import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from odd_rows import no_documents, odd_documents
from tokenizers import Tokenizer

from ledgerwatch.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_equals_the_library_on_odd_texts():
    letters = list("ab1 '\n\t  .,sté²½Ⅷ١中\x1c\x1f\x85 ​　᠎ <|>\r\x0b\x00")
    letters += ["'s", "'ll", " 's", "<|endoftext|>", "\U0001f600"]
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 900, " " * 300 + "x", "\n \n" * 40, "", " ", None]
    library = Tokenizer.from_file(PATH)
    lexicon = bpe.Lexicon(memoryview(bpe.build_lexicon(PATH, ["a", "the", "ab"])))
    got = bpe.Encoder(bpe.Tokenizer(PATH), lexicon).encode_all(pa.array(texts)).to_pylist()
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids(g) for g in got] == want


def test_lexicon_knows_its_words_only():
    words = {w.encode(): [k, k + 1] for k, w in enumerate(["a", "ab", "abc", "xbc", "bc", "né"])}
    lexicon = bpe.Lexicon(memoryview(bpe.compile_lexicon(words)))
    assert {w: ids(lexicon.find(w)) for w in words} == words
    assert lexicon.find(b"b") is None and lexicon.find(b"") is None and lexicon.find(b"abcd") is None
    # suffixes are shared: fewer states than letters
    assert len(lexicon.finals) < sum(map(len, words))


def test_round_trip_of_documents(spark, texts):
    docs = odd_documents(spark, texts)
    library = Tokenizer.from_file(PATH)
    got = bpe.round_trip(docs, PATH).collect()
    want = {}
    for row in docs.select("doc_id", "text").collect():
        want.setdefault(row.doc_id, row.text or "")
    assert len(got) == docs.count()
    for row in got:
        assert ids(row.ids) == library.encode(want[row.doc_id], add_special_tokens=False).ids
        assert row.text == want[row.doc_id]


def test_empty_table(spark):
    assert bpe.round_trip(no_documents(spark), PATH).collect() == []


def test_query(spark, sf_dir):
    from ledgerwatch.llm.queries import QUERIES

    library = Tokenizer.from_file(PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row in rows:
        found = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(found)
        assert row.ids_sha256 == hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(found, skip_special_tokens=False).encode()).hexdigest()


def test_decode_replaces_what_is_no_text(spark):
    rows = [(1, np.array([b], "<u4").tobytes()) for b in (0,)] + [(2, None), (3, b"")]
    half = bpe.Tokenizer(PATH).bytes[0xC3]
    rows.append((4, np.array([half], "<u4").tobytes()))
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), PATH).collect()}
    assert got[2] is None and got[3] == "" and got[4] == "�"


def test_letters_alone_are_merged_once_and_need_no_pattern(monkeypatch):
    own, seen, merged = bpe.Encoder(bpe.Tokenizer(PATH), None), [], []
    words_of, merge_all = bpe.words_of, own.tokenizer.merge_all
    monkeypatch.setattr(bpe, "words_of", lambda text: seen.append(text) or words_of(text))
    monkeypatch.setattr(own.tokenizer, "merge_all", lambda words: merged.extend(words) or merge_all(words))
    texts = ["of zyxwv qrstu, and\nzyxwv", "on qrstu zyxwv, or"]
    library = Tokenizer.from_file(PATH)
    assert [ids(g) for g in own.encode_all(pa.array(texts)).to_pylist()] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not {" zyxwv", " qrstu", " and", " or"} & set(seen)
    assert sorted(merged) == sorted(set(merged))
    own.encode_all(pa.array(["a zyxwv\nqrstu"]))
    assert merged.count(b" zyxwv") == 1


def test_words_merged_side_by_side_are_those_merged_alone():
    tokenizer, rng = bpe.Tokenizer(PATH), np.random.default_rng(5)
    words = [bytes(rng.choice(list(b" aeinorst\xc3\xa9"), size).tolist()) for size in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33) for _ in range(60)]
    assert tokenizer.merge_all(words) == [np.array(tokenizer.merge(w), "<u4").tobytes() for w in words]
