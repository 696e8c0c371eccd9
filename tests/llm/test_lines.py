from odd_rows import no_documents, odd_documents

from ledgerwatch.llm import lines


def by_force(rows):
    seen, gone = set(), {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for i, text in order:
        own = text.split("\n")
        for k in range(len(own) - 2):
            three = tuple(own[k : k + 3])
            if not "".join(three).strip(" "):
                continue
            if three in seen:
                gone.setdefault((i, text), set()).update((k, k + 1, k + 2))
            seen.add(three)
    return {(i, t): "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) for i, t in order}


def test_equals_brute_force(spark, texts):
    three = "one line\ntwo lines\nthree lines"
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(900 + k, f"head {k}\n{three}\ntail {k}") for k in range(50)]
    rows += [(960, "\n".join([three] * 4)), (961, "\n\n\n\n"), (962, "a\na\na\na\na"), (963, "b\nc"), (964, "one line\ntwo lines")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = by_force(rows)
    got = {(r.row.doc_id, r.row.text): r for r in lines.dedup(docs).collect()}
    assert {k: r.text for k, r in got.items()} == want
    for (_, t), r in got.items():
        assert r.n_lines == len(t.split("\n"))
        left = len(r.text.split("\n")) if r.n_removed < r.n_lines else 0
        assert r.n_removed == r.n_lines - left


def test_odd_rows(spark, texts):
    docs = odd_documents(spark, texts)
    rows = lines.dedup(docs).collect()
    assert len(rows) == docs.count()
    assert all((r.text is None) == (r.row.text is None) for r in rows)
    # rows given twice are no repeat of each other
    assert all(r.n_removed == rows[0].n_removed for r in rows if r.row.doc_id == rows[0].row.doc_id)
    same = spark.createDataFrame([(None, "a\nb\nc"), (3, "a\nb\nc"), (3, "x\na\nb\nc")], "doc_id long, text string")
    got = {(r.row.doc_id, r.row.text): r.n_removed for r in lines.dedup(same).collect()}
    assert got[None, "a\nb\nc"] == 3 and sorted(got[3, t] for t in ("a\nb\nc", "x\na\nb\nc")) == [0, 3]


def test_empty_table(spark):
    assert lines.dedup(no_documents(spark)).collect() == []
