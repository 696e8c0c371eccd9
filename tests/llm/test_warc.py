import hashlib

import duckdb
from pyspark.sql import functions as F

from ledgerwatch.llm import warc

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>'
    '<body><!-- x --><nav><a href="/one?a=1&amp;b=2">One</a></nav><p>First&nbsp;line<br>second <b>bold</b> &lt;i&gt;</p>\n\n<p>Cut <a hr'
)


def rows(spark):
    return spark.createDataFrame(
        [(1, "http://a/", PAGE, "x"), (2, "http://b/", None, "y"), (3, None, "", None), (None, "http://c/", "plain text", None),
         (1, "http://a/", PAGE, "z"), (5, "http://d/", "<p>" + "word " * 50_000 + "</p>", None)],
        "page_id long, url string, html string, type string",
    )


def test_records_are_linked_and_keep_their_source(spark):
    found = warc.responses(rows(spark))
    got = warc.derive(found).collect()
    assert len(got) == 2 * rows(spark).count()
    sources = {r.record_id: r for r in found.collect()}
    for r in got:
        source = sources[r.refers_to]
        assert r.target_uri == source.target_uri and r.source_headers == source.headers
        assert r.payload_digest == "sha256:" + hashlib.sha256(source.payload.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode())
    # repeated rows repeat their records
    assert len({r.record_id for r in got}) == len(got) - 2
    page = {r.type: r.block for r in got if r.target_uri == "http://a/"}
    assert page["conversion"] == "One\nFirst line\nsecond bold <i>\nCut"
    assert page["metadata"].split("\r\n")[:2] == ["title: A & B", "languages: en"]
    assert "outlink: /one?a=1&b=2\r\n" in page["metadata"]


def test_files_round_trip(spark, tmp_path):
    records = warc.derive(warc.responses(rows(spark)))
    warc.write_warc(records, str(tmp_path / "out"))
    back = warc.read_warc(spark, str(tmp_path / "out")).collect()
    want = {r.record_id: r for r in records.collect()}
    assert len(back) == records.count()
    for r in back:
        own = want[r.headers["warc-record-id"]]
        assert r.headers["warc-refers-to"] == own.refers_to and r.headers["warc-type"] == own.type
        assert r.headers["content-length"] == str(own.content_length) and r.headers["warc-block-digest"] == own.block_digest
        assert r.block.rstrip("\r\n") == own.block.rstrip("\r\n")


def test_responses_are_read(spark, tmp_path):
    body = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>Hi</p>"
    text = "".join(
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{k}>\r\nWARC-Target-URI: http://x/{k}\r\n"
        f"WARC-Date: 2026-01-0{k}T00:00:00Z\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
        for k, kind in ((1, "response"), (2, "request"), (3, "response"))
    )
    (tmp_path / "a.warc").write_bytes(text.encode())
    got = sorted(warc.read_responses(spark, str(tmp_path / "a.warc")).collect())
    assert [r.record_id for r in got] == ["<urn:uuid:1>", "<urn:uuid:3>"]
    assert got[0].payload == "<p>Hi</p>" and got[0].headers.endswith("text/html") and got[1].date == "2026-01-03T00:00:00Z"
    texts = warc.derive(warc.read_responses(spark, str(tmp_path / "a.warc"))).where("type = 'conversion'")
    assert {r.block for r in texts.collect()} == {"Hi"}


def test_empty_table(spark):
    assert warc.derive(warc.responses(rows(spark).where(F.lit(False)))).collect() == []


def test_all_queries_with_sql(spark, sf_dir):
    from ledgerwatch.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf_dir)
        cursor = con.execute(sql)
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns), name
        want = sorted(map(repr, cursor.fetchall()))
        assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == want, name
