"""The registered queries over the corpus operators, each over its whole table."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import bpe, curves, lexical, lines, near_dup, packing, passages, perplexity, quality, runs, toxicity, vafile, warc
from ledgerwatch.llm.common import documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    model = quality.train(docs, _labels(spark, sf_dir), "quality", _fold(3) != 1, ("n_chars",))
    return quality.score(docs, model, ("n_chars",)).select("row.doc_id", "score").select(
        "doc_id",
        F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return warc.derive(warc.responses(pages))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("row.doc_id", "text", "n_lines", "n_removed")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lexicon = toxicity.train(docs, _labels(spark, sf_dir), "toxic", _fold(4) != 2)
    return toxicity.score(docs, lexicon).select("row.doc_id", "score").select(
        "doc_id",
        F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.groups(documents(spark, sf_dir).select("doc_id", "text"), width=2, percent=80)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0), lambda total, s: total + s["stop"] - s["start"])
    return found.select("row.doc_id", "text", "removed", gone.alias("n_removed"))


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.neighbours(_embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tripped = bpe.round_trip(documents(spark, sf_dir), TOKENIZER)
    return tripped.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op11_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexity.judge(documents(spark, sf_dir).select("doc_id", "lang", "text"))
    return found.select("row.doc_id", *perplexity.BASE, "base_failed", "kept", "perplexity", "lower", "upper")


def told_again(rows: pa.StructArray, bounds: np.ndarray) -> np.ndarray:
    """In texts whose id has a checksum divisible by ten, words that stand for all from some place on.

    A row without an id stays as it is.
    """
    place = np.arange(bounds[-1])
    for r, doc_id in enumerate(rows.field("doc_id").to_pylist()):
        n = int(bounds[r + 1] - bounds[r])
        if doc_id is None or not n:
            continue
        tens, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if rest == 0:
            first = tens % n
            period = 1 + (n - first) // (3 + tens % 8)
            place[bounds[r] + first : bounds[r + 1]] = bounds[r] + first + np.arange(n - first) % period
    return place


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(documents(spark, sf_dir).select("doc_id", "text"), told_again)
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    top = F.array_max(ranked)["run"]
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[top[name].alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical.rank(documents(spark, sf_dir).select("doc_id", "text"), items)


QUERIES = {
    "op1_near_dup": op1_near_dup,
    "op2_neighbours": op2_neighbours,
    "op8_top_k": op8_top_k,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_lines": op5_lines,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op9_passages": op9_passages,
    "op10_bpe": op10_bpe,
    "op11_perplexity": op11_perplexity,
    "op12_runs": op12_runs,
    "op13_lexical": op13_lexical,
}


def _urn(kind: str, *parts: str) -> str:
    joined = " || '|' || ".join([f"'{kind}'", *[f"coalesce(CAST({p} AS VARCHAR), '~')" for p in parts]])
    pieces = " || '-' || ".join(f"substr(md5({joined}), {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {pieces} || '>'"


def _unescaped(text: str) -> str:
    """The entities one after another, the ampersand's own last."""
    for name, mark in sorted(warc.NAMED.items(), key=lambda e: e[0] == "amp"):
        text = "replace({}, '&{};', '{}')".format(text, name, mark.replace("'", "''"))
    return text


def _warc_sql() -> str:
    text = rf"regexp_replace(html, '{warc.HIDDEN}', '', 'gis')"
    text = rf"regexp_replace({text}, '</?(?:{warc.LINES})\b[^>]*>', chr(1), 'gi')"
    text = rf"regexp_replace({text}, '</?[A-Za-z!?][^>]*(?:>|$)', '', 'g')"
    text = rf"regexp_replace({_unescaped(text)}, '[ \t\r\n\f\x{{00A0}}]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\x01[ \x01]*', chr(10), 'g')"
    title = r"nullif(regexp_extract(html, '<title\b[^>]*>(.*?)</title', 1, 'is'), '')"
    title = rf"trim(regexp_replace({_unescaped(title)}, '[ \t\r\n\f]+', ' ', 'g'))"
    return rf"""
        WITH p AS (
            SELECT {_urn("response", "page_id", "url", "html")} AS id, url, coalesce(html, '') AS html FROM pages
        ), t AS (
            SELECT *, trim({text}, ' ' || chr(10)) AS text,
                   regexp_extract_all(html, '<a\b[^>]*\bhref="([^"]*)"', 1, 'i') AS links,
                   {title} AS title, nullif(regexp_extract(html, '<html\b[^>]*\blang=["'']([A-Za-z-]+)', 1, 'i'), '') AS lang
            FROM p
        ), b AS (
            SELECT id, url, html, 'conversion' AS type, 'text/plain; charset=utf-8' AS content_type, text AS block FROM t
            UNION ALL
            SELECT id, url, html, 'metadata', 'application/warc-fields',
                   array_to_string(list_filter(list_concat(
                       ['title: ' || title, 'languages: ' || lang, 'characters: ' || length(text), 'links: ' || len(links)],
                       list_transform(links, lambda x: 'outlink: ' || {_unescaped("x")})), lambda x: x IS NOT NULL), chr(13) || chr(10))
                   || chr(13) || chr(10)
            FROM t
        )
        SELECT CASE type WHEN 'metadata' THEN {_urn("metadata", "id")} ELSE {_urn("conversion", "id")} END AS record_id,
               type, id AS refers_to, url AS target_uri, CAST(NULL AS VARCHAR) AS date, content_type,
               'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
                   || 'Content-Length: ' || strlen(html) AS source_headers,
               'sha256:' || sha256(html) AS payload_digest, 'sha256:' || sha256(block) AS block_digest,
               CAST(strlen(block) AS INTEGER) AS content_length, block
        FROM b
    """


ORACLES: dict[str, str] = {
    "op4_warc": _warc_sql(),
    "op1_near_dup": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), p AS (
            SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0
        ), s AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s FROM p
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), sn AS (
            SELECT s.doc_id, s.s, n.n FROM s JOIN n ON s.doc_id = n.doc_id
        ), link AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM sn a JOIN sn b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id AS d, doc_id AS r FROM documents
            UNION
            SELECT link.y, reach.r FROM reach JOIN link ON link.x = reach.d
        ), c AS (
            SELECT d, min(r) AS component_id FROM reach GROUP BY d
        )
        SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = documents.doc_id AS kept
        FROM documents JOIN c ON c.d = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id
    """,
    "op5_lines": """
        WITH d AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
        ), w AS (
            SELECT doc_id, l, unnest(range(1, greatest(len(l) - 1, 1))) AS i FROM d WHERE text IS NOT NULL
        ), k AS (
            SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS three FROM w
            WHERE trim(l[i] || l[i + 1] || l[i + 2]) <> ''
        ), r AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY three ORDER BY doc_id, i) AS n FROM k
        ), gone AS (
            SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r WHERE n > 1
        ), line AS (
            SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS j FROM d WHERE text IS NOT NULL
        ), kept AS (
            SELECT line.doc_id, string_agg(line.l[line.j], chr(10) ORDER BY line.j) AS text, count(*) AS n
            FROM line ANTI JOIN gone ON line.doc_id = gone.doc_id AND line.j = gone.j GROUP BY line.doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
               CAST(coalesce(len(d.l), 0) AS INTEGER) AS n_lines,
               CAST(coalesce(len(d.l), 0) - coalesce(kept.n, 0) AS INTEGER) AS n_removed
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
    """,
    "op13_lexical": """
        WITH word AS (
            SELECT doc_id, unnest(list_filter(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS t
            FROM documents
        ), tf AS (
            SELECT doc_id, t, count(*) AS tf FROM word GROUP BY doc_id, t
        ), doc AS (
            SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
        ), total AS (
            SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM doc
        ), term AS (
            SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total GROUP BY t, docs
        ), item AS (
            SELECT item_id, t, count(*) AS c FROM (
                SELECT item_id, unnest(list_filter(regexp_split_to_array(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS t
                FROM benchmark) GROUP BY item_id, t
        ), impact AS (
            SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len)) AS v
            FROM tf JOIN doc USING (doc_id), total
        ), score AS (
            SELECT item_id, doc_id, CAST(sum(c * w * v) AS BIGINT) AS score
            FROM item JOIN term USING (t) JOIN impact USING (t) GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                   doc_id, score
            FROM score WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 20
    """,
    "op12_runs": """
        WITH crc AS (
            SELECT doc_id, text, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                range(1, 8 * length(CAST(doc_id AS VARCHAR)) + 1),
                lambda i: CASE WHEN i % 8 = 1 THEN CAST(ascii(substr(CAST(doc_id AS VARCHAR), (i + 7) // 8, 1)) AS BIGINT) ELSE 0 END
            )), lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))) AS c
            FROM documents
        ), w AS (
            SELECT doc_id, xor(c, CAST(4294967295 AS BIGINT)) AS h, list_filter(regexp_split_to_array(
                coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM crc
        ), a AS (
            SELECT doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a,
                   3 + (h // 10) % 8 AS parts
            FROM w
        ), t AS (
            SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i:
                CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END) END AS w
            FROM a
        ), six AS (
            SELECT doc_id, i, array_to_string(w[i + 1 : i + 6], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS i FROM t)
        ), met AS (
            SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.words = y.words AND x.i < y.i
        ), island AS (
            SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 6 + q AS l
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM met) GROUP BY doc_id, q, g
        ), run AS (
            SELECT doc_id, s, l, min(q) AS p FROM island WHERE l >= greatest(12, 2 * q) GROUP BY doc_id, s, l
        ), best AS (
            SELECT doc_id, count(*) AS n_runs, max({'l': l, 's': -s, 'p': -p}) AS top,
                   string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS listed
            FROM run GROUP BY doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s + p, s + l)) AS i FROM run
        ), word AS (
            SELECT doc_id, w, unnest(range(0, n)) AS i FROM t
        ), kept AS (
            SELECT word.doc_id, string_agg(w[word.i + 1], ' ' ORDER BY word.i) AS text
            FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id
        )
        SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(-top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length,
               CAST(-top.p AS BIGINT) AS period, CAST(1000 * top.l // -top.p AS BIGINT) AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM t LEFT JOIN best ON t.doc_id = best.doc_id LEFT JOIN kept ON t.doc_id = kept.doc_id
    """,
    "op8_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
