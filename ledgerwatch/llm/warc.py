"""Derivatives of WARC responses: linked metadata and plain-text conversion records.

A response becomes two records that refer to it by its id: `metadata` holds fields about the page
(title, language, outgoing links), `conversion` its text. Both keep the response's target, date,
source headers and payload digest, and have a digest and length of their own block. All of it is
DataFrame functions on one row, so a crawl of any size is one pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
NAMED = {  # entities that are decoded
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "copy": "©", "reg": "®", "trade": "™",
    "middot": "·", "bull": "•", "hellip": "…", "mdash": "—", "ndash": "–", "laquo": "«", "raquo": "»",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€", "amp": "&",
}
# comments, and elements whose content is no text
HIDDEN = "<!--.*?-->|" + "|".join(
    rf"<{name}\b[^>]*>.*?</{name}[ \t\r\n]*>" for name in ("head", "script", "style", "noscript", "template")
)
LINES = (  # tags that end a line, the common ones first
    "p|br|li|div|td|tr|h[1-6]|ul|ol|dd|dt|dl|th|table|nav|article|section|header|footer|main|aside|body|html|hr|title"
    "|blockquote|pre|option|form|fieldset|figure|address"
)


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(block, "UTF-8"), 256))


def urn(*parts: Column) -> Column:
    """A record id that is a function of its parts."""
    name = F.md5(F.encode(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]), "UTF-8"))
    pieces = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def decoded(text: Column) -> Column:
    """The text with its named entities replaced, looked up where an ampersand stands; others stay."""
    known = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def after(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        mark = F.when(F.contains(part, F.lit(";")), known[name])
        rest = F.substr(part, F.length(name) + 2)
        return F.when(mark.isNotNull(), F.concat(mark, rest)).otherwise(F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), after), ""))

    # through an array, so that the text is worked out once
    return F.transform(F.array(F.split(text, "&")), joined)[0]


def plain_text(html: Column) -> Column:
    """The visible text: a line for each block, single spaces, no blank lines. A tag cut off at the end goes."""
    text = F.regexp_replace(html, f"(?is){HIDDEN}", "")
    text = F.regexp_replace(text, rf"(?i)</?(?:{LINES})\b[^>]*>", "\x01")
    text = F.regexp_replace(text, r"</?[A-Za-z!?][^>]*(?:>|$)", "")
    text = F.regexp_replace(decoded(text), r"[ \t\r\n\f\x{00A0}]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\x01[ \x01]*", "\n"), F.lit(" \n"))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a page table (page_id, url, html): what a crawler would have stored.

    Ids repeat only for rows that are alike in id, address and content. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    size = F.octet_length(payload).cast("string")
    return pages.select(
        urn(F.lit("response"), F.col("page_id"), F.col("url"), F.col("html")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size).alias("headers"),
        payload.alias("payload"),
    )


def fields(payload: Column, text: Column) -> Column:
    """The block of a metadata record: a field on each line."""
    title = F.nullif(F.regexp_extract(payload, r"(?is)<title\b[^>]*>(.*?)</title", 1), F.lit(""))
    lang = F.nullif(F.regexp_extract(payload, r"(?i)<html\b[^>]*\blang=[\x{22}']([A-Za-z-]+)", 1), F.lit(""))
    links = F.regexp_extract_all(payload, F.lit(r"(?i)<a\b[^>]*\bhref=\x{22}([^\x{22}]*)\x{22}"), 1)
    title = F.trim(F.regexp_replace(decoded(title), r"[ \t\r\n\f]+", " "))
    parts = [
        F.concat(F.lit("title: "), title), F.concat(F.lit("languages: "), lang),
        F.concat(F.lit("characters: "), F.length(text).cast("string")),
        F.concat(F.lit("links: "), F.size(links).cast("string")),
    ]
    listed = F.transform(links, lambda link: F.concat(F.lit("outlink: "), decoded(link)))
    return F.concat(F.concat_ws(CRLF, *parts, listed), F.lit(CRLF))


def derive(found: DataFrame) -> DataFrame:
    """Two records for each response (record_id, target_uri, date, headers, payload).

    Returns record_id, type, refers_to, target_uri, date, content_type, source_headers, payload_digest,
    block_digest, content_length and block. refers_to is the response's id and payload_digest the
    digest of what it held. A null payload is an empty one; a response given twice has its records
    twice, under the same ids. Other columns are not read.
    """
    payload = F.coalesce(F.col("payload"), F.lit(""))
    base = found.select(
        "record_id", "target_uri", "date", "headers", payload.alias("payload"), plain_text(payload).alias("text")
    )
    meta, text = fields(F.col("payload"), F.col("text")), F.col("text")
    pair = F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit("application/warc-fields").alias("content_type"), meta.alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.lit("text/plain; charset=utf-8").alias("content_type"), text.alias("block")),
    )
    each = base.select("record_id", "target_uri", "date", "headers", digest(F.col("payload")).alias("payload_digest"), F.inline(pair))
    return each.select(
        urn(F.col("type"), F.col("record_id")).alias("record_id"), "type", F.col("record_id").alias("refers_to"), "target_uri", "date",
        "content_type", F.col("headers").alias("source_headers"), "payload_digest", digest(F.col("block")).alias("block_digest"),
        F.octet_length("block").alias("content_length"), "block",
    )


# --- files --------------------------------------------------------------------------


def header(name: str, value: Column) -> Column:
    """One header line, or nothing if the value is null."""
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def rendered(records: DataFrame) -> DataFrame:
    """(value): records of `derive` as WARC text, without the two line ends that close a record."""
    folded = F.regexp_replace("source_headers", r"\r\n", "\r\n\t")
    lines = [
        header("WARC-Type", F.col("type")), header("WARC-Record-ID", F.col("record_id")), header("WARC-Refers-To", F.col("refers_to")),
        header("WARC-Target-URI", F.col("target_uri")), header("WARC-Date", F.col("date")),
        header("WARC-Payload-Digest", F.col("payload_digest")), header("WARC-Block-Digest", F.col("block_digest")),
        header("WARC-Source-Headers", folded), header("Content-Type", F.col("content_type")),
        header("Content-Length", F.col("content_length").cast("string")),
    ]
    return records.select(F.concat(F.lit(f"WARC/1.0{CRLF}"), F.concat_ws("", *lines), F.lit(CRLF), "block").alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one for each task."""
    rendered(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of every record of text WARC files, cut where a record begins.

    The header map has lower-case names. Blocks are read as UTF-8.
    """
    cut = F.regexp_replace("value", r"^WARC/1\.0\r\n|(?:\r\n)+$", "")
    raw = spark.read.option("lineSep", f"{CRLF}{CRLF}WARC/1.0{CRLF}").text(path).select(cut.alias("value"))
    head = F.regexp_replace(F.substring_index("value", CRLF * 2, 1), r"\r\n\t", "\\\\r\\\\n")
    lines = F.filter(F.split(head, CRLF), lambda line: F.contains(line, F.lit(": ")))
    named = F.map_from_entries(F.transform(lines, lambda line: F.struct(
        F.lower(F.substring_index(line, ": ", 1)), F.substr(line, F.length(F.substring_index(line, ": ", 1)) + 3)
    )))
    block = F.substr(F.col("value"), F.length(F.substring_index("value", CRLF * 2, 1)) + 5)
    return raw.where(F.col("value") != "").select(named.alias("headers"), block.alias("block"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files, as `derive` takes them."""
    found = read_warc(spark, path).where(F.col("headers")["warc-type"] == "response")
    http = F.substring_index("block", CRLF * 2, 1)
    return found.select(
        F.col("headers")["warc-record-id"].alias("record_id"), F.col("headers")["warc-target-uri"].alias("target_uri"),
        F.col("headers")["warc-date"].alias("date"), http.alias("headers"), F.substr(F.col("block"), F.length(http) + 5).alias("payload"),
    )
