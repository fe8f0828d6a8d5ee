"""WARC derivatives: each response record gives a metadata record and a plain
text conversion record.

Both refer to their source by WARC-Refers-To (with its target URI and date)
and carry digests of their own block; the source's payload digest and HTTP
header lines are preserved in the metadata block.  One projection per
response, no shuffle.

Defined results: null bodies and null URIs count as empty; a body without
markup is its own text; equal responses get equal record ids (ids are derived
from the source id), other rows different ones; an empty table gives no rows;
further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"

#: Fixed patterns of the conversion, in a form that Java and RE2 read alike.
HIDDEN = (
    r"(?is)<!--.*?-->|<script(?:[\s/][^<>]*)?>.*?</script\s*>|<style(?:[\s/][^<>]*)?>.*?</style\s*>"
    r"|<head(?:[\s/][^<>]*)?>.*?</head\s*>"
)
BREAKS = (
    r"(?i)</?(?:p|div|h[1-6]|li|ul|ol|br|tr|td|th|table|article|section|nav|header|footer|blockquote|pre)(?:[\s/][^<>]*)?>"
)
TAGS = r"<[^<>]*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
TITLE = r"(?is)<title>([^<]*)</title>"
LINKS = r'(?i)<a [^<>]*href="([^"<>]*)"'


def unescape(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def plain_text(html: Column) -> Column:
    """Visible text; block tags break lines, runs of blanks are one."""
    shown = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), BREAKS, "\n"), TAGS, "")
    shown = F.regexp_replace(unescape(shown), r"[ \t\r]+", " ")
    return F.regexp_replace(F.regexp_replace(shown, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of raw pages: (page_id, record_id, target_uri, date,
    http_header, payload, payload_digest)."""
    body = F.coalesce(F.col("html"), F.lit(""))
    header = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(CRLF),
    )
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.sha2(body, 256)).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"),
        F.lit(date).alias("date"),
        header.alias("http_header"),
        body.alias("payload"),
        digest(body).alias("payload_digest"),
    )


def derive(source: DataFrame) -> DataFrame:
    """Metadata and conversion records, two rows for each response."""
    html = F.col("payload")
    links = F.regexp_extract_all(html, F.lit(LINKS), F.lit(1))
    lines = F.split(F.regexp_replace("http_header", r"[\r\n]+$", ""), CRLF)
    fields = F.concat(
        F.concat(F.lit("title: "), F.regexp_replace(unescape(F.regexp_extract(html, TITLE, 1)), r"[\r\n]+", " "), F.lit(CRLF)),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest"), F.lit(CRLF)),
        F.concat(F.lit("source-payload-length: "), F.octet_length(html).cast("string"), F.lit(CRLF)),
        F.array_join(F.transform(lines, lambda x: F.concat(F.lit("source-header: "), x, F.lit(CRLF))), ""),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF))), ""),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(html).alias("block")),
    )
    rows = source.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", F.explode(kinds).alias("k"))
    rows = rows.select(
        "page_id", "k.warc_type", record_id(F.col("k.warc_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri",
        F.col("date").alias("warc_date"), "k.content_type", F.octet_length("k.block").cast("long").alias("content_length"),
        digest(F.col("k.block")).alias("block_digest"), F.col("payload_digest").alias("source_payload_digest"), "k.block",
    )
    head = [
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "warc_date"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"),
        ("Content-Length", "content_length"),
    ]
    parts = [F.lit(f"WARC/1.1{CRLF}")]
    for name, column in head:
        parts += [F.lit(f"{name}: "), F.col(column).cast("string"), F.lit(CRLF)]
    return rows.withColumn("header", F.concat(*parts, F.lit(CRLF)))


def record_bytes(records: DataFrame) -> DataFrame:
    """``records`` with the whole record as it stands in a WARC file."""
    return records.withColumn("record", F.encode(F.concat("header", "block", F.lit(CRLF * 2)), "UTF-8"))
