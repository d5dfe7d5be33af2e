"""Derived web-archive records: metadata and plain text of captured responses.

Each response record gives two records that refer to it: ``metadata`` (``warc-fields``:
title, character set, links, and the source's headers and digest) and ``conversion``
(``text/plain``).  Their ids are name-based, so a repeated run or task gives the same ones.

Defined results: null payload, headers or content type are empty; a null target gives no such
header; a null date is ``UNDATED``, since every record has to state one; repeated responses give
records each, with ids of their own; an empty table gives none; extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, slices, small_side
from postlens.sources.staging import stage, staging_path

VERSION = "WARC/1.1"

# Date of records whose capture date is unknown.
UNDATED = "1970-01-01T00:00:00Z"

# Name space of derived record ids, itself named by what it is for.
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:derived-warc-records")

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html"
    r"|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>",
    re.I,
)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_SPACES = re.compile(r"[^\S\n]+")
_LINES = re.compile(r"\s*\n\s*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(r"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)

COLUMNS = (
    "source_id string, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, source_headers string, source_digest string, block string, block_digest string, content_length long"
)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as archives label it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def plain_text(page: str) -> str:
    """A page's text: hidden parts and tags dropped, character references decoded, a line per block."""
    text = _TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub(" ", page)))
    return _LINES.sub("\n", _SPACES.sub(" ", html.unescape(text))).strip()


def _one_line(text: str) -> str:
    return " ".join(text.split())


def metadata_fields(page: str, headers: str, content_type: str, source_digest: str) -> str:
    """The ``warc-fields`` block of a response."""
    fields = [("source-content-type", content_type), ("source-payload-digest", source_digest)]
    fields += [("source-header", line.strip()) for line in headers.splitlines() if line.strip()]
    title, charset = _TITLE.search(page), _CHARSET.search(page)
    if title:
        fields.append(("title", _one_line(html.unescape(_TAG.sub("", title[1])))))
    if charset:
        fields.append(("charset", charset[1].lower()))
    visible = _HIDDEN.sub(" ", page)
    links = dict.fromkeys(_one_line(html.unescape(a or b or c)) for a, b, c in _LINK.findall(visible))
    fields += [("outlink", link) for link in links]
    return "".join(f"{name}: {value}\r\n" for name, value in fields)


def responses(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: Column | str = UNDATED,
) -> DataFrame:
    """Response records ``(source_id, record_id, target_uri, warc_date, content_type, headers, payload)`` of raw pages.

    ``date`` is when all pages were captured, or a timestamp column of ``pages`` that tells it per
    page (in the session's time zone).  A record's id is named by the page's id, address and content;
    pages that are equal in all of them add their place in the table, so ids are unique.
    """
    # A length before each part, and none for a null: no two different pages spell the same name.
    spelled = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    name = F.md5(F.concat(spelled(F.col(id_col).cast("string")), spelled(F.col(url_col)), spelled(F.md5(F.col(html_col)))))
    size = F.octet_length(F.coalesce(F.col(html_col), F.lit("")))
    if isinstance(date, str):
        when = F.lit(date)
    else:
        when = F.date_format(F.to_utc_timestamp(date, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # Places are given where the table is read, before any exchange, so a repeated task gives the same.
    named = pages.select(
        F.col(id_col).cast("string").alias("source_id"),
        name.alias("name"),
        F.monotonically_increasing_id().alias("place"),
        F.col(url_col).alias("target_uri"),
        F.coalesce(when, F.lit(UNDATED)).alias("warc_date"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string")
        ).alias("headers"),
        F.col(html_col).alias("payload"),
    )
    repeated = pages.select(name.alias("name")).groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
    repeated = small_side(stage(repeated.select("name", F.lit(True).alias("again")), staging_path(pages.sparkSession, "repeated")))
    own = F.when(F.col("again"), F.md5(F.concat_ws(" ", "name", F.col("place").cast("string")))).otherwise(F.col("name"))
    dashed = F.regexp_replace(own, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return named.join(repeated, "name", "left").select(
        "source_id", F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), "target_uri", "warc_date",
        "content_type", "headers", "payload",
    )


def derive(captured: DataFrame) -> DataFrame:
    """Two records per response of ``captured`` (columns as :func:`responses` gives them)."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    source = bounded(captured).select(
        "source_id", text("record_id"), "target_uri", F.coalesce("warc_date", F.lit(UNDATED)).alias("warc_date"),
        text("content_type"), text("headers"), text("payload"),
    )
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = [pa.int64() if c.endswith("long") else pa.string() for c in COLUMNS.split(", ")]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload"):
                rows = []
                for r in part.to_pylist():
                    page, headers = r["payload"], r["headers"]
                    source_digest = digest(page.encode())
                    for kind, content_type, block in (
                        ("metadata", "application/warc-fields", metadata_fields(page, headers, r["content_type"], source_digest)),
                        ("conversion", "text/plain; charset=utf-8", plain_text(page)),
                    ):
                        body = block.encode("utf-8", "replace")
                        rows.append((
                            r["source_id"], kind, record_name(kind, r["record_id"]), r["record_id"], r["target_uri"],
                            r["warc_date"], content_type, headers, source_digest, body.decode(), digest(body), len(body),
                        ))
                columns = zip(*rows, strict=True) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema=schema)

    return source.mapInArrow(work, COLUMNS)


def serialized() -> Column:
    """A derived record as it stands in an archive file: headers, block, two line ends."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.col("warc_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        optional("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit("\r\n\r\n"),
    )
