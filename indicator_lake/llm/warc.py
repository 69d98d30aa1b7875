"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record is a row (warc_headers map, http_headers array, http_status, payload). For each one the builder
makes a metadata record (the source's headers, title, links, payload digest) and a conversion record (plain text),
both linked to it by WARC-Refers-To and to its target. Records keep the source's digests and dates; their own ids
are derived from the source's id, so a repeated build gives the same records.

Everything happens in the task that reads the response: no shuffle, one response at a time.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_lake.llm.html import RAW, START, TEXT, attributes, tokens

# Fixed values of the format.
VERSION = "WARC/1.1"
TEXT_TYPES = ("text/html", "application/xhtml+xml", "text/plain")
SKIPPED = "script style noscript template svg textarea iframe"
BREAKING = (
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
)

_SKIPPED, _BREAKING = frozenset(SKIPPED.split()), frozenset(BREAKING.split())
_SPACE = re.compile(r"[^\S\n]+")

RECORD = (
    "record_type string, warc_headers map<string,string>, content string, refers_to string, target_uri string, "
    "record_id string, block_digest string, content_length long"
)


def digest(data: bytes) -> str:
    """The labelled digest the format uses: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()  # noqa: S324


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def html_parts(html: str) -> tuple[str, dict]:
    """The visible text (a line for each block, spaces squeezed, references decoded), and the page's title and links."""
    parts: list[str] = []
    title, links = None, []
    for kind, tag, found in tokens(html, _SKIPPED | {"title"}):
        if kind == TEXT or (kind == RAW and tag == "title"):
            parts.append(found.replace("\n", " "))
            if kind == RAW and title is None:
                title = _SPACE.sub(" ", unescape(parts[-1])).strip()
        elif tag in _BREAKING:
            parts.append("\n")
        if kind == RAW:
            parts.append("\n" if tag == "title" else " ")
        if kind == START and tag in ("a", "area", "link"):
            known = attributes(found)
            if "href" in known:
                links.append(unescape(known["href"]))
    # line feeds that references stand for are kept apart from the ends of blocks by decoding line by line
    lines = (_SPACE.sub(" ", unescape(line)).strip() for line in "".join(parts).split("\n"))
    return "\n".join(line for line in lines if line), {"title": title, "links": links}


def derivatives(warc: dict[str, str], http: dict[str, str], status: int | None, payload: str | None) -> Iterator[tuple]:
    """The records of one response; the conversion only where the payload is text."""
    payload = payload or ""
    source, uri, date = (warc.get(k) or "" for k in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"))
    kind = (http.get("content-type") or "").split(";")[0].strip().lower()
    own_digest = digest(payload.encode("utf-8", "replace"))
    is_html = kind in TEXT_TYPES[:2]
    text, page = html_parts(payload) if is_html else (payload, None)
    facts = {
        "warc-headers": dict(sorted(warc.items())),
        "http-status": status,
        "http-headers": dict(sorted(http.items())),
        "payload-digest": own_digest,
        "payload-digest-matches": warc.get("WARC-Payload-Digest") in (None, own_digest),
        "payload-length": len(payload.encode("utf-8", "replace")),
        "html": page,
    }
    blocks = [("metadata", "application/json", json.dumps(facts, ensure_ascii=False, sort_keys=True))]
    if kind in TEXT_TYPES:
        blocks.append(("conversion", "text/plain", text))
    for record_type, content_type, content in blocks:
        data = content.encode("utf-8", "replace")
        own = record_id(source, uri, date, record_type)
        headers = {
            "WARC-Type": record_type, "WARC-Record-ID": own, "WARC-Refers-To": source, "WARC-Target-URI": uri,
            "WARC-Date": date, "WARC-Block-Digest": digest(data), "Content-Type": content_type, "Content-Length": str(len(data)),
            "WARC-Source-Payload-Digest": warc.get("WARC-Payload-Digest") or own_digest,
        }
        yield record_type, headers, content, source, uri, own, headers["WARC-Block-Digest"], len(data)


def serialise(headers: dict[str, str], content: str) -> bytes:
    """A record as it stands in a file."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers.items())]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + content.encode("utf-8", "replace") + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], str]:
    """Headers and content of a serialised record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a {VERSION} record: {version[:40]}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])].decode("utf-8")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*(f.split()[0] for f in RECORD.replace("map<string,string>", "map").split(", ")), "record", "page_id"]
    kinds = [pa.string(), pa.map_(pa.string(), pa.string()), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.int64()]
    for batch in batches:
        rows: list[tuple] = []
        for page, warc, http, status, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lower = {k.lower(): v or "" for k, v in http or []}
            known = {k: v for k, v in warc or [] if v is not None}
            for record in derivatives(known, lower, status, payload):
                rows.append((record[0], list(record[1].items()), *record[2:], serialise(record[1], record[2]), page))
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def responses(pages: DataFrame) -> DataFrame:
    """Response records (page_id, warc_headers, http_headers, http_status, payload) of pages (page_id, url, html).

    The table has no capture times, so the date is the epoch; ids follow from the page's id, url and content.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws("\x1f", F.col("page_id").cast("string"), "url", html))
    urn = F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *(F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))),
        F.lit(">"),
    )
    warc = F.create_map(
        F.lit("WARC-Type"), F.lit("response"), F.lit("WARC-Record-ID"), urn,
        F.lit("WARC-Target-URI"), F.coalesce(F.col("url").cast("string"), F.lit("")), F.lit("WARC-Date"), F.lit("1970-01-01T00:00:00Z"),
    )
    http = F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"), F.octet_length(html).cast("string"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), warc.alias("warc_headers"), http.alias("http_headers"), F.lit(200).alias("http_status"), html.alias("payload"))


def derive(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records; one metadata row each, a conversion where it is text.

    A null or empty payload gives an empty text; missing headers count as empty; repeated responses give repeated
    records with the same ids. Columns other than the five of a response are ignored.
    """
    rows = found.select("page_id", "warc_headers", "http_headers", F.col("http_status").cast("int"), "payload")
    return rows.mapInArrow(_build, f"{RECORD}, record binary, page_id long")


def derivative_digests(pages: DataFrame) -> DataFrame:
    """(page_id, record_type, record_id, refers_to, target_uri, block_digest, content_length, record_crc) of pages."""
    return derive(responses(pages)).select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "block_digest", "content_length",
        F.crc32("record").alias("record_crc"),
    )
