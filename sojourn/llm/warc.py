"""WARC derivatives: metadata and plain-text conversion records from response records.

Each response gives a metadata record (its HTTP status and headers, title, digests) and a
conversion record (its text). Both refer to the response by its identifier, keep its target,
date and payload digest, and have identifiers that follow from it, so a repeated run gives
the same records.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.llm.html_text import scan

CRLF = b"\r\n"
VERSION = b"WARC/1.1"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(kind: str, of: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {of}')}>"


def _line(text: str) -> str:
    """One header line: control characters would end it early."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", text).strip()


def write_record(kind: str, record_id: str, fields: list[tuple[str, str]], content_type: str, block: bytes) -> bytes:
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        *fields,
        ("WARC-Block-Digest", digest(block)),
        ("Content-Type", content_type),
        ("Content-Length", str(len(block))),
    ]
    lines = [VERSION, *(f"{k}: {_line(v)}".encode("utf-8", "replace") for k, v in head)]
    return CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF


def read_record(raw: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(header fields, block) of one uncompressed or gzipped record; ValueError if it is none or damaged."""
    try:
        raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    except (OSError, EOFError, zlib.error) as error:
        raise ValueError("damaged compression") from error
    head, found, rest = raw.partition(CRLF + CRLF)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(lines[1:])
    length = int(dict((k.lower(), v) for k, v in fields).get("content-length", len(rest)))
    if length < 0:
        raise ValueError("negative length")
    return fields, rest[:length]


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif colon:
            out.append((name.strip(), value.strip()))
    return out


def read_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """(status, headers, payload as sent) of an HTTP response."""
    head, found, payload = block.partition(CRLF + CRLF)
    lines = head.decode("iso-8859-1").split("\r\n")
    status = re.match(r"HTTP/\S+\s+(\d{3})", lines[0])
    if not found or not status:
        return None, [], block
    return int(status[1]), _fields(lines[1:]), payload


# Codecs that pages come in. Python has others, which are no character sets or do not take every input.
_PAGE_CODECS = re.compile(
    r"ascii|utf-(8|16|32)(-(le|be|sig))?|iso8859-\d+|cp\d+|koi8-[rtu]|mac-[a-z]+|tis-620|ptcp154|kz1048|hz|johab|"
    r"gb(2312|k|18030)|big5(hkscs)?|euc[_-](jp|kr|jis_2004|jisx0213)|shift_jis(_2004|x0213)?|iso2022_(jp(_\d|_2004|_ext)?|kr)"
)


def page_codec(name: str) -> str:
    """The codec of that name if it is one that pages come in, else UTF-8."""
    try:
        found = codecs.lookup(name).name
    except (LookupError, ValueError):
        return "utf-8"
    return found if _PAGE_CODECS.fullmatch(found) else "utf-8"


def _inflated(payload: bytes) -> bytes:
    """Deflate as the standard has it, or raw, as some servers send it."""
    try:
        return zlib.decompress(payload)
    except zlib.error:
        return zlib.decompress(payload, -zlib.MAX_WBITS)


def decoded_body(headers: list[tuple[str, str]], payload: bytes) -> str:
    """The body without transfer and content coding, as text. Broken and unknown codings are left as they are,
    bytes that the character set does not have are replaced."""
    by = {k.lower(): v for k, v in headers}
    if "chunked" in by.get("transfer-encoding", "").lower():
        payload = _joined_chunks(payload)
    # The last coding named was put on last.
    for coding in reversed(by.get("content-encoding", "").lower().split(",")):
        try:
            if coding.strip() in ("gzip", "x-gzip"):
                payload = gzip.decompress(payload)
            elif coding.strip() == "deflate":
                payload = _inflated(payload)
        except (OSError, EOFError, zlib.error):
            break
    charset = re.search(r"charset=[\"']?([\w.:-]+)", by.get("content-type", ""), re.IGNORECASE)
    return payload.decode(page_codec(charset[1]) if charset else "utf-8", "replace")


def _joined_chunks(payload: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = payload.find(CRLF, at)
        size = re.match(rb"[0-9a-fA-F]+", payload[at:end]) if end >= 0 else None
        if not size:
            return b"".join(out) if out else payload
        length = int(size[0], 16)
        if not length:
            return b"".join(out)
        out.append(payload[end + 2 : end + 2 + length])
        at = end + 4 + length


def response_record(url: str | None, body: str | None, key: str, date: str) -> bytes:
    """A response record as a crawler writes it for a fetched page."""
    payload = (body or "").encode("utf-8", "replace")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Target-URI", url or ""), ("WARC-Date", date), ("WARC-Payload-Digest", digest(payload))]
    return write_record("response", derived_id("response", key), fields, "application/http; msgtype=response", http + payload)


def derive(raw: bytes | None) -> list[dict]:
    """The metadata and the conversion record of a response; nothing for other or broken records."""
    try:
        fields, block = read_record(raw or b"")
    except ValueError:
        return []
    by = {k.lower(): v for k, v in fields}
    if by.get("warc-type") != "response" or "warc-record-id" not in by:
        return []
    source, target, date = by["warc-record-id"], by.get("warc-target-uri", ""), by.get("warc-date", "")
    status, headers, payload = read_http(block)
    body = decoded_body(headers, payload)
    payload_digest = by.get("warc-payload-digest") or digest(payload)
    title, blocks = scan(body)
    text = "\n".join(b.text for b in blocks)
    about = [
        ("source-record-id", source),
        ("source-payload-digest", payload_digest),
        ("source-block-digest", by.get("warc-block-digest") or digest(block)),
        ("source-status", str(status or "")),
        *((f"source-header-{k.lower()}", v) for k, v in headers),
        ("title", " ".join(title.split())),
        ("text-characters", str(len(text))),
    ]
    warc_fields = b"".join(f"{k}: {_line(v)}\r\n".encode("utf-8", "replace") for k, v in about)
    kept = [("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Source-Payload-Digest", payload_digest)]
    out = []
    for kind, content_type, part in (
        ("metadata", "application/warc-fields", warc_fields),
        ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")),
    ):
        record_id = derived_id(kind, source)
        out.append(
            {
                "record_type": kind,
                "record_id": record_id,
                "refers_to": source,
                "target_uri": target,
                "content_type": content_type,
                "content_length": len(part),
                "block_digest": digest(part),
                "source_payload_digest": payload_digest,
                "source_status": status,
                "record": write_record(kind, record_id, kept, content_type, part),
            }
        )
    return out


_KINDS = {
    "page_id": pa.int64(), "record_type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(), "target_uri": pa.string(),
    "content_type": pa.string(), "content_length": pa.int64(), "block_digest": pa.string(), "source_payload_digest": pa.string(),
    "source_status": pa.int32(), "record": pa.binary(),
}
_SCHEMA = ", ".join(f"{k} {({'int64': 'long', 'int32': 'int'}).get(str(v), str(v))}" for k, v in _KINDS.items())


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record) with a response record for every page. Its identifier follows from
    page_id and url; the date is the crawl's, which the table does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            records = [response_record(url, body, f"{page_id} {url}", date) for page_id, url, body in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], ["page_id", "record"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per response record: its metadata and its conversion, with the record's bytes.

    Input: page_id and record (one WARC record, plain or gzipped); other columns are not read.
    Null, broken and non-response records give no rows. A page without html has an empty
    conversion. Null ids and repeated rows pass through; an empty table gives an empty result.
    Whole records are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"page_id": page_id} | row
                for page_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for row in derive(raw)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in _KINDS.items()], list(_KINDS))

    return records.select("page_id", "record").mapInArrow(run, _SCHEMA)
