import base64
import gzip
import hashlib
import uuid
import zlib
from html import unescape
from html.parser import HTMLParser

import pytest

from conftest import TABLES
from sojourn.llm import warc
from sojourn.llm.queries import QUERIES

DATE = "2024-01-02T03:04:05Z"


def response(http, **more):
    fields = [("WARC-Target-URI", "http://a.b/"), ("WARC-Date", DATE), *more.items()]
    return warc.write_record("response", "<urn:uuid:1>", fields, "application/http; msgtype=response", http)


def test_records_link_to_their_source_and_keep_its_headers():
    http = b"HTTP/1.1 404 Not Found\r\nServer: x\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<title>T\n t</title><p>caf\xe9 &amp; co</p><p>two"
    rows = warc.derive(response(http, **{"WARC-Payload-Digest": "sha1:ABC"}))
    assert [r["record_type"] for r in rows] == ["metadata", "conversion"]
    for row in rows:
        fields, block = warc.read_record(row["record"])
        by = dict(fields)
        assert by["WARC-Refers-To"] == "<urn:uuid:1>" and by["WARC-Target-URI"] == "http://a.b/" and by["WARC-Date"] == DATE
        assert by["WARC-Source-Payload-Digest"] == "sha1:ABC" and by["WARC-Record-ID"] == row["record_id"]
        assert by["WARC-Block-Digest"] == warc.digest(block) and int(by["Content-Length"]) == len(block)
    about = dict(warc._fields(warc.read_record(rows[0]["record"])[1].decode().split("\r\n")))
    assert about["source-status"] == "404" and about["source-header-server"] == "x" and about["title"] == "T t"
    assert about["source-payload-digest"] == "sha1:ABC" and about["source-record-id"] == "<urn:uuid:1>"
    assert warc.read_record(rows[1]["record"])[1].decode() == "café & co\ntwo"
    assert rows == warc.derive(response(http, **{"WARC-Payload-Digest": "sha1:ABC"}))


def test_codings():
    page = b"<p>text of the page</p>"
    zipped = gzip.compress(page, mtime=0)
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in (zipped[:7], zipped[7:])) + b"0\r\n\r\n"
    head = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert warc.read_record(warc.derive(response(head + chunks))[1]["record"])[1] == b"text of the page"
    broken = warc.derive(response(b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n<p>plain</p>"))
    assert warc.read_record(broken[1]["record"])[1] == b"plain"
    assert warc.derive(gzip.compress(response(head + chunks))) == warc.derive(response(head + chunks))


@pytest.mark.parametrize(
    "before",
    [
        "<style>" + "p { color: red } " * 6_250 + "</style>",
        "<script>" + "x = '<title>no</title>';" * 5_000 + "</script>",
        "<!-- <title>no</title> -->" * 4_000,
        "<svg><title>no</title></svg>",
        "<meta charset=utf-8>" + "<link rel=preload>" * 6_000,
    ],
)
def test_title_is_found_wherever_it_stands(before):
    for title in ("Far  away", "long " * 20_000):
        page = f"<html><head>{before}<title>{title}</title></head><body><p>text</p>".encode()
        rows = warc.derive(response(b"HTTP/1.1 200 OK\r\n\r\n" + page))
        about = dict(warc._fields(warc.read_record(rows[0]["record"])[1].decode().split("\r\n")))
        assert about["title"] == " ".join(title.split())
        assert warc.read_record(rows[1]["record"])[1] == b"text"


@pytest.mark.parametrize("raw", [None, b"", b"junk", b"\x1f\x8bjunk", b"WARC/1.1\r\nWARC-Type: request\r\n\r\nx", b"WARC/1.1\r\nContent-Length: x\r\n\r\nx"])
def test_what_is_no_response_gives_nothing(raw):
    assert warc.derive(raw) == []


def test_header_values_cannot_break_a_record():
    raw = warc.response_record("http://a/\r\nWARC-Type: evil", "<p>x</p>", "k", DATE)
    assert len(warc.derive(raw)) == 2 and dict(warc.read_record(raw)[0])["WARC-Type"] == "response"


class Reader(HTMLParser):
    """Title and text lines of a page, by the standard library's parser."""

    INLINE = {"a", "b", "i", "em", "span", "strong", "u"}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.title, self.lines, self.within = "", [""], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.within.append(tag)
        elif tag in ("br", "img", "input"):
            self.lines[-1] += " "
        elif tag not in self.INLINE:
            self.lines.append("")

    def handle_endtag(self, tag):
        if tag in self.within:
            self.within.remove(tag)
        elif tag not in self.INLINE:
            self.lines.append("")

    def handle_data(self, data):
        if self.within == ["title"]:
            self.title += data
        elif not self.within:
            self.lines[-1] += data

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def wanted_record(kind, page):
    """The bytes of a derived record, written out."""
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    urn = lambda kind, of: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {of}')}>"
    date, html = "1970-01-01T00:00:00Z", page.html.encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n%s" % (len(html), html)
    source, reader = urn("response", f"{page.page_id} {page.url}"), Reader()
    reader.feed(page.html)
    reader.close()
    lines = [" ".join(unescape(x).split()) for x in reader.lines]
    text = "\n".join(x for x in lines if x)
    block, content_type = text.encode(), "text/plain; charset=utf-8"
    if kind == "metadata":
        about = {
            "source-record-id": source, "source-payload-digest": sha1(html), "source-block-digest": sha1(http), "source-status": 200,
            "source-header-content-type": "text/html; charset=utf-8", "source-header-content-length": len(html),
            "title": " ".join(reader.title.split()), "text-characters": len(text),
        }
        block, content_type = "".join(f"{k}: {v}\r\n" for k, v in about.items()).encode(), "application/warc-fields"
    head = {
        "WARC-Type": kind, "WARC-Record-ID": urn(kind, source), "WARC-Refers-To": source, "WARC-Refers-To-Target-URI": page.url,
        "WARC-Refers-To-Date": date, "WARC-Target-URI": page.url, "WARC-Date": date, "WARC-Source-Payload-Digest": sha1(html),
        "WARC-Block-Digest": sha1(block), "Content-Type": content_type, "Content-Length": len(block),
    }
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_query_gives_the_records_that_pages_call_for(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{TABLES}/pages.parquet").collect()}
    rows = QUERIES["op6_warc_derivatives"](spark, TABLES).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == sorted((p, k) for p in pages for k in ("conversion", "metadata"))
    assert len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        page = pages[r.page_id]
        assert r.record_sha256 == hashlib.sha256(wanted_record(r.record_type, page)).hexdigest()
        assert r.target_uri == page.url and r.source_status == 200


@pytest.mark.parametrize("charset", ["undefined", "idna", "unicode_escape", "raw_unicode_escape", "punycode", "rot13", "hex", "utf-7", "no-such"])
def test_character_sets_that_are_none(charset):
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=" + charset.encode() + b"\r\n\r\n<title>\\ud800</title><p>caf\xc3\xa9 \\ud800"
    rows = warc.derive(response(page))
    assert warc.read_record(rows[1]["record"])[1].decode() == "café \\ud800"


@pytest.mark.parametrize("charset, raw", [("windows-1252", b"\x80"), ("koi8-r", b"\xc0"), ("shift_jis", b"\x82\xa0"), ("utf-16", b"\xff\xfea\x00"), ("latin-1", b"\xe9"), ("gb2312", b"\xb0\xa1")])
def test_character_sets_of_pages(charset, raw):
    body = warc.decoded_body([("Content-Type", f"text/html; charset={charset}")], raw)
    assert body == raw.decode(charset)


def test_surrogates_and_damage_end_no_job():
    for body in (b"a\x00\xd8b\x00", b"\x00\xd8" * 3):
        rows = warc.derive(response(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-16-le\r\n\r\n" + body))
        assert len(rows) == 2
    whole = gzip.compress(response(b"HTTP/1.1 200 OK\r\n\r\n<p>" + bytes(range(256)) * 40))
    for at in range(10, len(whole), 97):
        damaged = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
        assert warc.derive(damaged) == []
        assert warc.derive(whole[:at]) == []
    assert warc.derive(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: x\r\nContent-Length: -5\r\n\r\nabcdefgh") == []


def test_raw_deflate_and_several_codings():
    page, raw = b"<p>text of the page</p>", zlib.compressobj(wbits=-15)
    bare = raw.compress(page) + raw.flush()
    for coding, payload in (("deflate", bare), ("deflate", zlib.compress(page)), ("deflate, gzip", gzip.compress(bare)), ("x-gzip", gzip.compress(page))):
        assert warc.decoded_body([("Content-Encoding", coding)], payload) == page.decode()
    assert warc.decoded_body([("Content-Encoding", "br")], page) == page.decode()
    assert warc.decoded_body([("Content-Encoding", "deflate")], b"\x00\xff plain") == "\x00\ufffd plain"


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, record string"
    rows = [(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<p>a</p>", "x"), (2, "u", "<p>a</p>", "x"), (3, "u", "<p>" + "w " * 200_000, "x")]
    got = warc.derivatives(warc.responses(spark.createDataFrame(rows, schema))).collect()
    assert len(got) == 10 and {r.refers_to for r in got if r.page_id == 2} == {warc.derived_id("response", "2 u")}
    assert warc.derivatives(warc.responses(spark.createDataFrame([], schema))).collect() == []
