import gzip
import hashlib
import html
import random
import zlib
from html.parser import HTMLParser

import pytest
from siltbed.llm import queries, warc

SF = "/root/testdata/sf0.001"


class Reader(HTMLParser):
    """The plain text of a well-formed page, by the library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in warc.HIDDEN:
            self.hidden += 1
        self.out.append("\n" if tag in warc.LINES or tag in warc.HIDDEN else " " if tag in ("td", "th") else "")

    def handle_endtag(self, tag):
        if tag in warc.HIDDEN:
            self.hidden -= 1
        self.handle_starttag(tag, []) if tag not in warc.HIDDEN else self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def by_parser(page):
    reader = Reader()
    reader.feed(page)
    lines = (" ".join(line.split()) for line in "".join(reader.out).split("\n"))
    return "\n".join(line for line in lines if line)


def test_text_equals_the_parser():
    rnd = random.Random(2)
    parts = ["<p>", "</p>", "<b>", "</b>", "a &amp; b", "x &lt;y&gt;", " ", "\n", "<br>", "<div class='a>b'>", "</div>", "<!-- <p>no --> ", "<script>if (a<b) x='</p>'</script>", "<td>", "é", "&#233;", "<style>p{}</style>"]
    for _ in range(500):
        page = "".join(rnd.choice(parts) for _ in range(15))
        assert warc.plain_text(page) == by_parser(page), page


def test_records_link_and_keep_headers(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = queries.op1_warc(spark, SF).collect()
    made = warc.derive(warc.response_records(pages), id_column="page_id").collect()
    assert len(rows) == len(made) == 2 * pages.count() and not any(r.problem for r in rows)
    source = {r.page_id: r for r in pages.collect()}
    for row in made:
        headers, block = warc.parse_record(row.record)
        page = source[row.page_id]
        response = warc.response(page.page_id, page.url, page.html, row.warc_date)
        assert warc.field(headers, "WARC-Refers-To") == row.refers_to == warc.field(warc.parse_record(response)[0], "WARC-Record-ID")
        assert warc.field(headers, "WARC-Type") == row.record_type and warc.field(headers, "WARC-Target-URI") == page.url
        assert block.decode() == row.block and warc.sha1_base32(block) == row.block_digest == warc.field(headers, "WARC-Block-Digest")
        assert row.source_payload_digest == warc.sha1_base32(page.html.encode())
        if row.record_type == "metadata":
            assert "payload-digest-agrees: true\r\n" in row.block and "http-content-type: text/html; charset=utf-8\r\n" in row.block
    assert {r.record_sha256 for r in rows} == {hashlib.sha256(r.record).hexdigest() for r in made}


def test_edges(spark):
    rows = [(1, None, None, 1), (2, "http://a/ b\r\nX: y", "<p>t", 2), (None, "http://a", "", 3), (3, "u", "<a href='/x?y=1&amp;z'>l</a>" * 3 + "<p>" * 5000, 4), (3, "u", "x", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record int")
    made = warc.derive(warc.response_records(pages), id_column="page_id").collect()
    assert len(made) == 10
    assert all(warc.field(warc.parse_record(r.record)[0], "X") is None for r in made)
    assert [r.block for r in made if r.page_id == 2 and r.record_type == "conversion"] == ["t"]
    assert warc.derive(warc.response_records(pages.where("false")), id_column="page_id").count() == 0
    request = warc.serialise([("WARC-Type", "request"), ("WARC-Record-ID", "<r>")], b"GET")
    image = warc.serialise([("WARC-Type", "response"), ("WARC-Record-ID", "<i>")], b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG")
    records = spark.createDataFrame([(1, None), (2, bytearray(b"junk")), (3, bytearray(request)), (4, bytearray(image)), (5, bytearray(image[:-9]))], "id long, record binary")
    got = [(r.id, r.record_type, r.problem is None) for r in warc.derive(records, id_column="id").collect()]
    assert got == [(2, None, False), (4, "metadata", True), (5, None, False)]


def test_links_and_title():
    page = "<html lang=de><title> A &amp; B </title><meta charset=utf-8><a href='/x?a=1&amp;b'>1</a><a href=http://o/>2</a><!--<a href=no>-->"
    assert warc.describe(page, "http://h/d/e") == [("title", "A & B"), ("lang", "de"), ("charset", "utf-8"), ("outlink", "http://h/x?a=1&b"), ("outlink", "http://o/")]
    assert html.unescape("&amp;") == "&"


def test_broken_records():
    for bad in (b"", b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab", b"WARC/1.1\r\n\r\n", b"x\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_hidden_elements_without_an_end():
    for page, text in (
        ("<html><head><title>x</title><body><p>hello world</p></body></html>", "hello world"),
        ("<html><head><meta charset=utf-8><title>x</title><p>hello world", "hello world"),
        ("<head><script>var a = '<body>';</script><title>x</title></head><body>hello world", "hello world"),
        ("<body><svg width=1/><p>hello world", "hello world"), ("<body><svg width=1><p>hello world", "hello world"),
        ("<svg><text>no</text></svg>hello<svg/> world<iframe src='x'>", "hello\nworld"), ("hello<noscript>world<select>", "hello\nworld"),
        ("hello world<script>var a = 1", "hello world"), ("hello world<style>p {}", "hello world"), ("hello world<textarea>no", "hello world"),
    ):
        assert warc.plain_text(page) == text, page


def page_of(body, *fields, kind="text/html", digest=True):
    """The conversion text of a response with this body, or the problem."""
    block = "\r\n".join(["HTTP/1.1 200 OK", f"Content-Type: {kind}", *fields, "", ""]).encode() + body
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "http://a/")]
    headers += [("WARC-Payload-Digest", warc.sha1_base32(body))] if digest else []
    try:
        made = warc.derivatives(warc.serialise(headers, block))
    except ValueError as e:
        return str(e)
    assert "payload-digest-agrees: true" in made[0]["block"]
    return made[1]["block"]


def chunked(body, size=7):
    parts = [body[k:k + size] for k in range(0, len(body), size)]
    return b"".join(b"%x;a=b\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: x\r\n\r\n"


PAGE = "<p>café, « quoted » and more</p>".encode()
PLAIN = "café, « quoted » and more"


@pytest.mark.parametrize(
    "body, fields, want",
    [
        (PAGE, [], PLAIN),
        (gzip.compress(PAGE), ["Content-Encoding: gzip"], PLAIN),
        (gzip.compress(PAGE), ["content-encoding: X-GZIP"], PLAIN),
        (zlib.compress(PAGE), ["Content-Encoding: deflate"], PLAIN),
        (zlib.compress(PAGE)[2:-4], ["Content-Encoding: deflate"], PLAIN),
        (gzip.compress(zlib.compress(PAGE)), ["Content-Encoding: deflate, gzip"], PLAIN),
        (chunked(PAGE), ["Transfer-Encoding: chunked"], PLAIN),
        (chunked(gzip.compress(PAGE)), ["Transfer-Encoding: chunked", "Content-Encoding: gzip"], PLAIN),
        # The crawler undid the coding and kept the header.
        (PAGE, ["Content-Encoding: gzip", "Transfer-Encoding: chunked"], PLAIN),
        (gzip.compress(PAGE)[:-9], ["Content-Encoding: gzip"], "the body is not whole gzip data"),
        (b"\x00\x01\x02", ["Content-Encoding: deflate"], "the body is not whole deflate data"),
        (PAGE, ["Content-Encoding: br"], "the body is coded as br"),
        (chunked(PAGE)[:26], ["Transfer-Encoding: chunked"], "a chunk of the body is cut short"),
        (chunked(PAGE).split(b"0\r\nT")[0], ["Transfer-Encoding: chunked"], "the last chunk of the body is missing"),
        (b"", ["Content-Encoding: gzip"], ""),
    ],
)
def test_encoded_bodies(body, fields, want):
    assert page_of(body, *fields) == want
    assert page_of(body, *fields, digest=False) == want


@pytest.mark.parametrize(
    "body, kind, want",
    [
        ("<p>café</p>".encode("latin-1"), "text/html; charset=ISO-8859-1", "café"),
        ("<meta charset='iso-8859-1'><p>café</p>".encode("latin-1"), "text/html", "café"),
        ("<meta http-equiv=Content-Type content='text/html; charset=windows-1251'><p>слово</p>".encode("cp1251"), "text/html", "слово"),
        ("\ufeff<p>café</p>".encode("utf-16-le"), "text/html", "café"),
        ("\ufeff<meta charset=latin1><p>café</p>".encode(), "text/html", "café"),
        # The header counts before the page, an unknown name in either for nothing.
        ("<meta charset=utf-8><p>café</p>".encode("latin-1"), "text/html; charset=\"latin1\"", "café"),
        ("<meta charset=nonsense><p>café</p>".encode(), "text/html; charset=rot13", "café"),
        ("<p>“q”</p>".encode("cp1252"), "text/html; charset=us-ascii", "“q”"),
        (b"<meta charset=utf-16><p>a\xff</p>", "text/html", "a\ufffd"),
    ],
)
def test_character_sets(body, kind, want):
    assert page_of(body, kind=kind) == want


def test_comments_and_raw_text():
    assert warc.plain_text('<script>var s="<!--";</script><p>kept') == "kept"
    assert warc.plain_text("<!-- <script> --><p>kept</p><style><!-- p{} --></style>too") == "kept\ntoo"
    assert warc.plain_text("a<!-- open <script>x</script>") == "a"
    assert ("outlink", "http://a/b") in warc.describe('<script>"<!--"</script><a href=b>x</a>', "http://a/")
    assert warc.describe('<script>"<a href=no>"</script>', "http://a/") == []
