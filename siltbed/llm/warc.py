"""Derivatives of WARC responses: linked metadata and plain-text conversion records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
# Elements whose content is not text, and those that begin a line of their own.
HIDDEN = ("script", "style", "noscript", "template", "textarea", "select", "svg", "iframe", "head")
# Those of raw text, which last to the end of the page where they are not closed, and the others.
RAW = ("script", "style", "textarea")
OTHER = tuple(name for name in HIDDEN if name not in RAW)
LINES = (
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main nav ol p pre section table tbody tfoot thead title tr ul"
).split()

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>", re.S)
_REST = r"\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
# Comments and raw text are looked for together: what looks like one within the other is none.
_COMMENT_OR_RAW = re.compile(rf"{_COMMENT.pattern}|<(?P<name>{'|'.join(RAW)}){_REST}", re.S | re.I)
_OTHER = re.compile(rf"<(?P<name>{'|'.join(OTHER)}){_REST}", re.I)
_END = {name: re.compile(rf"</{name}\s*>" + (r"|(?=<body\b)" if name == "head" else ""), re.I) for name in HIDDEN}
# What a head without an end consists of.
_IN_HEAD = re.compile(rf"(?:\s+|<title{_REST}.*?</title\s*>|<(?:meta|link|base){_REST})*", re.S | re.I)
_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>?")
_ATTRIBUTE = re.compile(r"""\b(href|src|lang|charset|content|http-equiv)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_ANCHOR = re.compile(r"<a\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
_HEAD = {
    "title": re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|<)", re.S | re.I),
    "lang": re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I),
    "charset": re.compile(r"<meta\b[^>]*?\bcharset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.I),
}
_META = re.compile(rb"<meta\b[^>]*?\bcharset\s*=\s*[\"']?\s*([A-Za-z0-9_:.-]+)", re.I)
_CHUNK = re.compile(rb"([0-9A-Fa-f]{1,8})[ \t]*(?:;[^\r\n]*)?\r\n")
# Byte order marks, and the names that pages give to Windows' Western character set.
_MARKS = ((b"\xef\xbb\xbf", "utf-8", 3), (b"\xff\xfe", "utf-16-le", 2), (b"\xfe\xff", "utf-16-be", 2))
_CHARSETS = dict.fromkeys(("iso-8859-1", "iso8859-1", "latin1", "latin-1", "ascii", "us-ascii", "windows-1252"), "cp1252")
_BLANKS = re.compile(r"[^\S\n]+")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_LINE_SET = frozenset(LINES)


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An identifier that the same parts always give."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {_UNSAFE.sub(lambda m: f'%{ord(m[0]):02X}', v) if k in ('WARC-Target-URI', 'WARC-Refers-To-Target-URI') else v}" for k, v in headers)]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_headers(lines: list[str]) -> list[tuple[str, str]]:
    """Named fields; a line that begins with white space goes on with the one before."""
    found: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and found:
            found[-1] = found[-1][0], f"{found[-1][1]} {line.strip()}"
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip(), value.strip()))
    return found


def parse_record(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of one record; raises ValueError where it is not whole."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = parse_headers(lines[1:])
    size = field(headers, "Content-Length")
    if size is None or not size.isdigit() or len(rest) < int(size):
        raise ValueError("the block is not as long as Content-Length says")
    return headers, rest[:int(size)]


def field(headers: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def _attributes(tag: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(tag)))}


def _without(page: str, pattern: re.Pattern) -> str:
    """The page without the elements and comments of a pattern.

    Of an element that is empty or never closed only the tag goes, except for raw text.
    """
    kept, at, open_names = [], 0, set()
    while m := pattern.search(page, at):
        kept.append(page[at:m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        kept.append("\n")
        if m[0].endswith("/>"):
            continue
        end = None if name in open_names else _END[name].search(page, at)
        if end:
            at = end.end()
        elif name in RAW:
            at = len(page)
        else:
            open_names.add(name)
            at = _IN_HEAD.match(page, at).end() if name == "head" else at
    return "".join([*kept, page[at:]])


def plain_text(page: str) -> str:
    """The text of a page: no hidden elements, a line for each block, single blanks, no empty lines."""
    page = _without(_without(page, _COMMENT_OR_RAW), _OTHER)
    page = _TAG.sub(lambda m: "\n" if (name := m[1].lower()) in _LINE_SET else " " if name in ("td", "th") else "", page)
    lines = (_BLANKS.sub(" ", line).strip() for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def unchunked(body: bytes) -> bytes:
    """A body without the sizes of its chunks; raises ValueError where one is cut short.

    A body that does not begin with a size was put together by the crawler already.
    """
    if not _CHUNK.match(body):
        return body
    found, at = [], 0
    while m := _CHUNK.match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(found)
        found.append(body[m.end():m.end() + size])
        at = m.end() + size
        if len(found[-1]) < size or body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk of the body is cut short")
        at += 2
    raise ValueError("the last chunk of the body is missing")


def decompressed(body: bytes, codings: list[str]) -> bytes:
    """A body without its content codings, the last one first; raises ValueError where that fails.

    A body that does not begin as gzip data does was decompressed by the crawler already.
    """
    for coding in reversed(codings):
        if coding in ("", "identity") or coding in ("gzip", "x-gzip") and not body.startswith(b"\x1f\x8b"):
            continue
        if coding not in ("gzip", "x-gzip", "deflate"):
            raise ValueError(f"the body is coded as {coding}")
        try:
            if coding == "deflate":
                try:
                    body = zlib.decompress(body)
                except zlib.error:  # without the header, as some servers send it
                    body = zlib.decompress(body, -zlib.MAX_WBITS)
            else:
                body = gzip.decompress(body)
        except (zlib.error, EOFError, OSError) as e:
            raise ValueError(f"the body is not whole {coding} data") from e
    return body


def page_text(body: bytes, content_type: str) -> str:
    """A body as text: in the character set of the header, else of a byte order mark, else of the page, else UTF-8."""
    named = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9_:.-]+)", content_type, re.I)
    mark = next(((name, size) for bom, name, size in _MARKS if body.startswith(bom)), None)
    for name in (named and named[1], mark and mark[0]):
        if name and (found := _decoded(body, name)) is not None:
            return found.removeprefix("\ufeff")
    meta = _META.search(body[:4096])
    name = meta[1].decode("ascii").lower() if meta else "utf-8"
    # A page whose declaration could be read is in no coding of two bytes.
    found = _decoded(body, "utf-8" if name.startswith("utf-16") else name)
    return body.decode("utf-8", "replace") if found is None else found


def _decoded(body: bytes, charset: str) -> str | None:
    try:
        return body.decode(_CHARSETS.get(charset.lower(), charset), "replace")
    except LookupError:
        return None


def describe(page: str, uri: str) -> list[tuple[str, str]]:
    """Title, language, character set and links of a page, as fields of a metadata record."""
    found = []
    bare = _without(page, _COMMENT_OR_RAW)
    for name, pattern in _HEAD.items():
        if m := pattern.search(bare):
            value = " ".join(html.unescape(m[1]).split())
            if value:
                found.append((name, value))
    for anchor in dict.fromkeys(_ANCHOR.findall(bare)):
        link = " ".join(_attributes(anchor).get("href", "").split())
        if link:
            try:
                found.append(("outlink", urljoin(uri, link)))
            except ValueError:
                found.append(("outlink", link))
    return found


def response(page_id, url: str | None, page: str | None, date: str) -> bytes:
    """A response record as a crawler writes it."""
    body = (page or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    digest = sha1_base32(body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    headers += [("WARC-Payload-Digest", digest), ("WARC-Block-Digest", sha1_base32(block)), ("Content-Type", "application/http; msgtype=response")]
    return serialise(headers, block)


def derivatives(record: bytes) -> list[dict]:
    """The metadata and the conversion record of a response; other types of record have none."""
    headers, block = parse_record(record)
    if field(headers, "WARC-Type") != "response":
        return []
    head, gap, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    if not gap or not lines[0].startswith("HTTP/"):
        raise ValueError("the block is not an HTTP response")
    http = parse_headers(lines[1:])
    kind = field(http, "Content-Type") or ""
    stored = body
    if "chunked" in (field(http, "Transfer-Encoding") or "").lower():
        body = unchunked(body)
    source, uri, date = field(headers, "WARC-Record-ID") or "", field(headers, "WARC-Target-URI"), field(headers, "WARC-Date")
    # The payload is the body without chunk sizes; some writers take the digest of what is stored.
    given, computed = field(headers, "WARC-Payload-Digest"), sha1_base32(body)
    agrees = given in (None, computed) or body is not stored and given == sha1_base32(stored)
    is_text = not kind or kind.lower().startswith(("text/", "application/xhtml"))
    if is_text:
        codings = [c.strip().lower() for c in (field(http, "Content-Encoding") or "").split(",")]
        page = page_text(decompressed(body, codings), kind)
    fields = [("http-status", lines[0].split(" ", 1)[-1]), *((f"http-{k.lower()}", v) for k, v in http)]
    fields += [("source-payload-digest", given or ""), ("computed-payload-digest", computed), ("payload-digest-agrees", str(agrees).lower())]
    fields += describe(page, uri or "") if is_text else []
    linked = [("WARC-Refers-To", source)]
    linked += [("WARC-Refers-To-Target-URI", uri), ("WARC-Target-URI", uri)] if uri is not None else []
    linked += [("WARC-Refers-To-Date", date), ("WARC-Date", date)] if date is not None else []
    made = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields))]
    if is_text:
        made.append(("conversion", "text/plain; charset=utf-8", plain_text(page)))
    out = []
    for record_type, content_type, text in made:
        data = text.encode("utf-8", "replace")
        own, digest = record_id(record_type, source), sha1_base32(data)
        fields = [("WARC-Type", record_type), ("WARC-Record-ID", own), *linked, ("WARC-Block-Digest", digest)]
        if given is not None:
            fields.append(("WARC-Source-Payload-Digest", given))
        out.append({
            "record_type": record_type, "record_id": own, "refers_to": source, "target_uri": uri, "warc_date": date,
            "content_type": content_type, "content_length": len(data), "block_digest": digest,
            "source_payload_digest": given, "block": data.decode(), "record": serialise([*fields, ("Content-Type", content_type)], data),
        })
    return out


_COLUMNS = {
    "record_type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(), "target_uri": pa.string(), "warc_date": pa.string(),
    "content_type": pa.string(), "content_length": pa.int64(), "block_digest": pa.string(), "source_payload_digest": pa.string(),
    "block": pa.string(), "record": pa.binary(), "problem": pa.string(),
}
_DDL = ", ".join(f"{k} {'bigint' if v == pa.int64() else 'binary' if v == pa.binary() else 'string'}" for k, v in _COLUMNS.items())
# Bytes of derivatives that leave a task together.
BATCH_BYTES = 4 << 20


def _derived(ids: pa.Array, records: Iterator[bytes | None]) -> Iterator[pa.RecordBatch]:
    rows: dict[str, list] = {k: [] for k in _COLUMNS}
    at, size = [], 0

    def batch() -> pa.RecordBatch:
        arrays = [ids.take(pa.array(at, pa.int64())), *(pa.array(rows[k], kind) for k, kind in _COLUMNS.items())]
        return pa.RecordBatch.from_arrays(arrays, ["id", *_COLUMNS])

    for k, record in enumerate(records):
        try:
            found = [] if record is None else derivatives(record)
        except ValueError as e:
            found = [{"problem": str(e)}]
        for made in found:
            at.append(k)
            for name, values in rows.items():
                values.append(made.get(name))
            size += len(made.get("record", b""))
        if size > BATCH_BYTES:
            yield batch()
            rows, at, size = {k: [] for k in _COLUMNS}, [], 0
    yield batch()


def derive(records: DataFrame, *, id_column: str, record_column: str = "record") -> DataFrame:
    """Metadata and conversion records of response records (``binary``), two rows for each.

    Returns the id column, the derivative's fields, its ``block`` as text and the whole ``record``;
    ``refers_to`` is the response's identifier. Null records and those of other types have no
    derivatives; what cannot be read gives one row that says so in ``problem``, which holds for bodies whose
    chunks or content coding (gzip and deflate are known) are broken too. Responses that are not text
    have a metadata record only. Rows are taken one by one, in place.
    """
    kind = records.schema[id_column].dataType.simpleString()
    rows = records.select(F.col(id_column).alias("id"), F.col(record_column).alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _derived(batch.column("id"), (x.as_py() for x in batch.column("record")))

    return rows.mapInArrow(run, f"id {kind}, {_DDL}").withColumnRenamed("id", id_column)


def response_records(pages: DataFrame, *, date: str = "2024-01-01T00:00:00Z", id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Pages as response records: the id column and ``record``. Null pages have an empty body, null URLs no target."""
    kind = pages.schema[id_column].dataType.simpleString()
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [response(i.as_py(), u.as_py(), h.as_py(), date) for i, u, h in zip(*part.columns)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(made, pa.binary())], ["id", "record"])

    return rows.mapInArrow(run, f"id {kind}, record binary").withColumnRenamed("id", id_column)
