"""Metadata and plain-text conversion records derived from WARC response records.

A record is a row: ``record_id, type, target_uri, date, headers`` (names and values as
they stood) and ``block`` (bytes). From each response come

* a ``metadata`` record (``application/warc-fields``): status, title, language, character
  set, the source's digests and all its headers, and its links, made absolute;
* a ``conversion`` record (``text/plain``): the page's text, for HTML and plain text.

Both name their source in ``WARC-Refers-To`` and each other in ``WARC-Concurrent-To``, and
keep the source's URI, date, payload digest and content type. Their ids are made from the source's id and their type, so a rerun makes the same ones. Block digests
are SHA-1 in base 32. A source digest that does not fit the content is kept and reported.

Rules: a NULL or empty block gives a metadata record without a status and no conversion.
A response without an id gets one from its URI, date and block. Repeated rows give
repeated records. Text in an unknown or wrong character set is read as UTF-8 with
replacement characters. Records that are not responses are left out.
"""

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
from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = ("record_id string, type string, target_uri string, date string, "
          "headers array<struct<name: string, value: string>>, block binary")
DERIVED = SCHEMA + ", refers_to string, content_type string, content_length long, block_digest string, source_digest string, digest_fits boolean"
CRLF = b"\r\n"
END_OF_HEAD = re.compile(rb"\r?\n\r?\n")
SKIPPED = frozenset("script style template noscript svg textarea iframe object".split())
BLOCKS = frozenset((
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol option p pre section select summary table tbody tfoot thead title tr ul").split())
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTES = re.compile(r"""(?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+>""")
HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)
CHARSET = re.compile(rb"""charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def made_id(*parts: str | bytes | None) -> str:
    h = hashlib.sha1()
    for p in parts:
        p = b"-" if p is None else p.encode() if isinstance(p, str) else p
        h.update(len(p).to_bytes(8, "big") + p)
    return f"<urn:uuid:{uuid.UUID(bytes=h.digest()[:16], version=5)}>"


def fields(head: bytes) -> list[tuple[str, str]]:
    """Header lines as names and values; folded lines are joined."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").splitlines():
        if line[:1] in " \t" and out:
            out[-1] = (out[-1][0], out[-1][1] + " " + line.strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def first(pairs, name: str) -> str | None:
    return next((v for n, v in pairs if n.lower() == name.lower()), None)


def http_message(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and body (decoded from chunks and gzip where its headers say so)."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    at = END_OF_HEAD.search(block)
    head, body = (block[: at.start()], block[at.end() :]) if at else (block, b"")
    line, _, rest = head.partition(b"\n")
    status = re.match(rb"HTTP/\S+\s+(\d{3})", line)
    pairs = fields(rest)
    return int(status[1]) if status else None, pairs, body


def decoded(pairs, body: bytes) -> bytes:
    if "chunked" in (first(pairs, "Transfer-Encoding") or "").lower():
        parts, at = [], 0
        while (end := body.find(b"\n", at)) >= 0:
            try:
                size = int(body[at:end].split(b";")[0], 16)
            except ValueError:
                break
            if size == 0:
                break
            parts.append(body[end + 1 : end + 1 + size])
            at = end + 1 + size
            at += 2 if body[at : at + 2] == CRLF else body[at : at + 1] == b"\n"
        body = b"".join(parts) or body
    if (first(pairs, "Content-Encoding") or "").lower() in ("gzip", "x-gzip", "deflate"):
        try:
            body = zlib.decompressobj(47).decompress(body)
        except zlib.error:
            pass
    return body


def page(source: str) -> tuple[str, str | None, str | None, list[str]]:
    """Text, title, language and links of an HTML page, in one pass over its tags."""
    out, links, title, language = [], [], None, None
    at, size = 0, len(source)
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            out.append(html.unescape(source[at:]))
            break
        out.append(html.unescape(source[at:lt]))
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        tag = TAG.match(source, lt)
        if not tag:
            if source.startswith(("<!", "<?"), lt):
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
            else:
                out.append("<")
                at = lt + 1
            continue
        closing, name = tag[1], tag[2].lower()
        rest = ATTRIBUTES.match(source, tag.end())
        end = rest.end() if rest else source.find(">", tag.end()) + 1 or size
        attributes, at = source[tag.end() : end], end
        if name in SKIPPED and not closing and not attributes.endswith("/>"):
            stop = re.compile(rf"</{name}\b", re.I).search(source, at)
            at = stop.start() if stop else size
        elif name == "title" and not closing:
            stop = re.compile(r"</title\b", re.I).search(source, at)
            text = html.unescape(source[at : stop.start() if stop else size])
            title = " ".join(text.split()) if title is None else title
            at = stop.start() if stop else size
        elif name == "a" and not closing and (h := HREF.search(attributes)):
            links.append(html.unescape(h[1] or h[2] or h[3] or ""))
        elif name == "html" and language is None and (m := LANG.search(attributes)):
            language = m[1]
        out.append("\n" if name in BLOCKS else "\t" if name in ("td", "th") else "")
    lines = (" ".join(line.split()) for line in "".join(out).split("\n"))
    return "\n".join(line for line in lines if line), title, language, links


def text_of(body: bytes, content_type: str) -> tuple[str, str]:
    named = CHARSET.search(content_type.encode()) or CHARSET.search(body[:2048])
    charset = named[1].decode().lower() if named else "utf-8"
    try:
        return body.decode(charset), charset
    except (LookupError, UnicodeDecodeError):
        return body.decode("utf-8", "replace"), charset


def absolute(base: str | None, link: str) -> str:
    try:
        return urljoin(base or "", link)
    except ValueError:
        return link


#: Comments and white space, then a page's first tag.
LOOKS_HTML = re.compile(r"\ufeff?(?:\s++|<!--.*?-->|<\?.*?\?>)*+<(?:!doctype\s+html|html)\b", re.IGNORECASE | re.DOTALL)


def derive_one(record_id, uri, date, headers, block) -> list[tuple]:
    block = block or b""
    record_id = record_id or made_id(uri, date, block)
    status, http, raw = http_message(block)
    body = decoded(http, raw)
    kind = first(http, "Content-Type") or ""
    given = first(headers, "WARC-Payload-Digest")
    own = digest(raw)
    media = kind.split(";")[0].strip().lower()
    text, charset = text_of(body, kind) if block else ("", None)
    is_html = media in ("text/html", "application/xhtml+xml") or not media and bool(LOOKS_HTML.match(text))
    title = language = None
    links: list[str] = []
    if is_html:
        text, title, language, links = page(text)
    fits = None if given is None else given == own
    lines = [("source-payload-digest", own), ("source-content-length", str(len(block)))]
    if status is not None:
        lines.append(("http-status", str(status)))
    lines += [(n, v) for n, v in (("content-type", kind or None), ("charset", charset), ("title", title), ("language", language)) if v]
    if fits is False:
        lines.append(("digest-mismatch", given))
    lines += [(f"source-{n}", v) for n, v in headers]
    lines += [("outlink", absolute(uri, link)) for link in links]
    plain = lambda s: " ".join(s.split())  # noqa: E731  no field may end its line
    meta = "".join(f"{plain(n)}: {plain(v)}\r\n" for n, v in lines).encode("utf-8", "replace")
    readable = bool(block) and (is_html or media.startswith("text/"))
    origin = [("WARC-Source-Payload-Digest", given or own), ("WARC-Source-Content-Type", plain(kind) or None)]
    beside = lambda other: [("WARC-Concurrent-To", made_id(other, record_id))] if readable else []
    out = [_record("metadata", record_id, uri, date, "application/warc-fields", meta, given or own, fits, [*beside("conversion"), *origin])]
    if readable:
        out.append(_record("conversion", record_id, uri, date, "text/plain; charset=utf-8", text.encode("utf-8", "replace"), given or own, fits,
                           [*beside("metadata"), *origin]))
    return out


def _record(kind, source, uri, date, content_type, block, source_digest, fits, more) -> tuple:
    own, own_digest = made_id(kind, source), digest(block)
    pairs = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), *more, ("WARC-Target-URI", uri), ("WARC-Date", date),
             ("WARC-Block-Digest", own_digest), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    headers = [{"name": n, "value": v} for n, v in pairs if v is not None]
    return own, kind, uri, date, headers, block, source, content_type, len(block), own_digest, source_digest, fits


HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), HEADERS, pa.binary(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
NAMES = ("record_id type target_uri date headers block refers_to content_type content_length block_digest source_digest digest_fits").split()


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the responses among ``records``."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                pairs = [(h["name"] or "", h["value"] or "") for h in r["headers"] or [] if h]
                rows += derive_one(r["record_id"], r["target_uri"], r["date"], pairs, r["block"])
            columns = list(zip(*rows)) or [[]] * len(NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)

    given = records.where("type = 'response'").select("record_id", "target_uri", "date", "headers", "block")
    return given.mapInArrow(make, DERIVED)


def responses_from_pages(pages: DataFrame, *, url="url", html_column="html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records, as a crawler would have stored them: HTTP head, body, digests."""
    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body is None:
                    block, pairs = None, []
                else:
                    raw = body.encode("utf-8", "surrogatepass")
                    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(raw) + raw
                    pairs = [("WARC-Payload-Digest", digest(raw)), ("WARC-Block-Digest", digest(block))]
                own = made_id("response", uri, date, block)
                pairs = [("WARC-Type", "response"), ("WARC-Record-ID", own), *([("WARC-Target-URI", uri)] if uri else []), ("WARC-Date", date),
                         ("Content-Type", "application/http; msgtype=response"), *pairs, ("Content-Length", str(len(block or b"")))]
                rows.append((own, "response", uri, date, [{"name": n, "value": v} for n, v in pairs], block))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES[:6])

    return pages.select(F.col(url).cast("string").alias("url"), F.col(html_column).alias("html")).mapInArrow(wrap, SCHEMA)


#: Where a gzip member begins, bytes unpacked at once, and the type of rows for what is no record.
GZIP, PIECE, BROKEN = b"\x1f\x8b", 1 << 16, "broken"
RECORD = re.compile(rb"(?<![^\n])WARC/[0-9]")


def to_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in headers)
    return head.encode("utf-8", "replace") + CRLF + block + CRLF + CRLF


def parse(data: bytes) -> Iterator[tuple]:
    """Records of a WARC file, plain or gzip (one member each or one for all).

    What is no whole record comes as a row of type ``BROKEN`` with its bytes, up to the next
    place where a record, or a gzip member, begins.
    """
    if data[:2] != GZIP:
        yield from records_in(data)
        return
    at, held = 0, []
    while at < len(data):
        member, parts, place = zlib.decompressobj(31), [], at
        try:
            # In pieces, so that what follows the member is never copied as a whole.
            while not member.eof and place < len(data):
                parts.append(member.decompress(data[place : place + PIECE]))
                place += PIECE
            whole = member.eof
        except zlib.error:
            whole = False
        if whole:
            held += parts
            place = min(place, len(data)) - len(member.unused_data)
            if data[place : place + 2] == GZIP or place >= len(data):
                at = place
                continue
        yield from records_in(b"".join(held))
        held = []
        begin = place if whole else at + 2
        at = data.find(GZIP + b"\x08", begin)
        at = len(data) if at < 0 else at
        yield broken(data[begin if whole else begin - 2 : at])
    yield from records_in(b"".join(held))


def broken(data: bytes) -> tuple:
    return None, BROKEN, None, None, [], data


def records_in(data: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        begin = RECORD.search(data, at)
        stretch = data[at : begin.start() if begin else len(data)]
        if stretch.strip():
            yield broken(stretch)
        if not begin:
            return
        at, end = begin.start(), END_OF_HEAD.search(data, begin.start())
        pairs = fields(data[at : end.start()].partition(b"\n")[2]) if end else []
        size = first(pairs, "Content-Length")
        if size is None or not size.isdecimal() or end.end() + int(size) > len(data):
            # Without a usable length the record ends where the next one begins.
            following = RECORD.search(data, at + 5)
            stop = following.start() if following else len(data)
            yield broken(data[at:stop])
            at = stop
            continue
        stop = end.end() + int(size)
        yield (first(pairs, "WARC-Record-ID"), first(pairs, "WARC-Type"), first(pairs, "WARC-Target-URI"), first(pairs, "WARC-Date"),
               [{"name": n, "value": v} for n, v in pairs], data[end.end() : stop])
        at = stop


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files; a file is one task's work, as its records do not start at known places."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse(content.as_py()))
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES[:6])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, SCHEMA)


def volumes(records: DataFrame, *, volume_bytes: int = 64 << 20, prefix: str = "derived") -> DataFrame:
    """``(name, content)``: the records as WARC files of one gzip member per record.

    A task fills volumes one after the other, so no record is shuffled; names carry the
    task's number.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, count, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": [f"{prefix}-{task:05d}-{count:05d}.warc.gz"], "content": pa.array([b"".join(parts)], pa.binary())})

        for batch in batches:
            for headers, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                member = gzip.compress(to_bytes([(h["name"], h["value"]) for h in headers], block or b""), 6, mtime=0)
                parts.append(member)
                size += len(member)
                if size >= volume_bytes:
                    yield full()
                    count, parts, size = count + 1, [], 0
        if parts:
            yield full()

    return records.select("headers", "block").mapInArrow(pack, "name string, content binary")
