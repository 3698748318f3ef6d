"""WARC derivatives: a metadata and a plain-text conversion record for each response record.

Both refer to the response (WARC-Refers-To with its target and date). The metadata record
keeps the response's own headers, its HTTP status and headers and its digests; the conversion
record holds the page's text. Record ids follow from the source's id, so that a task that
runs again writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, lean, small_batches

DERIVED = "page_id long, record_type string, record_id string, refers_to string, target_uri string, source_block_digest string, block_digest string, content_length long, record binary"
#: Elements whose content is no text (fixed values). A head is not among them: it holds only these
#: and tags without content, and all else ends it, whether or not `</head>` follows.
_RAW = frozenset("script style noscript noframes template title".split())
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
#: A comment's begin, a declaration, or the whole name of a tag.
_TOKEN = re.compile(r"<(?:(!--)|[!?][^>]*>|(/?[a-zA-Z][^\s/>]*))")
#: What may end a tag, or begin a quoted value in which nothing does.
_STOP = re.compile(r""">|=\s*(["'])""")
_HREF = re.compile(r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CHARSET = re.compile(rb"""charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
_SPACE = re.compile(r"[^\S\n]+")
#: Elements that begin a new line of text (fixed values).
_BREAKS = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table td th tr ul".split())


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def build(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record: version, WARC-Type, the headers as given, length and block."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: {digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _line(raw: bytes) -> str:
    """A header line: UTF-8, or else Latin-1."""
    try:
        return raw.decode().strip()
    except UnicodeDecodeError:
        return raw.decode("latin-1").strip()


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers (in order, folded lines joined) and block of each record of a stream.

    What is no record, or ends early, raises ValueError.
    """
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and headers:
                headers[-1] = (headers[-1][0], f"{headers[-1][1]} {_line(line)}")
            else:
                k, _, v = _line(line).partition(":")
                headers.append((k.strip(), v.strip()))
        size = {k.lower(): v for k, v in headers}.get("content-length", "")
        if not size.isdecimal():
            raise ValueError("a record without a length")
        block = stream.read(int(size))
        if len(block) < int(size):
            raise ValueError("a record ends early")
        yield headers, block


class _Tags:
    """Where the tags of a page end: at the first `>` outside quoted values, or at the first of all
    where there is none. A quote that never closes is none.

    The work is linear in the page: no walk goes on from where another has found no end.
    """

    def __init__(self, page: str):
        self.page, self.dead = page, set()
        self.last = {q: page.rfind(q) for q in "\"'"}

    def end(self, at: int) -> int:
        walked, place = [], at
        while place not in self.dead and (stop := _STOP.search(self.page, place)):
            if stop[0] == ">":
                return stop.end()
            walked.append(place)
            place = stop.end()
            if self.last[stop[1]] >= place:
                place = self.page.index(stop[1], place) + 1
        self.dead.update(walked, (place,))
        return self.page.find(">", at) + 1


def page_facts(page: str) -> tuple[str, str | None, list[str]]:
    """The visible text (a line for each block element, without blank lines), title and links."""
    page = page.replace("\r", " ").replace("\n", " ")
    text, title, links, at, tags = [], None, [], 0, _Tags(page)
    shuts = page.rfind(">")  # no tag begins after it
    while (token := _TOKEN.search(page, at)) and token.start() < shuts:
        text.append(page[at : token.start()])
        comment, name = token.groups()
        at = token.end()
        if comment:
            close = page.find("-->", at)
            text.append(" ")
            at = len(page) if close < 0 else close + 3
        elif name:
            begun, at = at, tags.end(at)
            name = name.lower()
            if name in _RAW:
                close = _CLOSE[name].search(page, at)
                text.append(" ")
                if name == "title" and title is None and close and close.start() > at:
                    title = " ".join(html.unescape(page[at : close.start()]).split())
                shut = page.find(">", close.end()) if close else -1
                at = len(page) if shut < 0 else shut + 1
            elif name.lstrip("/") in _BREAKS:
                text.append("\n")
            elif name == "a" and (href := _HREF.search(page, begun, at - 1)):
                links.append(html.unescape(href[1] or href[2] or href[3] or ""))
    text.append(page[at:].partition("<!--")[0])
    seen = _SPACE.sub(" ", html.unescape("".join(text)).replace("\xa0", " "))
    lines = (line.strip() for line in seen.split("\n"))
    return "\n".join(x for x in lines if x), title, links


def plain_text(page: str) -> str:
    return page_facts(page)[0]


def _entity(lines: list[str], body: bytes) -> bytes:
    """The body without its transfer and content codings; as it stands where they do not fit it."""
    h = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(":") for x in lines)}
    try:
        if h.get("transfer-encoding") == "chunked":
            out, at = [], 0
            while (n := int(body[at : (cr := body.index(b"\r\n", at))].split(b";")[0], 16)) > 0:
                out.append(body[cr + 2 : cr + 2 + n])
                at = cr + 4 + n
            body = b"".join(out)
        if h.get("content-encoding") in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif h.get("content-encoding") == "deflate":
            body = zlib.decompress(body)
    except (ValueError, OSError, EOFError, zlib.error):
        pass
    return body


def _http(block: bytes) -> tuple[str, list[str], bytes]:
    """Status line, header lines and body of an HTTP response."""
    head, mid, body = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("latin-1").split("\r\n")
    return lines[0], lines[1:], body if mid else b""


def _decoded(header_lines: list[str], body: bytes) -> str:
    kind = next((h for h in header_lines if h.lower().startswith("content-type:")), "").encode()
    found = _CHARSET.search(kind) or _CHARSET.search(body[:1024])
    try:
        return body.decode(found[1].decode() if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derive(headers: list[tuple[str, str]], block: bytes) -> list[tuple[str, str, bytes, bytes]]:
    """(type, id, block, record) of the metadata and the conversion of one response record."""
    h = {k.lower(): v for k, v in headers}
    if not h.get("warc-record-id"):
        raise ValueError("a response without an id")
    source, target, date = h["warc-record-id"], h.get("warc-target-uri", ""), h.get("warc-date", "")
    status, lines, body = _http(block)
    text, title, links = page_facts(_decoded(lines, _entity(lines, body)))
    text = text.encode("utf-8", "replace")
    ids = {kind: record_id(kind, source) for kind in ("metadata", "conversion")}
    fields = [("source-record-id", source), *((f"source-{k.lower()}", v) for k, v in headers if k.lower() not in ("warc-type", "warc-record-id")), ("http-status", status)]
    fields += [(f"http-{k.strip().lower()}", v.strip()) for k, _, v in (x.partition(":") for x in lines)]
    fields += [("source-payload-digest", digest(body)), ("conversion-record-id", ids["conversion"]), ("conversion-payload-digest", digest(text))]
    fields += [("title", title)] if title is not None else []
    fields += [("outlink", x) for x in links]
    meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "replace")
    common = [("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", target), ("WARC-Refers-To-Date", date)]
    out = []
    for kind, what, content in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        own = [("WARC-Record-ID", ids[kind]), *common, ("Content-Type", what)]
        if kind == "conversion":
            own.append(("WARC-Payload-Digest", digest(text)))
        out.append((kind, ids[kind], content, build(kind, own, content)))
    return out


def response(url: str | None, page: str | None, key: str, date: str) -> bytes:
    """A response record around a page; a null url or page is empty."""
    body = (page or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(body)}\r\n\r\n".encode() + body
    uri = (url or "").replace("\r", " ").replace("\n", " ")
    own = [("WARC-Record-ID", record_id("response", key, uri)), ("WARC-Target-URI", uri), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(body))]
    return build("response", own, block)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): a response record of each row of `pages` (page_id, url, html).

    Null urls and pages are empty; repeated rows give equal records; an empty table none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                raw = [response(u, t, str(i), date) for i, u, t in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), pa.array(raw, pa.binary())], ["page_id", "record"])

    return small_batches(pages).select("page_id", "url", "html").mapInArrow(lean(run), "page_id long, record binary")


def _derived(page: int | None, raw: bytes) -> Iterator[tuple]:
    """A row of DERIVED for each derivative of the records in `raw`; malformed ones end it."""
    try:
        stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
        for headers, block in parse(stream):
            h = {k.lower(): v for k, v in headers}
            if h.get("warc-type") == "response":
                for kind, rid, content, whole in derive(headers, block):
                    yield (page, kind, rid, h["warc-record-id"], h.get("warc-target-uri"), h.get("warc-block-digest"), digest(content), len(content), whole)
    except (ValueError, OSError, EOFError, zlib.error) as why:
        yield (page, "malformed", None, None, None, None, None, None, str(why).encode())


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of every response in `records` (page_id, record).

    `record` holds one or more WARC records, plain or gzip members; types other than response
    are passed over, as are null and empty records. Where a record is malformed (no length or id,
    cut short, no WARC at all), what stands before it is derived and one row of type `malformed`
    holds the reason as its record. Empty pages give an empty conversion; very long ones are
    scanned in one pass. Repeated rows give repeated records of equal ids. Other columns are not
    read. An empty table gives an empty table.
    """
    names = [c.split()[0] for c in DERIVED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary())
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                rows = [r for page, raw in zip(part.column("page_id").to_pylist(), part.column("record").to_pylist()) for r in _derived(page, raw or b"")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 9, kinds)], names)

    return small_batches(records).select("page_id", "record").mapInArrow(lean(run), DERIVED)


#: What ends one record and begins the next, of any version.
_SEAM = b"\r\n\r\nWARC/"
_LENGTH = re.compile(rb"^content-length:[ \t]*(\d+)[ \t]*\r?$", re.I | re.M)


def _size(raw: bytes) -> int | None:
    """The bytes that a record takes by its own header, null if it has no length."""
    head = raw.find(b"\r\n\r\n")
    said = _LENGTH.search(raw, 0, head + 2) if head >= 0 else None
    return head + 4 + int(said[1]) if said else None


def _is_whole(raw: bytes) -> bool:
    """Whether the bytes are one record and blank lines, or have no length to go by."""
    size = _size(raw)
    return size is None or (len(raw) >= size and not raw[size:].strip(b"\r\n"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(record) of the pieces of files in their order: a record goes on until its length is reached."""
    file, held, size = None, bytearray(), None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bytes(held)], pa.binary())], ["record"])

    for batch in batches:
        for name, raw in zip(batch.column("file").to_pylist(), batch.column("record").to_pylist()):
            if held and name == file and size is not None and len(held) < size:
                held += _SEAM[:4] + raw
                continue
            if held:
                yield out()
            file, held, size = name, bytearray(raw), _size(raw)
    if held:
        yield out()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record) of WARC files of any version, a record a row (page_id is null).

    Spark's text reader parts the bytes wherever a record may begin, so plain files are split over
    tasks and no file is held whole; files named .gz are read by one task each, as a stream. A
    body that holds such a beginning leaves pieces that miss the length in their header: only files
    with such pieces are read again in order, a task a file and a record at a time, and their
    pieces are joined until each record has its length.
    """
    text = spark.read.text(path, lineSep=_SEAM.decode())
    raw = F.col("value").cast("binary")
    begins = F.lit(_SEAM[4:])
    whole = F.when(F.substring(raw, 1, 5) == begins, raw).otherwise(F.concat(begins, raw))
    order = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place")]
    pieces = text.select(*order, whole.alias("record"))

    def broken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = {n for n, r in zip(batch.column("file").to_pylist(), batch.column("record").to_pylist()) if not _is_whole(r)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(bad), pa.string())], ["file"])

    bad = cut(pieces.select("file", "record").mapInArrow(lean(broken), "file string").distinct())
    records = pieces.select("file", "block", "place", "record")
    if not bad.isEmpty():
        again = records.join(bad, "file", "left_semi").repartition("file").sortWithinPartitions("file", "block", "place")
        joined = again.select("file", "record").mapInArrow(lean(_joined), "record binary")
        records = records.join(bad, "file", "left_anti").select("record").unionByName(joined)
    return records.select(F.lit(None).cast("long").alias("page_id"), "record")
