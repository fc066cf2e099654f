"""WARC derivative builder: metadata and conversion records from response records.

Records are parsed from bytes, gzip members or plain, in one pass that holds a
record at a time; after a bad stretch it goes on at the next record.  Each response with an
HTTP block gives one ``metadata`` record, which carries the HTTP status and
headers and the source record's own named fields, and, if its payload is HTML or
plain text, one ``conversion`` record with the visible text.  Both refer to the
response by ``WARC-Refers-To``, keep its target and date, and have digests of
their own; the source's digests go into the metadata unchanged.

Derived records are UTF-8 text throughout, so Spark's text writer can write
them as WARC files on any file system the executors reach.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import arrow_batches, map_arrow, raw
from trailmark.llm.html_main import visible_text

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's name space of URLs
TEXT_TYPES = ("text/html", "application/xhtml+xml", "text/plain")

SCHEMA = (
    "source_seq long, record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_block_digest string, source_payload_digest string, http_status int, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(10).join(parts))}>"


def serialize(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record; line breaks in values become spaces."""
    head = "".join(f"{k}: {re.sub(r'[' + chr(13) + chr(10) + ']+', ' ', v)}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def response(url: str, body: bytes, date: str, headers: list[tuple[str, str]] | None = None, status: str = "200 OK") -> bytes:
    """A response record around an HTTP/1.1 message."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers or [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))])
    block = f"HTTP/1.1 {status}\r\n{head}\r\n".encode() + body
    fields = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", url, date, digest(block))), ("WARC-Date", date), ("WARC-Target-URI", url),
        ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(body)), ("Content-Type", "application/http; msgtype=response"),
    ]
    return serialize(fields, block)


def _headers(lines: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in re.split(rb"\r?\n", lines):
        if line[:1] in (b" ", b"\t") and out:  # a folded line goes on
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.decode('utf-8', 'replace').strip()}")
        elif b":" in line:
            k, _, v = line.partition(b":")
            out.append((k.decode("utf-8", "replace").strip(), v.decode("utf-8", "replace").strip()))
    return out


def first(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


#: Bytes inflated or read at once; where a file is cut into rows, the size of a row.
STEP, PART_BYTES = 256 << 10, 32 << 20
_START = re.compile(rb"WARC/\d+\.\d+[ \t]*\r?\n")
_BLANK = re.compile(rb"\r?\n\r?\n")


def _inflated(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The pieces of a file with its gzip members inflated; what is not gzip as it is, broken members as far as they go."""
    z, rest = None, b""
    for piece in pieces:
        rest = rest + piece if rest else piece
        while rest:
            if z is None:
                if len(rest) < 2 and rest == b"\x1f":
                    break  # the next byte decides
                if rest[:2] != b"\x1f\x8b":
                    at = rest.find(b"\x1f\x8b", 1)
                    cut = at if at > 0 else len(rest) - rest.endswith(b"\x1f")
                    yield rest[:cut]
                    rest = rest[cut:]
                    continue
                z = zlib.decompressobj(31)
            data, rest = rest, b""
            for a in range(0, len(data), STEP):  # so that what follows a member is copied once a step only
                try:
                    out = z.decompress(data[a : a + STEP])
                except zlib.error:
                    z, out, at = None, b"", data.find(b"\x1f\x8b", a + 2)
                    rest = data[at:] if at >= 0 else b""
                    break
                if out:
                    yield out
                if z.eof:
                    rest = z.unused_data + data[a + STEP :]
                    z = None
                    break
    if z is None and rest:
        yield rest


def parse_pieces(pieces: Iterable[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(named fields, block) of each whole record of a file that comes in pieces; bad stretches are left out."""
    source, data, ended = _inflated(pieces), bytearray(), False

    def more(n: int) -> bool:
        """Have at least n bytes, if there are as many."""
        nonlocal ended
        while len(data) < n and not ended:
            piece = next(source, None)
            ended = piece is None
            data.extend(piece or b"")
        return len(data) >= n

    at = 0
    while True:
        del data[:at]
        at = 0
        m = _START.search(data)
        while not m and not ended:
            at = max(0, len(data) - 32)
            more(len(data) + 1)
            m = _START.search(data, at)
        if not m:
            return
        del data[: m.start()]
        at, looked = m.end() - m.start(), 0
        end = _BLANK.search(data, at - 2)
        while not end and not ended:
            looked = max(at - 2, len(data) - 4)
            more(len(data) + 1)
            end = _BLANK.search(data, looked)
        if not end:
            continue  # a head without an end: look for a later start in it
        again = _START.search(data, at, end.start())
        if again:  # the head was cut off, and another record begins in it
            at = again.start()
            continue
        fields = _headers(bytes(data[at : end.start()]))
        size, begin = first(fields, "Content-Length") or "", end.end()
        if not size.isdigit():
            continue
        if not more(begin + int(size)):
            continue  # cut off; a record may yet begin in what is left
        block = bytes(data[begin : begin + int(size)])
        tail = begin + int(size)
        more(tail + 4)
        after = bytes(data[tail : tail + 4]).lstrip(b"\r\n")
        if after and not b"WARC".startswith(after[:4]) and _START.search(block):
            continue  # the length is wrong: it runs over the start of another record
        at = tail
        yield fields, block


def parse(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(named fields, block) of each whole record; bad stretches and cut-off records are left out."""
    return parse_pieces(data[a : a + STEP] for a in range(0, len(data), STEP))


def _body(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """Undo chunked transfer and gzip or deflate coding, as far as they go."""
    if "chunked" in (first(headers, "Transfer-Encoding") or "").lower():
        parts, rest = [], body
        size, at = re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r?\n"), 0
        while m := size.match(rest, at):
            n = int(m[1], 16)
            if not n:
                break
            parts.append(rest[m.end() : m.end() + n])
            at = m.end() + n
            at += 2 if rest[at : at + 2] == b"\r\n" else 1
        body = b"".join(parts) or body
    coding = (first(headers, "Content-Encoding") or "").lower()
    try:
        if "gzip" in coding:
            return gzip.decompress(body)
        if "deflate" in coding:
            return zlib.decompress(body, 15 if body[:1] == b"\x78" else -15)
    except (OSError, EOFError, zlib.error):
        pass
    return body


def _decode(content_type: str, body: bytes) -> str:
    m = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type, re.I) or re.search(r"<meta[^>]+charset\s*=\s*[\"']?([\w.:-]+)", body[:4096].decode("latin-1"), re.I)
    try:
        return body.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def derive(fields: list[tuple[str, str]], block: bytes) -> list[tuple]:
    """The derived records of one record, as tuples of SCHEMA without source_seq; none unless it is a response."""
    if (first(fields, "WARC-Type") or "").lower() != "response" or not block.startswith(b"HTTP/"):
        return []
    source, target, date = (first(fields, k) or "" for k in ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date"))
    cut = _BLANK.search(block)  # bare line feeds end lines as well
    head, body = (block[: cut.start()], block[cut.end() :]) if cut else (block, b"")
    status_line, _, rest = head.partition(b"\n")
    status_line = status_line.rstrip(b"\r")
    headers, status = _headers(rest), re.match(rb"HTTP/\S+\s+(\d{3})", status_line)
    code = int(status[1]) if status else None
    digests = first(fields, "WARC-Block-Digest"), first(fields, "WARC-Payload-Digest")
    text = None
    content = first(headers, "Content-Type") or "text/html"
    kind = content.partition(";")[0].strip().lower()
    if kind in TEXT_TYPES:
        text = _decode(content, _body(headers, body))
        text = text if kind == "text/plain" else visible_text(text)
    ids = {k: record_id(k, source, target, date) for k in ("metadata", "conversion")}
    about = [("http-status", status_line.decode("utf-8", "replace"))] + [(f"http-header-{k.lower()}", v) for k, v in headers] + [(f"source-{k.lower()}", v) for k, v in fields]
    about += [("conversion-record-id", ids["conversion"])] if text is not None else []
    made = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in about))]
    if text is not None:
        made.append(("conversion", "text/plain; charset=utf-8", text))
    out = []
    for name, mime, content in made:
        data = content.encode("utf-8", "replace")
        out.append((name, ids[name], source, target, date, mime, len(data), digest(data), *digests, code, data.decode()))
    return out


def derivatives(records: DataFrame, column: str = "content", seq: str = "source_seq") -> DataFrame:
    """Derived records of every response in the binary ``column``, which holds one or more records.

    ``seq`` (long) is handed on as source_seq.  Null, empty and malformed
    content, cut-off records and other record types give nothing, and the records
    after them are read all the same; repeated records are each derived, with
    equal ids; a response without a content type counts as HTML; missing named
    fields are empty, missing digests null.  Very long bodies are converted
    whole.  Extra columns are ignored, whatever they are called; an empty table
    gives an empty result.
    """
    rows = records.select(F.col(seq).cast("long").alias("source_seq"), F.col(column).alias("content"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [(n, *d) for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for fields, block in parse(bytes(data or b"")) for d in derive(fields, block)]
        columns = list(zip(*made)) or [()] * 13
        kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), *[pa.string()] * 3, pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return map_arrow(rows, run, SCHEMA)


def responses(pages: DataFrame, date: str, seq: str = "page_id") -> DataFrame:
    """Pages (``seq``, url, html) as response records: source_seq and content; nulls are empty."""
    rows = pages.select(F.col(seq).cast("long").alias("source_seq"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [response(u.decode(), h, date) for u, h in zip(raw(batch.column(1)), raw(batch.column(2)))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["source_seq", "content"])

    return map_arrow(rows, run, "source_seq long, content binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files under ``path``, gzip or plain, whatever they are called: (source_seq, path, content), a record a row.

    Spark hands a task each file's bytes as one value, so a file must be under 2 GB;
    beyond that a task holds about ``PART_BYTES`` of records.  Files of another kind
    have no records and give no rows.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda rows: pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], names=["path", "content"])
        for batch in batches:
            for i in range(batch.num_rows):
                name, view = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                rows, size = [], 0
                for fields, block in parse_pieces(bytes(view[a : a + STEP]) for a in range(0, len(view), STEP)):
                    rows.append((name, serialize([f for f in fields if f[0].lower() != "content-length"], block)))
                    size += len(block)
                    if size > PART_BYTES:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return arrow_batches(found, run, "path string, content binary").select(F.monotonically_increasing_id().alias("source_seq"), "path", "content")


def write_files(derived: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write derived records as WARC/1.1 text files, one a partition, from the executors; ``read_files`` reads them."""
    line = lambda k, c: F.concat(F.lit(f"{k}: "), F.regexp_replace(c, r"[\r\n]+", " "), F.lit("\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")), line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"), F.col("block"), F.lit("\r\n"),
    )
    derived.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", compression).text(path)
