"""Web archive records: responses, and the metadata and text records derived from them."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import as_batch
from corpusloom.llm.html_tokens import Token, attributes, lex, text_of

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs, RFC 4122
RECORD = "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, headers map<string,string>, block binary"
_FIELDS = {
    "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Target-URI": "target_uri", "WARC-Date": "date", "Content-Type": "content_type",
}
_LINKING = frozenset("a area link img script iframe source form".split())
_SCHEMA = pa.schema(
    [(n, pa.string()) for n in ("warc_type", "record_id", "refers_to", "target_uri", "date", "content_type")] + [("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())]
)


def digest(block: bytes) -> str:
    """The labelled digest of a block: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    """An identifier that is the same each time the same parts are given."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def split_response(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers by lower-case name (values of a repeated one joined by a comma) and payload of an HTTP message."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        head, found, payload = block.partition(b"\n\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", {}, block
    status, *lines = re.split(r"\r?\n", head.decode("latin-1"))
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            name = name.strip().lower()
            headers[name] = f"{headers[name]}, {value.strip()}" if name in headers else value.strip()
    return status, headers, payload


def decode(payload: bytes, headers: dict[str, str]) -> str:
    """The payload as text by the charset of its header, else of the page's own declaration, else UTF-8."""
    said = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", headers.get("content-type", ""), re.I)
    if not said and (meta := re.search(rb"<meta[^>]+charset\s*=\s*[\"']?([\w.:-]+)", payload[:1024], re.I)):
        said = re.match(r"(.+)", meta[1].decode("ascii", "replace"))
    try:
        return payload.decode(said[1] if said else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def links(tokens: Iterable[Token]) -> list[str]:
    """Targets and places of the links of a page with these tokens, as ``url L tag/@attribute``, in order."""
    found = []
    for kind, element, source in tokens:
        if kind == "open" and element in _LINKING:
            for name, value in attributes(source).items():
                if name in ("href", "src", "action") and value.strip():
                    found.append(f"{' '.join(value.split())} L {element}/@{name}")
    return found


def page_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Response records of crawled pages, and the id of the page.

    A null page is an empty one, a null address an empty string. Rows equal in id, address and page get
    the same record id.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), *_SCHEMA])
        for batch in batches:
            rows = []
            for number, uri, body in zip(*(batch.column(n).to_pylist() for n in ("id", "uri", "body"))):
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                payload = digest(body)
                own = record_id("response", str(number), uri, payload)
                headers = [("WARC-Payload-Digest", payload), ("WARC-Block-Digest", digest(head + body))]
                rows.append((number, "response", own, None, uri, date, "application/http; msgtype=response", headers, head + body))
            yield as_batch(rows, schema)

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    given = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), text(url).alias("uri"), text(page).cast("binary").alias("body"))
    return given.mapInArrow(build, "page_id long, " + RECORD)


def derive(responses: DataFrame, id_col: str | None = None) -> DataFrame:
    """For each response a metadata record and a conversion record that refer to it.

    The metadata record lists the response's status, its own headers, its payload digest and its links
    (``application/warc-fields``), and names the conversion made of it. The conversion record is the
    payload's plain text. Both carry the response's address and date, and digests of their own blocks.
    Ids are made from the response's, so a task that is run again gives the same records. Records of
    other types give none. Null fields count as empty; a response with an empty or null block gets both
    records, the conversion empty. ``id_col`` is carried along as ``page_id``.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), *_SCHEMA])
        for batch in batches:
            rows = []
            names = ("page_id", "warc_type", "record_id", "target_uri", "date", "headers", "block")
            for number, kind, source, uri, date, given, block in zip(*(batch.column(n).to_pylist() for n in names)):
                if kind != "response":
                    continue
                source, uri = source or "", uri or ""
                status, headers, payload = split_response(block or b"")
                tokens = list(lex(decode(payload, headers)))
                text = text_of(tokens).encode()
                known, own = dict(given or ()), digest(payload)
                lines = [f"http-status: {status}"] + [f"http-header-{n}: {v}" for n, v in headers.items()]
                lines += [f"source-{n.lower()}: {v}" for n, v in known.items() if n.endswith("-Digest")]
                lines += [f"computed-payload-digest: {own}", f"conversion: {record_id('conversion', source)}"]
                lines += [f"outlink: {link}" for link in links(tokens)]
                described = "".join(f"{line}\r\n" for line in lines).encode()
                for made, content, body in (("metadata", "application/warc-fields", described), ("conversion", "text/plain; charset=utf-8", text)):
                    extra = [("WARC-Block-Digest", digest(body)), ("WARC-Source-Payload-Digest", known.get("WARC-Payload-Digest") or own)]
                    rows.append((number, made, record_id(made, source), source, uri, date, content, extra, body))
            yield as_batch(rows, schema)

    number = F.col(f"`{id_col}`").cast("long") if id_col else F.lit(None).cast("long")
    given = responses.select(number.alias("page_id"), "warc_type", "record_id", "target_uri", "date", "headers", "block")
    return given.mapInArrow(build, "page_id long, " + RECORD)


def to_bytes(record: dict) -> bytes:
    """One record as it stands in a file."""
    block = record["block"] or b""
    lines = [f"{shown}: {record[name]}" for shown, name in _FIELDS.items() if record.get(name)]
    lines += [f"{n}: {v}" for n, v in dict(record.get("headers") or ()).items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def from_bytes(data: bytes) -> Iterator[dict]:
    """The records of a file's bytes, in order. A record cut off at the end is left out."""
    at = 0
    while (begin := data.find(b"WARC/", at)) >= 0 and (head := data.find(b"\r\n\r\n", begin)) >= 0:
        record: dict = {name: None for name in _FIELDS.values()} | {"headers": {}}
        length = 0
        for line in data[begin:head].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(": ")
            if name == "Content-Length":
                length = int(value)
            elif name in _FIELDS:
                record[_FIELDS[name]] = value
            else:
                record["headers"][name] = value
        at = head + 4 + length
        if at > len(data):
            return
        yield record | {"block": data[head + 4 : at]}


def read_records(spark, path: str) -> DataFrame:
    """Records of uncompressed archive files, read by Spark; a file is one task's work."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                yield as_batch([tuple(list(r["headers"].items()) if n == "headers" else r[n] for n in _SCHEMA.names) for r in from_bytes(content)], _SCHEMA)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORD)
