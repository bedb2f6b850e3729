"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Each response gives a `metadata` record (all headers of the response, its title and links) and a `conversion`
record (its plain text). Both name the response by WARC-Refers-To, keep its target URI, date and digests, and
have a block digest of their own; the metadata record names the conversion. Record ids follow from the contents,
so a repeated task or run gives the same records. A record's bytes are a complete gzip member; files of such
members are WARC files.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import in_batches
from ..functions.markup import TolerantParser

VERSION = "WARC/1.1"
#: Header names in the order they are written. Fixed values of the format, but for the two of the source.
HEADERS = [
    "WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-IP-Address",
    "WARC-Block-Digest", "WARC-Source-Payload-Digest", "WARC-Source-Block-Digest", "Content-Type", "Content-Length",
]
_BLOCKS = {
    "address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table",
    "td", "th", "tr", "ul", "title", "body", "head", "html",
}
_CONTROLS = re.compile(r"[\x00-\x1f\x7f]+")
#: Runs of blanks, but for a single space, which stays as it is.
_BLANKS = re.compile(r"[\t\r\f\v\xa0][ \t\r\f\v\xa0]*| [ \t\r\f\v\xa0]+")
_HIDDEN = {"script", "style", "noscript", "template"}


def digest(block: bytes) -> str:
    """`sha1:` and the base-32 digest, as WARC files have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


class Page(TolerantParser):
    """Title, links and visible text of a page, one line per block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.titles: list[str] = []
        self.links: list[str] = []
        self.hidden, self.in_title = 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag in _BLOCKS:
            self.parts.append("\n")
        self.in_title = tag == "title" and not self.titles
        target = dict(attrs).get("href") if tag == "a" else None
        if target:
            self.links.append(target)

    def handle_endtag(self, tag: str) -> None:
        if tag in _HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in _BLOCKS:
            self.parts.append("\n")
        if tag == "title":
            self.in_title = False

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.titles.append(data)
        elif not self.hidden:
            self.parts.append(data)

    @property
    def text(self) -> str:
        lines = (line.strip() for line in _BLANKS.sub(" ", "".join(self.parts)).split("\n"))
        return "\n".join(line for line in lines if line)


def read_page(markup: str) -> Page:
    """Broken markup is read as far as it goes; unknown marked sections (`<![x`) are skipped. It never fails."""
    page = Page()
    page.feed(markup)
    page.close()
    return page


def serialise(headers: dict[str, str], block: bytes) -> bytes:
    """One gzip member with a record; control characters in header values become spaces."""
    lines = [VERSION, *(f"{n}: {_CONTROLS.sub(' ', headers[n])}" for n in HEADERS if n in headers)]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record's bytes."""
    head, _, rest = gzip.decompress(record).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[:int(headers["Content-Length"])]


def charset_of(source: dict[str, str]) -> str:
    """The character set that the source's Content-Type names, if Python has it, else UTF-8."""
    named = re.search(r"charset=[\"']?([\w.:-]+)", source.get("Content-Type", ""), re.I)
    try:
        return codecs.lookup(named[1]).name if named else "utf-8"
    except LookupError:
        return "utf-8"


def derive(source: dict[str, str], payload: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Metadata and conversion record of a response with headers `source` and body `payload`."""
    page = read_page(payload.decode(charset_of(source), "replace"))
    text = page.text.encode("utf-8", "replace")
    origin = source["WARC-Record-ID"]
    linked = {"WARC-Refers-To": origin, "WARC-Date": source["WARC-Date"]}
    for name, kept in (("WARC-Target-URI", "WARC-Target-URI"), ("WARC-Payload-Digest", "WARC-Source-Payload-Digest"),
                       ("WARC-Block-Digest", "WARC-Source-Block-Digest")):
        if source.get(name):
            linked[kept] = source[name]
    conversion = record_id("conversion", origin, digest(text))
    fields = [*(("source-" + n, source[n]) for n in sorted(source)), ("title", "".join(page.titles)),
              ("payload-length", str(len(payload))), ("text-length", str(len(text))), ("conversion", conversion),
              *(("outlink", link) for link in dict.fromkeys(page.links))]
    about = "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in fields).encode("utf-8", "replace")
    # The format allows an IP address on metadata, not on conversion records.
    address = {"WARC-IP-Address": source["WARC-IP-Address"]} if source.get("WARC-IP-Address") else {}
    for kind, own, media, block, more in (
        ("metadata", record_id("metadata", origin, digest(about)), "application/warc-fields", about, address),
        ("conversion", conversion, "text/plain; charset=utf-8", text, {}),
    ):
        yield linked | more | {
            "WARC-Type": kind, "WARC-Record-ID": own, "WARC-Block-Digest": digest(block), "Content-Type": media,
            "Content-Length": str(len(block)),
        }, block


def responses(
    pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """`key`, `headers` and `payload` of one response per page, for pages that come without WARC headers.

    A null body is an empty payload, a null URL leaves the target out. Record ids follow from id, URL and payload.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    parts = pages.select(F.col(id).alias("key"), F.col(url).alias("url"), payload.alias("payload"))

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        headers = []
        for key, target, block in zip(*(rows.column(i).to_pylist() for i in range(3))):
            found = digest(block)
            own = {"WARC-Type": "response", "WARC-Record-ID": record_id("response", str(key), target or "", found),
                   "WARC-Date": date, "WARC-Payload-Digest": found, "Content-Type": "text/html; charset=utf-8"}
            headers.append(own | ({"WARC-Target-URI": target} if target else {}))
        kind = pa.map_(pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array([list(h.items()) for h in headers], kind), rows.column(2)], names=["key", "headers", "payload"])

    kind = pages.schema[id].dataType.simpleString()
    return in_batches(parts, batch, f"key {kind}, headers map<string,string>, payload binary")


def derivatives(sources: DataFrame) -> DataFrame:
    """Two rows per row of `sources` (`key`, `headers`, `payload`): `key`, `warc_type`, `record_id`, `refers_to`,
    `headers`, `block` and `record`, the bytes of the record in a WARC file.

    A source needs the headers WARC-Record-ID, WARC-Date and WARC-Payload-Digest; where headers are null or lack
    one, an id is made from key and payload, the date is that of the epoch and the digest is worked out. A null
    payload is empty. Sources that repeat give records that repeat.
    """
    names = ["key", "warc_type", "record_id", "refers_to", "headers", "block", "record"]

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        taken, out = [], []
        for n, (key, headers, payload) in enumerate(zip(*(rows.column(i).to_pylist() for i in range(3)))):
            source, payload = {k: v for k, v in headers or [] if v is not None}, payload or b""
            source.setdefault("WARC-Payload-Digest", digest(payload))
            source.setdefault("WARC-Record-ID", record_id("response", str(key), source["WARC-Payload-Digest"]))
            source.setdefault("WARC-Date", "1970-01-01T00:00:00Z")
            for own, block in derive(source, payload):
                taken.append(n)
                out.append((own["WARC-Type"], own["WARC-Record-ID"], own["WARC-Refers-To"], list(own.items()), block, serialise(own, block)))
        kinds = [pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.binary()]
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(taken, pa.int64())), *columns], names=names)

    kind = sources.schema["key"].dataType.simpleString()
    schema = (f"key {kind}, warc_type string, record_id string, refers_to string, headers map<string,string>, "
              "block binary, record binary")
    return in_batches(sources.select("key", F.col("headers"), F.col("payload").cast("binary").alias("payload")), batch, schema)


def text_of(block: Column) -> Column:
    return F.decode(block, "UTF-8")
