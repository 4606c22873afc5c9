r"""WARC derivatives (op 4): metadata and plain-text conversion records from response records.

A response (record id, target URI, date, HTTP block) gives two records that refer to it:
- `metadata` (application/warc-fields): the source's headers, title, language and link targets;
- `conversion` (text/plain): the visible text of an HTML payload.
Both carry WARC-Refers-To with the response's identifier, the target URI and date of the source, and SHA-1
digests (base 32) of their block; the conversion also has the source's payload digest, so either can be
traced to the bytes it was made from. Identifiers are name-based, hence the same in every run.

A page is read once and forwards, in time that is linear in its length: a comment ends at the next "-->", a script,
style, noscript or template element at its next end tag, any other tag at the next ">"; what has no end is text (a tag
without its element's end is a tag). Links and the language are read inside their tag.

Null and empty pages give records with an empty payload; a null URL leaves WARC-Target-URI out, and white space and
control characters of a URL are percent-encoded there; repeated rows give repeated records with equal identifiers; a null
page_id stays null; an empty table gives an empty result; only the named columns are read, and page_id keeps its type.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from spotweave.runtime import limit_batches

DATE = "2024-01-01T00:00:00Z"  # pages have no date of their own
SCHEMA = "record_type string, record_id string, refers_to string, target_uri string, content_type string, content_length long, block_digest string, payload_digest string, source_headers string, block string"

SKIPPED = ("script", "style", "noscript", "template")
BLOCKS = frozenset("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 section article nav header footer title head body html blockquote pre hr".split())
NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9]*)")
END = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}
TITLE_END = re.compile(r"</title", re.I)
LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s>]+))", re.I)


class Page:
    """What a page holds: text (a line for each block, white space collapsed), title, language and link targets."""

    def __init__(self, html: str):
        self.title: str | None = None
        self.lang: str | None = None
        self.links: list[str] = []
        parts: list[str] = []
        ended: set[str] = set()  # kinds of ends that do not come again
        at = 0
        while (lt := html.find("<", at)) >= 0:
            parts.append(html[at:lt])
            at = self._markup(html, lt, parts, ended)
        parts.append(html[at:])
        lines = entities.unescape("".join(parts)).split("\n")
        self.text = "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)

    def _markup(self, html: str, lt: int, parts: list[str], ended: set[str]) -> int:
        """The position after what starts at the sign lt, having noted it."""
        if html.startswith("<!--", lt) and "-->" not in ended:
            if (end := html.find("-->", lt + 4)) >= 0:
                parts.append(" ")
                return end + 3
            ended.add("-->")
        named = NAME.match(html, lt + 1)
        name = named[1].lower() if named else ""
        if name in SKIPPED and html[lt + 1] != "/" and name not in ended:
            if found := END[name].search(html, named.end()):
                parts.append(" ")
                return found.end()
            ended.add(name)
        tag = named or html.startswith(("</", "<!"), lt)
        end = html.find(">", lt) if tag and ">" not in ended else -1
        if end < 0:
            if tag:
                ended.add(">")
            parts.append("<")
            return lt + 1
        if name in BLOCKS:
            parts.append("\n")
        if html[lt + 1] != "/":
            self._tag(name, html, named.end() if named else lt, end, ended)
        return end + 1

    def _tag(self, name: str, html: str, start: int, end: int, ended: set[str]) -> None:
        if name == "a" and (m := HREF.search(html, start, end)):
            self.links.append(one_line(next(g for g in m.groups() if g is not None)))
        elif name == "html" and self.lang is None and (m := LANG.search(html, start, end)):
            self.lang = m[1]
        elif name == "title" and self.title is None and "title" not in ended:
            if m := TITLE_END.search(html, end):
                self.title = one_line(html[end + 1 : m.start()])
            else:
                ended.add("title")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_text(html: str) -> str:
    """Visible text, one line for each block, white space collapsed."""
    return Page(html).text


def one_line(s: str) -> str:
    return " ".join(entities.unescape(s).split())


def split_http(block: bytes) -> tuple[str, bytes]:
    """Header lines and payload of an HTTP response block."""
    head, found, payload = block.partition(b"\r\n\r\n")
    return (head.decode("utf-8", "replace"), payload) if found else ("", block)


def derive(record_id: str, target_uri: str | None, block: bytes) -> list[dict]:
    """The metadata and the conversion record of one response record."""
    head, payload = split_http(block)
    page = payload.decode("utf-8", "replace")
    source = digest(payload)
    found = Page(page)
    fields = [("source-digest", source), ("source-length", str(len(payload)))]
    fields += [("http-header", line) for line in head.split("\r\n") if line]
    fields += [("title", found.title)] if found.title is not None else []
    fields += [("languages", found.lang)] if found.lang else []
    fields += [("outlink", link) for link in found.links]
    blocks = {"metadata": "".join(f"{k}: {v}\r\n" for k, v in fields), "conversion": found.text}
    out = []
    for kind, text in blocks.items():
        data = text.encode("utf-8", "replace")
        out.append(
            {
                "record_type": kind,
                "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, kind + record_id)}>",
                "refers_to": record_id,
                "target_uri": target_uri,
                "content_type": "application/warc-fields" if kind == "metadata" else "text/plain",
                "content_length": len(data),
                "block_digest": digest(data),
                "payload_digest": source,
                "source_headers": head,
                "block": text,
            }
        )
    return out


def one_header(uri: str | None) -> str | None:
    """A URI as a header can hold it."""
    return uri if uri is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def record_bytes(record: dict, date: str = DATE) -> bytes:
    """A record as WARC/1.1 writes it."""
    data = record["block"].encode("utf-8", "replace")
    named = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record.get("refers_to")),
        ("WARC-Target-URI", one_header(record.get("target_uri"))), ("WARC-Date", date), ("WARC-Block-Digest", record["block_digest"]),
        ("WARC-Payload-Digest", record.get("payload_digest")), ("Content-Type", record["content_type"]), ("Content-Length", str(len(data))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named if v is not None).encode() + b"\r\n" + data + b"\r\n\r\n"


def read_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record in a WARC file's bytes; the lengths given decide, not the content."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def response_of(page_id, url: str | None, html: str | None) -> tuple[str, bytes]:
    """Record id and HTTP block of the response that a stored page came from."""
    payload = (html or "").encode("utf-8", "replace")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>", head.encode() + payload


def derive_records(pages: DataFrame) -> DataFrame:
    """The two derived records of every page, and with them what SCHEMA names."""
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, {SCHEMA}"
    names = [c.split()[0] for c in schema.split(", ")]
    whole = {"page_id": "Int64"} if isinstance(pages.schema["page_id"].dataType, IntegralType) else {}

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[dict] = []
            size = 0
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                page_id = None if pd.isna(page_id) else int(page_id) if whole else page_id
                url, html = (x if isinstance(x, str) else None for x in (url, html))
                record_id, block = response_of(page_id, url, html)
                rows += [{"page_id": page_id, **r} for r in derive(record_id, url, block)]
                size += len(block)
                if size > 8_000_000:
                    yield pd.DataFrame(rows, columns=names).astype(whole)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=names).astype(whole)

    limit_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(build, schema)


def warc_file_rows(records: DataFrame) -> DataFrame:
    """(page_id, record_type, warc): each record's WARC bytes, ready to be written part by part."""

    @F.pandas_udf("binary")
    def rendered(r: pd.DataFrame) -> pd.Series:
        return pd.Series([record_bytes(x) for x in r.to_dict("records")], dtype=object)

    cols = ["record_type", "record_id", "refers_to", "target_uri", "content_type", "block_digest", "payload_digest", "block"]
    return records.select("page_id", "record_type", rendered(F.struct(*cols)).alias("warc"))
