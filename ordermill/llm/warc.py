"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record holds an HTTP response. Of each one two records are derived
that refer to it by its id and keep its target and date:

* ``metadata`` (application/warc-fields): the title, the language, the links
  (resolved against the target, in order, each once), the source's HTTP headers
  and digests, and the ids of the conversion;
* ``conversion`` (text/plain): the visible text of the page.

Record ids are UUIDs made from the response's id and the kind of record, so a
repeated run gives the same ones. Digests are SHA-1 in base 32 over the block,
as ``WARC-Block-Digest``; the source's payload digest is kept in both.

A null or empty payload gives records with empty text; a null target gives
records without one, and relative links stay as they are. Repeated rows each
give their records, with equal ids. Input columns beside the named ones are not
looked at.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")
_OPENS = re.compile(r"<(?:!--|([!?]?/?)([a-zA-Z][a-zA-Z0-9]*))")
#: Elements whose content isn't shown.
HIDDEN = frozenset(("script", "style", "noscript", "template", "head"))
#: Elements that end a line of text.
BLOCKS = frozenset(
    "address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main nav ol p pre section table td th tr ul".split())
_BLANKS = re.compile(r"[^\S\n]+")
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)


def record_id(source: str, what: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{what} {source}')}>"


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def pieces(html: str) -> Iterator[tuple[str, str, int, int]]:
    """Kind, name, start and end of the page's pieces, in one pass.

    Kinds are ``text``, ``tag`` (with the element's name, led by / if it closes) and
    ``hidden`` (a comment, or an element that isn't shown, as a whole). A tag ends at
    the next >; without one, what follows is text. A hidden element or a comment that
    isn't closed goes on to the end of the page.
    """
    at = done = 0
    while m := _OPENS.search(html, at):
        at = m.start()
        if m[2] is None:
            stop = html.find("-->", m.end())
            kind, name, end = "hidden", "!--", len(html) if stop < 0 else stop + 3
        else:
            stop = html.find(">", m.end())
            if stop < 0:
                break
            kind, name, end = "tag", m[1] + m[2].lower(), stop + 1
            if name in HIDDEN:
                close = re.compile(rf"</{name}\s*>", re.I).search(html, end)
                kind, end = "hidden", close.end() if close else len(html)
        if at > done:
            yield "text", "", done, at
        yield kind, name, at, end
        at = done = end
    if done < len(html):
        yield "text", "", done, len(html)


def page_text(html: str) -> str:
    """Visible text: a line per block element, blanks made single, no empty lines."""
    out = []
    for kind, name, start, end in pieces(html):
        if kind == "text":
            out.append(html[start:end])
        elif kind == "hidden":
            out.append(" ")
        elif name.lstrip("/") in BLOCKS:
            out.append("\n")
    lines = [x.strip() for x in _BLANKS.sub(" ", unescape("".join(out))).split("\n")]
    return "\n".join([x for x in lines if x])


def opening(html: str, name: str) -> Iterator[tuple[int, int]]:
    """Start and end of the opening tags of an element, wherever they stand."""
    for m in re.finditer(rf"<{name}\b", html, re.I):
        stop = html.find(">", m.end())
        if stop < 0:
            return
        yield m.start(), stop + 1


def title_of(html: str) -> str | None:
    for _, end in opening(html, "title"):
        close = re.compile(r"</title\s*>", re.I).search(html, end)
        return _line(html[end:close.start()]) if close else None
    return None


def language_of(html: str) -> str | None:
    upto = 0
    for start, end in opening(html, "html"):
        if start >= upto and (m := _LANG.search(html, start, end)):
            return m[1]
        upto = max(upto, end)
    return None


def _line(text: str) -> str:
    return " ".join(unescape(text).split())


def links(html: str, target: str | None) -> list[str]:
    """Targets of the page's links, resolved, in order, each once."""
    found = []
    for kind, name, start, end in pieces(html):
        m = _HREF.search(html, start, end - 1) if kind == "tag" and name == "a" else None
        if m is None:
            continue
        href = _line(m[1] or m[2] or m[3] or "").partition("#")[0]
        if href and not href.lower().startswith(("javascript:", "mailto:", "data:")):
            try:
                found.append(urljoin(target, href) if target else href)
            except ValueError:  # a malformed address is kept as it stands
                found.append(href)
    return list(dict.fromkeys(found))


def responses(pages: DataFrame, key: str, url: str, html: str, date: str) -> DataFrame:
    """Crawled pages as response records: warc_id, target, date, http_headers, payload.

    A table of pages has no responses, so ids come from the key, the date is the
    crawl's and the headers tell type and length only. Records read from an archive
    go to ``derivatives`` as they are."""
    return pages.select(
        F.col(key).alias("source_key"), F.col(url).alias("target"), F.lit(date).alias("date"),
        F.concat_ws("", F.lit("<urn:response:"), F.coalesce(F.col(key).cast("string"),
                                                           F.lit("null")), F.lit(">"))
        .alias("warc_id"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                       "Content-Length: "),
                 F.coalesce(F.octet_length(html), F.lit(0)).cast("string")).alias("http_headers"),
        F.col(html).alias("payload"))


def header_fields(headers: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """Status line and fields of an HTTP header in their order, repeated ones each; a
    line that begins with a blank goes on with the one before."""
    lines: list[str] = []
    for line in (headers or "").replace("\r\n", "\n").split("\n"):
        if line[:1] in " \t" and line.strip() and lines:
            lines[-1] += " " + line.strip()
        elif line:
            lines.append(line)
    status = lines.pop(0).strip() if lines and lines[0].startswith("HTTP/") else None
    split = [x.partition(":") for x in lines]
    return status, [(n.strip().lower(), v.strip()) for n, colon, v in split if colon]


def derive(source: str, target: str | None, date: str | None, headers: str | None,
           payload: str | None) -> list[tuple]:
    """The two records of a response, as rows of ``RECORDS`` without the key."""
    html = payload or ""
    digest = sha1(html.encode())
    text = page_text(html).encode()
    meta_id, text_id = record_id(source, "metadata"), record_id(source, "conversion")
    status, http = header_fields(headers)
    fields = [("title", title_of(html)), ("language", language_of(html)),
              ("conversion", text_id), ("payload-digest", digest),
              *[("http-" + n, v) for n, v in http], ("http-status", status)]
    fields += [("outlink", x) for x in links(html, target)]
    meta = "".join(f"{n}: {v}\r\n" for n, v in fields if v).encode()
    rows = []
    for kind, own, mime, block in (("metadata", meta_id, "application/warc-fields", meta),
                                   ("conversion", text_id, "text/plain; charset=utf-8", text)):
        head = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source),
                ("WARC-Target-URI", target), ("WARC-Date", date),
                ("WARC-Block-Digest", sha1(block)), ("WARC-Source-Payload-Digest", digest),
                ("Content-Type", mime), ("Content-Length", str(len(block)))]
        header = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in head if v is not None)
        rows.append((kind, own, source, target, date, mime, len(block), sha1(block), digest,
                     header, block.decode()))
    return rows


NAMES = ("warc_type", "record_id", "refers_to", "target", "date", "content_type",
         "content_length", "block_digest", "payload_digest", "header", "block")


def derivatives(source: DataFrame) -> DataFrame:
    """Two rows per response record: ``source_key`` and the columns ``NAMES``."""
    kind = dict(source.dtypes)["source_key"]
    schema = f"source_key {kind}, " + ", ".join(
        f"{n} {'long' if n == 'content_length' else 'string'}" for n in NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = [r for x in zip(*[part[c].to_pylist() for c in (
                    "warc_id", "target", "date", "http_headers", "payload")]) for r in derive(*x)]
                keys = part["source_key"].take(pa.array([i // 2 for i in range(len(rows))]))
                yield pa.RecordBatch.from_arrays(
                    [keys, *[pa.array([r[i] for r in rows],
                                      pa.int64() if n == "content_length" else pa.string())
                             for i, n in enumerate(NAMES)]], ["source_key", *NAMES])

    return source.select("source_key", "warc_id", "target", "date", "http_headers",
                         "payload").mapInArrow(run, schema)
