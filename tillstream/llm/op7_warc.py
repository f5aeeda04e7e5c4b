"""WARC derivatives: metadata and plain-text conversion records of response records.

Every response yields a ``conversion`` record with the text of its HTML, and a ``metadata`` record about it. Both keep the
response's target URI and date and name it in WARC-Refers-To; the metadata record also names the conversion, and repeats the source headers and
the payload digest, so each derivative can be traced. Digests are SHA-1 in base 32, as the format has them. Record
ids are made from what they stand for, so a task that runs twice writes the same records.

Defined results: a null or empty body gives an empty conversion; a null URI is left out; equal responses have the
same ids; bodies of any length are converted whole, in time that follows their length. Only the columns asked for are read,
whatever the others are called. ``responses`` stands in for an archive: the table has no headers and no date, so it gives
Content-Type and Content-Length as a server would, and one fixed date.
"""

from __future__ import annotations

import base64
import hashlib
import html
import uuid
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
SKIPPED = {n: regex.compile(rf"</{n}\s*>", regex.I) for n in ("script", "style", "template", "noscript")}
BREAKS = frozenset("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 article section nav header footer title blockquote pre".split())
NAME = regex.compile(r"/?([a-z][a-z0-9]*)\b", regex.I)
SPACE = regex.compile(r"[^\S\n]+")
TITLE_END = regex.compile(r"</title\s*>", regex.I)
HREF = regex.compile(r"""\bhref\s*=\s*["']?[^"'\s>]""", regex.I)
FIELDS = ("warc_type string, record_id string, refers_to string, conversion_id string, target_uri string, content_type string, "
          "content_length long, block_digest string, payload_digest string, headers string, block string")
KIND = {"string": pa.string(), "long": pa.int64()}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def reading(page: str) -> tuple[str, str | None, int]:
    """(text, title, links) of a page, from one pass over it.

    A tag goes from ``<`` to the next ``>``; from the first ``<`` without one on, nothing is text. Comments, scripts and the like are
    left out up to their end or that of the page. The text has a line for each block; the title is that of the first title
    element, and links are ``a`` tags with an address. Whatever is not found is looked for once, so the time follows the length.
    """
    out, title, links, at, no_title = [], None, 0, 0, False
    while (i := page.find("<", at)) >= 0:
        out.append(page[at:i])
        if page.startswith("<!--", i):
            out.append(" ")
            end = page.find("-->", i + 4)
            at = len(page) if end < 0 else end + 3
            continue
        named = NAME.match(page, i + 1)
        name = named.group(1).lower() if named else ""
        opens = page[i + 1:i + 2] != "/"
        if name in SKIPPED and opens:
            out.append(" ")
            end = SKIPPED[name].search(page, named.end())
            at = end.end() if end else len(page)
            continue
        j = page.find(">", i)
        if j < 0:
            at = len(page)
            break
        if name in BREAKS:
            out.append("\n")
        if name == "a" and opens:
            links += HREF.search(page, i, j) is not None
        elif name == "title" and opens and title is None and not no_title:
            end = TITLE_END.search(page, j + 1)
            no_title = end is None
            title = page[j + 1:end.start()] if end else None
        at = j + 1
    out.append(page[at:])
    lines = (SPACE.sub(" ", line).strip() for line in html.unescape("".join(out)).split("\n"))
    title = None if title is None else SPACE.sub(" ", html.unescape(title)).strip()
    return "\n".join(line for line in lines if line), title, links


def plain_text(page: str) -> str:
    """The words a reader sees, a line for each block."""
    return reading(page)[0]


def written(fields: dict[str, str | None]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"


def derivatives(response_id: str, uri: str | None, date: str, source_headers: str | None, body: str | None) -> list[tuple]:
    """The FIELDS of the two records."""
    page = body or ""
    payload = digest(page.encode())
    clean_uri = None if uri is None else regex.sub(r"[\r\n]+", " ", uri)
    text, title, links = reading(page)
    about = {
        "title": title, "outlinks": str(links), "source-length": str(len(page.encode())), "source-payload-digest": payload,
        "text-length": str(len(text.encode()))}
    about |= {f"source-header-{k.strip().lower()}": v.strip()
              for k, _, v in (h.partition(":") for h in (source_headers or "").splitlines()) if v}
    notes = "".join(f"{k}: {regex.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in about.items() if v is not None)
    conversion = record_id("conversion", response_id, payload)
    out = []
    for kind, own, mime, block in (("conversion", conversion, "text/plain; charset=UTF-8", text),
                                   ("metadata", record_id("metadata", response_id, payload), "application/warc-fields", notes)):
        data = block.encode()
        linked = conversion if kind == "metadata" else None
        head = {"WARC-Type": kind, "WARC-Record-ID": own, "WARC-Date": date, "WARC-Target-URI": clean_uri,
                "WARC-Refers-To": response_id, "WARC-Concurrent-To": linked, "WARC-Block-Digest": digest(data),
                "Content-Type": mime, "Content-Length": str(len(data))}
        out.append((kind, own, response_id, linked, clean_uri, mime, len(data), digest(data), payload, written(head), block))
    return out


def responses(pages: DataFrame, id_col: str, url: Column, body: Column) -> DataFrame:
    """(source, response_id, uri, date, source_headers, body): pages as the response records they came in."""
    key = F.sha1(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(url, F.lit(""))).cast("binary"))
    dashed = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    length = F.coalesce(F.octet_length(body), F.lit(0))
    return pages.select(
        F.col(id_col).alias("source"), F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("response_id"), url.alias("uri"),
        F.lit(DATE).alias("date"), F.concat(F.lit("Content-Type: text/html\r\nContent-Length: "), length).alias("source_headers"),
        body.alias("body"))


def derived(records: DataFrame) -> DataFrame:
    """``source`` and FIELDS, two rows for each response record."""
    names, kinds = zip(*(f.split() for f in FIELDS.split(", ")))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 500):
                part = batch.slice(k, 500)
                rows = [r for values in zip(*(part.column(c).to_pylist() for c in range(1, 6))) for r in derivatives(*values)]
                at = pa.array([i // 2 for i in range(len(rows))], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), *(pa.array(c, KIND[t]) for c, t in zip(zip(*rows), kinds))], names=["source", *names])

    kind = records.schema["source"].dataType.simpleString()
    return records.select("source", "response_id", "uri", "date", "source_headers", "body").mapInArrow(of, f"source {kind}, {FIELDS}")
