"""Derived records of web captures: a metadata and a plain-text conversion record for every response record.

Both name the response they come from (WARC-Refers-To, with its target and date), keep its target, date and payload digest,
and carry a digest of their own block.
The metadata record holds, as JSON, the source's WARC and HTTP headers and digests, the page's title, language and meta
entries, and its links made absolute. The conversion record holds the text a reader sees, a line per block.

Records are derived row by row; nothing is shuffled.
"""

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthmill.llm.texts import blocks, encoded

_DROPPED = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg)\b.*?(?:</\1\s*>|$)|<head\b.*?(?:</head\s*>|(?=<body\b)|$)", re.I | re.S)
_SILENT = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg)\b.*?(?:</\1\s*>|$)", re.I | re.S)
_BREAKS = re.compile(r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_HTML = re.compile(r"<html\b([^>]*)>", re.I)
_LANG = re.compile(r"\blang\s*+=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<(a|area|img|link|iframe|script)\b([^>]*)>", re.I)
_META = re.compile(r"<meta\b([^>]*)>", re.I)
_ATTRIBUTE = re.compile(r"(?<![\w:.-])([a-zA-Z_:][\w:.-]*+)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

FIELDS = "record_id string, warc_type string, refers_to string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_digest string, header string, block string"


def digest(block: bytes) -> str:
    """A labelled digest as WARC writes it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def attributes(tag: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        out.setdefault(m[1].lower(), html.unescape(next((x for x in m.groups()[1:] if x is not None), "")))
    return out


def closed(page: str) -> str:
    """A page up to its last `>`. Beyond it no tag ends, and looking for an end there at every `<` would take quadratic time."""
    return page[: page.rfind(">") + 1]


def without(pattern: re.Pattern, by: str, text: str) -> str:
    tags = closed(text)
    return pattern.sub(by, tags) + text[len(tags) :]


def plain_text(page: str) -> str:
    """What a reader sees: a line per block, blanks squeezed."""
    text = without(_BREAKS, "\n", _DROPPED.sub(" ", page).replace("\n", " "))
    text = html.unescape(without(_TAG, "", text))
    lines = (_BLANKS.sub(" ", x).strip() for x in text.split("\n"))
    return "\n".join(x for x in lines if x)


def page_facts(page: str, base: str) -> dict:
    """Title, language, meta entries and links of a page."""
    seen = _SILENT.sub(lambda m: m[0][: m[0].find(">") + 1] if not m[0].startswith("<!--") else " ", page)
    seen = closed(seen)
    title, end = _TITLE.search(seen), None
    if title:
        end = _TITLE_END.search(seen, title.end())
    lang = next((found for m in _HTML.finditer(seen) if (found := _LANG.search(m[1]))), None)
    metas = [{k: v for k, v in attributes(m[1]).items() if k in ("name", "property", "charset", "content", "http-equiv")} for m in _META.finditer(seen)]
    links = []
    for m in _LINK.finditer(seen):
        own = attributes(m[2])
        kind = "href" if m[1].lower() in ("a", "area", "link") else "src"
        if target := own.get(kind):
            try:
                url = urljoin(base, target)
            except ValueError:  # not a URL at all: kept as it stands
                url = target
            links.append({"path": f"{m[1].lower()}@{kind}", "url": url})
    return {"title": " ".join(html.unescape(seen[title.end() : end.start()]).split()) if end else None, "lang": lang[1].lower() if lang else None, "metas": metas, "links": links}


def header(fields: list[tuple[str, str | None]]) -> str:
    """A record's header; fields without a value are left out."""
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"


def http_fields(head: str | None) -> list[list[str]]:
    """Name and value of each line of an HTTP head, after its status line."""
    return [[k.strip(), v.strip()] for k, _, v in (x.partition(":") for x in (head or "").splitlines()[1:]) if k.strip()]


def derive(record: dict, page: bytes) -> list[dict]:
    """The two derived records of a response record."""
    source, uri, date, head = (record[k] for k in ("record_id", "target_uri", "warc_date", "http_head"))
    text, source_digest = page.decode("utf-8", "replace"), digest(page)
    status = (head or "").splitlines()[:1]
    envelope = {
        "source": {"WARC-Type": "response", "WARC-Record-ID": source, "WARC-Target-URI": uri, "WARC-Date": date, "WARC-Payload-Digest": source_digest, "WARC-Block-Digest": digest((head or "").encode() + page)},
        "http": {"status": status[0] if status else None, "headers": http_fields(head)},
        "html": page_facts(text, uri or ""),
    }
    out = []
    for kind, media, block in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain; charset=utf-8", plain_text(text))):
        body = block.encode("utf-8", "replace")
        # A capture without an id is named by what is known of it.
        known = source if source is not None else json.dumps([uri, date, source_digest])
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{known}#{kind}')}>"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Payload-Digest", source_digest), ("WARC-Block-Digest", digest(body)), ("Content-Type", media), ("Content-Length", str(len(body)))]
        out.append({"record_id": name, "warc_type": kind, "refers_to": source, "target_uri": uri, "warc_date": date, "content_type": media, "content_length": len(body), "block_digest": digest(body), "source_digest": source_digest, "header": header(fields), "block": body.decode()})
    return out


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "payload"):
        records = batch.select(["record_id", "target_uri", "warc_date", "http_head"]).to_pylist()
        rows, owner = [], []
        for i, (record, page) in enumerate(zip(records, encoded(batch.column("payload")), strict=True)):
            found = derive(record, page)
            rows += found
            owner += [i] * len(found)
        made = pa.Table.from_pylist(rows, _SCHEMA).combine_chunks()
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(owner, pa.int64())), *(c.combine_chunks() for c in made.columns)], names=["row", *_SCHEMA.names])


_SCHEMA = pa.schema([(k, pa.int64() if kind == "long" else pa.string()) for k, kind in (f.strip().split(" ") for f in FIELDS.split(","))])


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows (FIELDS) for every response: its metadata and its conversion record.

    `responses` has record_id, target_uri, warc_date, http_head and payload (text or UTF-8 bytes). A null payload is an
    empty page; null headers are left out of the records; the records of a response without an id are named by its target,
    date and payload. Long pages, and tags that never end, take time in proportion to the page. Equal responses give equal records, as often as they stand. An
    empty table gives none. Other columns pass through in front; where names clash, the derived record's column stays.
    """
    taken = {"record_id", "target_uri", "warc_date", "http_head", "payload", *_SCHEMA.names}
    rest = [c for c in responses.columns if c not in taken]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    text = [F.col(c).cast("string").alias(c) for c in ("record_id", "target_uri", "warc_date", "http_head")]
    source = responses.select(row.alias("row"), *text, F.col("payload").cast("binary").alias("payload"))
    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(_derive, f"row {kind}, {FIELDS}")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *_SCHEMA.names)


def responses_of(pages: DataFrame, date: str) -> DataFrame:
    """Response records of plain (page_id, url, html) rows, captured at `date`. The id follows from page id and address."""
    seed = F.md5(F.concat_ws("\x00", F.col("page_id").cast("string"), "url"))
    part = lambda a, n: F.substring(seed, a, n)
    name: Column = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    return pages.select("page_id", name.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), head.alias("http_head"), F.col("html").alias("payload"))
