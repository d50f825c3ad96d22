"""WARC derivative builder: a metadata and a plain-text conversion record for each response record.

A response (id, target URI, HTTP headers, payload) gives two linked records. Both refer to the response by its record
id, carry its target URI, its date and its payload digest; the metadata record also keeps the source's HTTP headers and
names the conversion, which is concurrent to it. Ids are name-based UUIDs of the response's id, so reruns agree. Block
digests are SHA-1 in base 32 over the block's bytes, and lengths are bytes.

Scale: one pass over the responses, no shuffle, whole payloads; a record is finished before the next one starts.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import map_texts

SCHEMA = "source_id string, warc_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, content_length long, block string, record binary"
_SPACE = " \t\n\r\f"
#: One piece of markup at a "<": a comment, an end tag, a start tag with its attributes, a declaration. All quantifiers
#: are possessive or run to one fixed mark, so a failed match costs one pass; it ends the scan.
_PIECE = re.compile(
    rf"""<(?:!--(?P<comment>[\s\S]*?)(?:--!?>|\Z)
      |/(?P<end>[a-zA-Z][^{_SPACE}/>]*+)[^>]*+>
      |(?P<start>[a-zA-Z][^{_SPACE}/>]*+)(?P<attrs>(?:[^>=]++|=[{_SPACE}]*+(?:"[^"]*+"|'[^']*+'|[^{_SPACE}>"'][^{_SPACE}>]*+)?+)*+)>
      |[!?/][^>]*+>)""",
    re.X,
)
#: What may begin a piece of markup; any other "<" is text.
_BEGIN = re.compile(r"<[a-zA-Z!?/]")
_ATTR = re.compile(rf"""([^{_SPACE}/>=][^{_SPACE}/>=]*+)(?:[{_SPACE}]*+=[{_SPACE}]*+(?:"([^"]*+)"|'([^']*+)'|([^{_SPACE}>]*+)))?+""")
_LANG = re.compile(r"[A-Za-z0-9-]+")
#: Elements whose content is no markup, up to their end tag; and those whose content isn't text of the page.
RAW = {name: re.compile(rf"</{name}(?=[{_SPACE}/>])", re.I) for name in ("script", "style", "title", "textarea", "xmp", "iframe")}
HIDDEN = frozenset("head noscript template".split())
#: Elements that end a line of text.
BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())


def attribute(attrs: str, name: str) -> str | None:
    """Value of a tag's attribute, the first of that name; empty where it has none, None where it isn't there."""
    for m in _ATTR.finditer(attrs):
        if m[1].lower() == name:
            return html.unescape(next((x for x in (m[2], m[3], m[4]) if x is not None), ""))
    return None


@dataclass
class Page:
    """What one pass over a payload finds. text: a line for each block, inner white space as one space, no empty lines."""

    text: str
    title: str | None
    language: str | None
    links: list[str]


def scan(payload: str) -> Page:
    """One linear pass over an HTML payload.

    Comments, declarations, scripts, styles, frames, templates and the head are no text; a title and the targets of links
    are noted wherever they stand as markup, the language at the first html tag. A "<" that no letter, "/", "!" or "?"
    follows is text. Markup that never ends takes the rest of the payload, as in browsers; so does an element without
    its end tag whose content is no markup. A head also ends where the body begins.
    """
    out: list[str] = []
    links: list[str] = []
    title = language = hidden = None
    at = 0
    while True:
        m = _BEGIN.search(payload, at)
        if hidden is None:
            out.append(_flat(payload[at : m.start() if m else len(payload)]))
        if m is None or (piece := _PIECE.match(payload, m.start())) is None:
            break
        at = piece.end()
        if (name := piece["end"]) is not None:
            name = name.lower()
            if name == hidden:
                hidden = None
            elif hidden is None and name in BLOCKS:
                out.append("\n")
        elif (name := piece["start"]) is not None:
            name = name.lower()
            if hidden == "head" and name == "body":
                hidden = None
            if name == "a" and (target := attribute(piece["attrs"], "href")) is not None:
                links.append(target)
            elif name == "html" and language is None:
                said = _LANG.match((attribute(piece["attrs"], "lang") or "").strip())
                language = said[0].lower() if said else None
            elif name in RAW:
                end = RAW[name].search(payload, at)
                content = payload[at : end.start() if end else len(payload)]
                if name == "title" and title is None and end:
                    title = " ".join(html.unescape(content).split())
                elif name == "textarea" and hidden is None:
                    out.append(_flat(content))
                at = end.start() if end else len(payload)
            elif hidden is None and name in HIDDEN:
                hidden = name
            if hidden is None and (name in BLOCKS or name in RAW):
                out.append("\n")
    return Page("\n".join(x for line in "".join(out).split("\n") if (x := " ".join(line.split()))), title, language, links)


def _flat(piece: str) -> str:
    return (html.unescape(piece) if "&" in piece else piece).replace("\n", " ").replace("\r", " ")


def plain_text(payload: str) -> str:
    return scan(payload).text


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def serialize(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC/1.0 record; headers without a value are left out."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return b"WARC/1.0\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one serialized record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.0":
        raise ValueError("not a WARC/1.0 record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def derive(source_id: str | None, uri: str | None, date: str, http: str | None, payload: str | None) -> list[tuple]:
    """The metadata and the conversion record of one response, as rows of SCHEMA.

    A null payload is an empty one, a null URI or header is left out of the records. A response without an id is named
    by URI and payload digest. White space in id and URI is escaped.
    """
    body = (payload or "").encode("utf-8", "surrogatepass")
    source_digest = digest(body)
    # header lines stay lines
    uri, source_id = (None if x is None else re.sub(r"\s+", "%20", x.strip()) for x in (uri, source_id))
    refers = source_id or record_id("response", uri or "", source_digest)
    meta_id, text_id = record_id("metadata", refers), record_id("conversion", refers)
    page = scan(payload or "")
    text = page.text
    fields = {
        "source-http-headers": [x for x in (http or "").split("\r\n") if x],
        "title": page.title,
        "language": page.language,
        "outlinks": page.links,
        "payload-bytes": len(body), "text-bytes": len(text.encode("utf-8", "surrogatepass")), "conversion": text_id,
    }
    out = []
    for kind, own, other, content, block in (("metadata", meta_id, text_id, "application/json", json.dumps(fields, ensure_ascii=False, sort_keys=True)), ("conversion", text_id, meta_id, "text/plain; charset=utf-8", text)):
        data = block.encode("utf-8", "surrogatepass")
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", refers), ("WARC-Concurrent-To", other), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Source-Payload-Digest", source_digest), ("WARC-Block-Digest", digest(data)), ("Content-Type", content), ("Content-Length", str(len(data)))]
        out.append((source_id, kind, own, refers, uri, source_digest, headers[7][1], len(data), block, serialize(headers, data)))
    return out


def derivatives(responses: DataFrame, source_id: Column, uri: Column, payload: Column, http: Column | None = None, date: str = "1970-01-01T00:00:00Z", keep: list[str] = ()) -> DataFrame:
    """Two rows of SCHEMA for each response, after the columns named in `keep`.

    Repeated responses repeat their records, ids included; an empty table gives none.
    """
    kept = [responses.schema[c] for c in keep]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), SCHEMA])

    def work(cols):
        rows = []
        for i, (sid, u, h, p) in enumerate(zip(*cols[len(kept) :])):
            rows += [(*(c[i] for c in cols[: len(kept)]), *r) for r in derive(sid, u, date, h, p)]
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(len(kept) + 10)]

    slim = responses.select(*keep, source_id.cast("string"), uri.cast("string"), (F.lit(None) if http is None else http).cast("string"), payload.cast("string"))
    return map_texts(slim, ddl, work)
