"""HTML pages as a flat list of pieces: title text, other text, links, tags."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip_text

# Character references decoded in the JVM. Pages with others go
# to the library parser. The ampersand must come last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&middot;": "·",
    "&amp;": "&",
}

_COMMENT = r"<!--.*?--\s*>"
_SCRIPT = r"<script(?:\s[^<>]*)?>.*?</\s*script\s*>"
_STYLE = r"<style(?:\s[^<>]*)?>.*?</\s*style\s*>"
_TITLE = r"<title(?:\s[^<>]*)?>[^<]*</title\s*>"
_TOKEN = rf"(?is){_COMMENT}|{_SCRIPT}|{_STYLE}|{_TITLE}|</?[a-z][^<>]*>|<!doctype[^<>]*>|[^<]+"
_OPEN_TAG = (
    r"(?is)^<[a-z][a-z0-9]*(?:\s+[a-z][a-z0-9_-]*(?:=(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'=<>`/]+))?)*\s*/?>$"
)
_CLOSE_TAG = r"(?is)^</[a-z][a-z0-9]*\s*>$"
_LONGEST_TAG = 2000
_RAW = r"(?is)^<(?:script|style)"
_HREF = r"(?is)\shref=(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"

PIECE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
)


def unescape(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def page_tokens(html: Column) -> Column:
    """Markup cut into comments, raw blocks, titles, tags and runs of text."""
    return F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))


def is_plain(html: Column, tokens: Column) -> Column:
    """True when the token list is certain to be what the HTML parser would see.

    Nothing may be left between tokens, every tag must be well formed, and every
    character reference must be one of ENTITIES.
    """
    known = "|".join(e[1:] for e in ENTITIES)

    def plain(token: Column) -> Column:
        raw_ok = ~token.rlike(r"(?is)^<[^<>]*/>") & token.rlike(r"(?is)^<[^<>]*>.*</")
        tag_ok = (
            (F.length(token) <= _LONGEST_TAG)
            & (token.rlike(_OPEN_TAG) | token.rlike(_CLOSE_TAG))
        )
        return (
            F.when(token.startswith("<!"), F.lit(True))
            .when(token.rlike(_RAW), raw_ok)
            .when(
                token.rlike(r"(?is)^<title\b"),
                token.rlike(rf"(?is)^{_TITLE}$") & _entities_known(token, known),
            )
            .when(token.startswith("<"), tag_ok & _entities_known(token, known))
            .otherwise(_entities_known(token, known))
        )

    whole = F.length(F.array_join(tokens, "")) == F.length(html)
    tail = F.try_element_at(tokens, F.lit(-1))
    return F.coalesce(
        whole & F.forall(tokens, plain) & (tail.startswith("<") | ~F.contains(tail, F.lit("&"))),
        F.lit(False),
    )


def _entities_known(token: Column, known: str) -> Column:
    return ~F.contains(token, F.lit("&")) | ~token.rlike(rf"&(?!(?:{known}))(?=[A-Za-z#])")


def _hrefs(tag: Column) -> Column:
    """The last ``href`` of an ``<a>`` tag."""
    found = F.regexp_extract_all(tag, F.lit(_HREF), F.lit(0))
    last = F.try_element_at(found, F.lit(-1))
    return unescape(F.regexp_replace(last, r"(?is)^\shref=[\"']?|[\"']$", ""))


def token_pieces(tokens: Column) -> Column:
    """Pieces of a plain page, in page order, values untrimmed.

    Kinds: ``title``, ``text`` and ``link``, and ``body`` as a mark.
    """

    def piece(kind: str, value: Column | str = "") -> Column:
        shown = F.lit(value) if isinstance(value, str) else value
        return F.struct(F.lit(kind).alias("kind"), shown.alias("value"))

    def classify(token: Column) -> Column:
        inner = F.regexp_replace(token, r"(?is)^<[^<>]*>|</[^<>]*>$", "")
        return (
            F.when(token.startswith("<!"), piece("none"))
            .when(token.rlike(_RAW), piece("text", inner))
            .when(token.rlike(r"(?is)^<title\b"), piece("title", unescape(inner)))
            .when(token.rlike(r"(?is)^<a[\s/>]"), piece("link", F.coalesce(_hrefs(token), F.lit(""))))
            .when(token.rlike(r"(?is)^<body[\s/>]"), piece("body"))
            .when(token.startswith("<"), piece("none"))
            .otherwise(piece("text", unescape(token)))
        )

    useful = F.filter(
        F.transform(tokens, classify),
        lambda p: (p["value"] != "") | (p["kind"] == "body"),
    )
    return useful


class _Pieces(HTMLParser):
    """Collects (kind, value) pieces of one page from the library parser."""

    def __init__(self):
        super().__init__()
        self.found = []
        self.kind = "text"

    def handle_starttag(self, tag, attrs):
        if tag == "title":
            self.kind = "title"
        elif tag == "body":
            self.found.append(("body", ""))
        elif tag == "a":
            self.found += [("link", value) for name, value in attrs if name == "href" and value][-1:]

    def handle_endtag(self, tag):
        if tag == "title":
            self.kind = "text"

    def handle_data(self, data):
        self.found.append((self.kind, data))


def _parse(html: str) -> list[dict]:
    page = _Pieces()
    page.feed(html)
    return [{"kind": kind, "value": value} for kind, value in page.found]


def parsed_pieces(html: Column) -> Column:
    """Pieces by the library parser, for pages that are not plain; null for null."""

    @F.pandas_udf(PIECE)
    def pieces(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else _parse(p) for p in pages], dtype=object)

    return pieces(html)


def chunks(pieces: Column, *kinds: str) -> Column:
    """Trimmed, non-blank values of the given kinds."""
    picked = F.filter(pieces, lambda p: p["kind"].isin(*kinds))
    return F.filter(F.transform(picked, lambda p: strip_text(p["value"])), lambda v: v != "")


def links(pieces: Column) -> Column:
    picked = F.filter(pieces, lambda p: (p["kind"] == "link") & (p["value"] != ""))
    return F.transform(picked, lambda p: p["value"])


def first_title(pieces: Column) -> Column:
    titles = F.filter(pieces, lambda p: p["kind"] == "title")
    return F.coalesce(strip_text(F.try_element_at(titles, F.lit(1))["value"]), F.lit(""))


def body_text(pieces: Column) -> Column:
    """Text nodes after ``<body>``, untrimmed, joined by a space, then trimmed."""
    start = F.array_position(F.transform(pieces, lambda p: p["kind"]), "body")
    inside = F.slice(pieces, (start + 1).cast("int"), F.size(pieces))
    nodes = F.filter(inside, lambda p: p["kind"].isin("text", "title"))
    joined = F.array_join(F.transform(nodes, lambda p: p["value"]), " ")
    return F.when(start > 0, strip_text(joined)).otherwise(F.lit(""))
