"""Main text of web pages by a site style tree.

1. Every page becomes a tree of block elements and text blocks, in one linear pass over
   its markup. Elements that say what they are (menus, footers, forms, adverts, comment
   sections, ... by tag, role, class or id) are left out with all they hold.
2. The trees of a host are merged: elements with the same path of presentations (tag,
   class, id; digits masked) are one node of the site tree. A node counts its pages and,
   by page, its presentation style (the sequence of its children, runs folded) or, for a
   text block, its content. Pages of a host with the same text count once, so copies of an
   article do not make it look like a part of the site.
3. Importance. Of an element: the entropy of its styles, to the base of its number m of
   pages (1 if it has fewer than MIN_PAGES). Of a block: 1 less the entropy of its content,
   log k / log m for content that k of m pages have. The composite importance of an element
   on a page is (1 - GAMMA**l) times its own plus GAMMA**l times the mean of its children's,
   for l styles; elements that cannot go as a branch (the page, its body and article, and the
   paragraphs of an article) have the mean of their children's. Outside the article, blocks count by their share of text that is no link.
4. A branch (an element other than the page's body and article) of a composite importance
   below NOISE is removed, and outside an article every such block too. An article or main
   element, where the page has one, bounds the text; its own blocks stay.

Site-tree rows are narrow (hashes); they are counted by Spark, in two steps where a node
is common. No host's tree meets in one task: a host may hold a third of all pages.

Defined results: null or empty html gives an empty text; pages without a host are hosts of
their own; rows with equal ids or URLs are pages of their own; text that is not closed,
nested wrongly or truncated is read to the end; white space is what Python's split takes.
"""

from __future__ import annotations

import html as markup
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Staging, keyed
from quern.operators.skew import join_groups

GAMMA = 0.9
NOISE = 0.3
# Nodes on fewer pages of a host say nothing about what repeats there.
MIN_PAGES = 4

# Elements that end a text block. Others (b, a, span, br, ...) stand inside blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
# Elements that are branches in the main part; others there (paragraphs, headings, items) are text.
BRANCHES = frozenset("details dir div dl fieldset figure ol section table ul".split())
# Elements whose content is no part of an article.
NOISE_TAGS = frozenset("aside audio button canvas datalist dialog footer form head iframe map menu nav noscript object search select svg template video".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
# Words of a class or id that name such content.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert alerts banner banners breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer discussion disqus footer footnav gdpr login masthead menu menus modal nav navbar navigation newsletter "
    "notice notices notification notifications pager pagination paywall popup popups promo promos promotion recommendations recommended related "
    "replies respond share sharing shares sidebar sidebars signup skiplink skip social sponsor sponsored subscribe subscription adsbygoogle tagcloud toolbar "
    "topbar widget widgets".split()
)
# Names that stand for other people's articles: what they hold is never the page's main part.
FOREIGN_NAMES = frozenset("comment comments commentlist discussion disqus recommendations recommended related replies respond".split())
# Classes and ids of a page's header.
PAGE_HEADERS = frozenset(["header", "page-header", "site-header", "siteheader", "top-bar"])
MAIN_TAGS = frozenset(["article", "main"])
_FORM_PARTS = frozenset(["fieldset", "legend", "optgroup", "option"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that end an open element of the named kinds, up to a border.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
_IN_HEAD = frozenset(["head", "noscript", "template"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(script|style|textarea|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'){0,400}+)>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


_CUT_TAG = re.compile(r"<[a-z!?/]", re.I)


def _unclosed(token: re.Match) -> bool:
    """Whether a comment or an element of raw text goes on to the end of the page."""
    whole = token[0]
    if token[1]:
        return not re.search(rf"</{token[1]}\b[^>]*>\Z", whole, re.I)
    return whole.startswith("<!--") and not whole.endswith(("-->", "--!>", "<!-->", "<!--->"))


class _Node:
    __slots__ = ("tag", "parent", "look", "noise", "main", "top", "foreign", "children", "text", "linked", "index")

    def __init__(self, tag, parent, look, noise=False, main=False, top=False, foreign=False):
        self.tag, self.parent, self.look, self.noise, self.main, self.top, self.foreign = tag, parent, look, noise, main, top, foreign
        self.children: list[_Node] = []
        self.text: str | None = None
        self.linked = 0


_looks: dict[tuple[str, str], tuple[str, bool, bool, bool, bool]] = {}


def _look(tag: str, raw: str) -> tuple[str, bool, bool, bool, bool]:
    """Of a start tag: presentation, whether it names noise, whether it is a main part, whether
    it is a page's header, and whether a main part in it is none of the page's."""
    known = _looks.get((tag, raw))
    if known is None:
        found: dict[str, str] = {}
        for name, value in _ATTRIBUTE.findall(raw) if raw else ():
            found.setdefault(name.lower(), markup.unescape(value.strip("\"'")))
        names = found.get("class", "") + " " + found.get("id", "")
        words = {w.lower() for w in _WORDS.findall(names)}
        role = found.get("role", "").strip().lower()
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", ""), re.I))
        noise = tag in NOISE_TAGS or tag in _FORM_PARTS or role in NOISE_ROLES or hidden or bool(words & NOISE_NAMES)
        main = (tag in MAIN_TAGS or role == "main") and not (words & NOISE_NAMES) and not hidden
        look = _DIGITS.sub("0", f"{tag}.{' '.join(sorted(names.split()))}")
        if tag in ("html", "body"):
            noise = main = False
        foreign = noise and tag not in MAIN_TAGS and bool(words & FOREIGN_NAMES)
        top = tag == "header" or any(w.lower() in PAGE_HEADERS for w in names.split())
        known = (look, noise and not main, main, top, foreign or tag in NOISE_TAGS)
        if len(_looks) < 100_000 and len(raw) < 200:
            _looks[(tag, raw)] = known
    return known


def parse(page: str) -> _Node:
    """The tree of block elements and text blocks of a page."""
    root = node = _Node("#root", None, "")
    opened: dict[str, int] = {}
    pieces: list[str] = []
    links, linked = 0, 0
    # The inline element whose text is being left out, the element it stands in, and how deep it is nested.
    muted, depth = None, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                leaf = _Node("#text", node, "#text")
                leaf.text, leaf.linked = text, linked
                node.children.append(leaf)
        linked = 0

    def close(upto: _Node) -> None:
        """Leaves ``upto`` and all elements within it."""
        nonlocal node, muted
        while True:
            opened[node.tag] -= 1
            left, node = node, node.parent
            if muted and muted[1] is left:
                muted = None
            if left is upto:
                return

    def nearest(tags, borders) -> _Node | None:
        if not any(opened.get(t) for t in tags):
            return None
        at = node
        while at is not root and at.tag not in borders:
            if at.tag in tags:
                return at
            at = at.parent
        return None

    end, token = 0, None
    # No tag ends behind the last ">", so a search there would only scan to the end again and again.
    border = page.rfind(">") + 1
    for token in _TOKEN.finditer(page, 0, border):
        begin = token.start()
        if begin > end and not muted:
            text = page[end:begin]
            pieces.append(markup.unescape(text) if "&" in text else text)
            if links:
                linked += len(text)
        end = token.end()
        ends, tag, attributes = (token[2], token[3], token[4]) if token[3] else (token[5], token[6], token[7])
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            links = 0 if ends else 1
        elif tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
        elif tag in BLOCKS or tag in NOISE_TAGS:
            flush()
            if ends:
                found = nearest((tag,), ()) if tag not in _HEADINGS else nearest(_HEADINGS, ())
                if found is not None:
                    close(found)
                continue
            if tag in BLOCKS and (found := nearest(("p",), ("button", "td", "th", "li", "table"))) is not None:
                close(found)
            if opened.get("head") and tag not in _IN_HEAD:
                close(nearest(("head",), ()))
            rule = _CLOSES.get(tag)
            while rule and (found := nearest(*rule)) is not None:
                close(found)
            if tag == "hr":
                continue
            child = _Node(tag, node, *_look(tag, attributes))
            node.children.append(child)
            if tag not in VOID and not attributes.endswith("/") or tag in BLOCKS:
                node = child
                opened[tag] = opened.get(tag, 0) + 1
        elif muted and tag == muted[0]:
            depth += -1 if ends else 1
            muted = muted if depth else None
        elif not muted and attributes and not ends and tag not in VOID and _look(tag, attributes)[1]:
            # An inline element that names noise is left out of its block.
            muted, depth = (tag, node), 1
    if not muted and not (token and end == border and _unclosed(token)):
        cut = _CUT_TAG.search(page, border)
        text = page[end : cut.start() if cut else len(page)]
        pieces.append(markup.unescape(text) if "&" in text else text)
    flush()
    return root


def _walk(root: _Node) -> list[_Node]:
    """All nodes, parents first, in page order."""
    out, waiting = [], [root]
    while waiting:
        at = waiting.pop()
        out.append(at)
        waiting.extend(reversed(at.children))
    return out


def clean_tree(root: _Node) -> tuple[list[_Node], list[bool]]:
    """(nodes left, whether each is inside the main part), parents first.

    A branch that names noise goes, unless it holds the page's main part. Where there is a
    main part, text outside of it goes. A header outside the main part goes.
    """
    every = _walk(root)
    holds = {id(n): n.main for n in every}
    for n in reversed(every):
        if n.parent is not None and holds[id(n)] and not n.foreign:
            holds[id(n.parent)] = True
    any_main = holds[id(root)]
    out, inside, waiting = [], [], [(root, False)]
    while waiting:
        at, within = waiting.pop()
        within = within or at.main
        if at is not root:
            if (at.noise and (within or at.foreign or not holds[id(at)])) or (at.top and not within and not holds[id(at)]):
                continue
            if any_main and not within and not holds[id(at)]:
                continue
        out.append(at)
        inside.append(within)
        waiting.extend((c, within) for c in reversed(at.children))
    return out, inside


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=seed)


def _tree(page: str, host: str):
    """Columns of one page: parents, kinds, link shares, site nodes and items by node, and the texts.

    ``kind``: 0 an element that may go as a branch, 1 the page, its body or main part, what holds it, or
    an element of text in the main part, 2 a block of the main part, 3 another block.
    """
    nodes, inside = clean_tree(parse(page))
    for i, n in enumerate(nodes):
        n.index = i
    left = [[] for _ in nodes]
    for i, n in enumerate(nodes[1:], 1):
        left[n.parent.index].append(i)
    holds = [n.main for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        if holds[i]:
            holds[nodes[i].parent.index] = True
    paths, parents, kinds, shares, places, items, texts = [0] * len(nodes), [], [], [], [], [], []
    at_host = _hash(host)
    for i, n in enumerate(nodes):
        parents.append(n.parent.index if i else -1)
        paths[i] = _hash(n.look, paths[parents[i]] if i else at_host)
        if n.text is None:
            kinds.append(1 if i == 0 or holds[i] or n.tag in ("html", "body") or (inside[i] and n.tag not in BRANCHES) else 0)
            shares.append(0.0)
            style, last = [], None
            for c in left[i]:
                if nodes[c].look != last:
                    last = nodes[c].look
                    style.append(last)
            item = _hash(">".join(style), paths[i])
        else:
            kinds.append(2 if inside[i] else 3)
            shares.append(min(n.linked / max(len(n.text), 1), 1.0))
            texts.append(n.text)
            item = _hash(_DIGITS.sub("0", n.text), paths[i])
        places.append(paths[i])
        items.append(item)
    return parents, kinds, shares, places, items, texts


_PAGE = "key long, row {row}, copy long, kinds array<byte>, places array<long>, items array<long>, firsts array<boolean>, body binary"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _packed(parents: list[int], kinds: list[int], shares: list[float], texts: str) -> bytes:
    """What the last step needs of a page, compressed: it is moved once."""
    shape = np.array([len(parents), *parents], np.int32).tobytes() + np.array(kinds, np.int8).tobytes() + np.array(shares, np.float32).tobytes()
    return zlib.compress(shape + texts.encode("utf-8", "surrogatepass"), 6)


def _unpacked(body: bytes) -> tuple[list[int], list[int], list[float], list[str]]:
    raw = zlib.decompress(body)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    parents = np.frombuffer(raw, np.int32, n, 4).tolist()
    kinds = np.frombuffer(raw, np.int8, n, 4 + 4 * n).tolist()
    shares = np.frombuffer(raw, np.uint8, 4 * n, 4 + 5 * n).view(np.float32).tolist()
    return parents, kinds, shares, raw[4 + 9 * n :].decode("utf-8", "surrogatepass").split("\n")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            rows = []
            part = batch.slice(first, 256)
            for key, host, page in zip(*(c.to_pylist() for c in part.columns[:3])):
                parents, kinds, shares, places, items, texts = _tree(page, host or f"#{key}")
                whole = "\n".join(texts)
                seen: set[int] = set()
                firsts = []
                for place in places:
                    firsts.append(place not in seen)
                    seen.add(place)
                rows.append(
                    (
                        key, _signed(_hash(whole)), kinds, list(map(_signed, places)), list(map(_signed, items)), firsts,
                        _packed(parents, kinds, shares, whole),
                    )
                )
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), *map(pa.list_, (pa.int8(), pa.int64(), pa.int64(), pa.bool_())), pa.binary()]
            names = ["key", "row", "copy", "kinds", "places", "items", "firsts", "body"]
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([arrays[0], part.column(3), *arrays[1:]], names=names)


def kept_blocks(parents, kinds, shares, found: dict[int, tuple[float, int]]) -> list[bool]:
    """Which blocks of a page stay, in page order. ``found``: importance and number of styles by node, where not (1, 1)."""
    n = len(parents)
    total, members = [0.0] * n, [0] * n
    composite = [1.0] * n
    for i in range(n - 1, -1, -1):
        own, styles = found.get(i, (1.0, 1))
        if kinds[i] >= 2:
            composite[i] = own * (1 - shares[i]) if kinds[i] == 3 else own
        elif members[i] and kinds[i] == 1:
            composite[i] = total[i] / members[i]
        elif members[i]:
            weight = GAMMA**styles
            composite[i] = (1 - weight) * own + weight * total[i] / members[i]
        if parents[i] >= 0:
            total[parents[i]] += composite[i]
            members[parents[i]] += 1
    gone, kept = [False] * n, []
    for i in range(n):
        above = parents[i] >= 0 and gone[parents[i]]
        gone[i] = above or (kinds[i] in (0, 3) and composite[i] < NOISE)
        if kinds[i] >= 2:
            kept.append(not gone[i])
    return kept


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for body, found in zip(batch.column("body").to_pylist(), batch.column("found").to_pylist()):
            parents, kinds, shares, blocks = _unpacked(body)
            kept = kept_blocks(parents, kinds, shares, {r["i"]: (r["importance"], r["styles"]) for r in found or ()})
            out.append("\n\n".join(b for b, k in zip(blocks, kept) if k))
        counts = pa.array([len(t) for t in out], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), counts], names=["row", "text", "n_chars"])


def _importances(trees: DataFrame, staging: Staging) -> DataFrame:
    """(key, found): for every page the nodes whose importance is not 1, with that and their number of styles."""
    listed = F.arrays_zip("places", "items", "firsts", "kinds")
    nodes = trees.select("key", "copy", F.posexplode(listed).alias("i", "e")).select(
        "key", "copy", "i", F.col("e.places").alias("place"), F.col("e.items").alias("item"), F.col("e.firsts").alias("first"), "e.kinds"
    )
    nodes = nodes.where("kinds != 1").withColumn("block", F.col("kinds") >= 2)
    # Pages with the same text are one page of the site tree.
    once = nodes.groupBy("place", "item", "copy").agg(F.max(F.col("first").cast("long")).alias("first"), F.any_value("block").alias("block"))
    items = staging.write(once.groupBy("place", "item").agg(F.count(F.lit(1)).alias("k"), F.sum("first").alias("first"), F.any_value("block").alias("block")))
    # By node: pages, styles, and what their entropy is made of.
    logs = F.sum(F.col("k") * F.log(F.col("k").cast("double")))
    places = items.groupBy("place").agg(
        F.sum("first").alias("m"), F.count(F.lit(1)).alias("styles"), F.sum("k").alias("all"), logs.alias("logs"), F.any_value("block").alias("block")
    )
    places = staging.write(places.where(F.col("m") >= MIN_PAGES))
    entropy = (F.log(F.col("all").cast("double")) - F.col("logs") / F.col("all")) / F.log(F.col("m").cast("double"))
    elements = places.where(~F.col("block")).select("place", F.least(F.lit(1.0), F.greatest(F.lit(0.0), entropy)).alias("importance"), "styles", F.col("all").alias("rows"))
    elements = staging.write(elements)
    common = items.where((F.col("k") > 1) & F.col("block")).select("place", "item", "k")
    sizes = places.where("block").select("place", "m", F.col("styles").alias("size"))
    share = F.greatest(F.lit(0.0), 1 - F.log(F.col("k").cast("double")) / F.log(F.col("m").cast("double")))
    blocks = join_groups(common, sizes, "place", "size").select("item", share.alias("importance"), F.lit(1).cast("long").alias("styles"), F.col("k").alias("rows"))
    blocks = staging.write(blocks)
    of_elements = join_groups(nodes.where(~F.col("block")).select("key", "i", "place"), elements, "place", "rows")
    of_blocks = join_groups(nodes.where("block").select("key", "i", "item"), blocks, "item", "rows")
    every = of_elements.select("key", "i", "importance", "styles").unionByName(of_blocks.select("key", "i", "importance", "styles"))
    return every.groupBy("key").agg(F.collect_list(F.struct("i", "importance", "styles")).alias("found"))


def host_of(url: Column) -> Column:
    """The host name of a URL: lower case, without user and port; empty where there is none."""
    place = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\\]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(place, F.lit("")), "^.*@", ""), r":\d*$", ""))


def extract_main(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``row`` (its other columns), ``text`` and ``n_chars`` (code points)."""
    staging = Staging(pages.sparkSession, "sitetree")
    source, _ = keyed(pages, id_col, "key", staging)
    others = [c for c in pages.columns if c != html_col]
    slim = F.struct(*[F.col("row").getField(c).alias(c) for c in others]) if others else F.struct(F.lit(0).alias("_"))
    page = F.coalesce(F.col("row").getField(html_col), F.lit(""))
    given = source.select("key", host_of(F.col("row").getField(url_col)).alias("host"), page.alias("html"), slim.alias("row"))
    kind = given.schema["row"].dataType.simpleString()
    trees = staging.write(given.mapInArrow(_trees, _PAGE.format(row=kind)))
    found = _importances(trees.select("key", "copy", "places", "items", "firsts", "kinds"), staging)
    joined = trees.select("key", "row", "body").join(found, "key", "left")
    return joined.mapInArrow(_texts, f"row {kind}, text string, n_chars long")
