"""Main text of pages: markup, roles, and what repeats on a host."""

import html
import random
import re

import pytest

from quern.llm import sitetree
from quern.llm.sitetree import _tree, extract_main, kept_blocks, parse

SCHEMA = "page_id long, url string, html string, text string, row string, n_chars string, key int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", 1) for i, u, h in rows], SCHEMA)


def run(spark, rows):
    found = extract_main(pages(spark, rows)).collect()
    assert all(r.row.text == "x" and r.row.key == 1 and r.n_chars == len(r.text) for r in found)
    return sorted(((r.row.page_id, r.text) for r in found), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def blocks(page):
    return _tree(page, "h")[-1]


def test_given_pages_give_their_articles(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.row.page_id: r.text for r in extract_main(given).collect()}
    for r in given.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
        assert found[r.page_id] == "\n\n".join(p for p in parts if p)


def test_markup():
    assert blocks("") == [] and blocks("plain  text") == ["plain text"]
    assert blocks("<p>a&amp;b &lt;i&gt;&nbsp;\n c<br>d<p>e<b>f<i>g</p>h") == ["a&b <i> c d", "efg", "h"]
    assert blocks("<title>T</title><style>p{}</style><script>'</p>'</script><p>x<!-- <p>c --> y") == ["x y"]
    assert blocks("<p>a<script>never closed <p>b") == ["a"]
    assert blocks("<div title='a > b' class=\"x\">in</div><p a='un>closed") == ["in", "closed"]
    assert blocks("<ul><li>1<li>2<ul><li>3</ul><li>4</ul><table><tr><td>5<td>6<tr><th>7</table>") == list("1234567")
    assert blocks("<head><title>T</title><p>no body tag") == ["no body tag"]
    assert blocks("<p>one <span class='ad'>AD <span>in</span></span>two <b id=share>x</p><p>three") == ["one two", "three"]
    assert blocks("a < b and <3 <p>c") == ["a < b and <3", "c"]


def test_noise_by_tag_role_and_name():
    body = (
        "<header><h1>Site</h1></header><nav>menu</nav><div class='side-bar sidebar'>side</div><div id='cookie-notice'>cookies</div>"
        "<div class=content><h1>Title</h1><p>Text</p><div class='share-buttons'>share</div><form><p>field</p></form><aside>more</aside>"
        "<p hidden>hidden</p><p style='display: none'>none</p></div><section id='reader-comments'><article>first!</article></section>"
        "<div role=contentinfo>foot</div><footer>foot</footer>"
    )
    assert blocks(f"<body>{body}</body>") == ["Title", "Text"]
    main = "<div class='no-sidebar'><p>outside</p><main><header><h1>T</h1></header><p>in</p><article class='comment'>c</article></main></div>"
    assert blocks(main) == ["T", "in"]
    assert blocks("<article><p>a</article><p>between</p><article><p>b</article><footer>f") == ["a", "b"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_what_repeats_on_a_host_goes(spark):
    rng = random.Random(1)
    rows, want = [], []
    for i in range(40):
        text = [words(rng, 12) for _ in range(1 + i % 5)]
        middle = "".join(f"<p>{t}</p>" for t in text)
        page = (
            f"<div class=a1><p>Welcome to the site</p><p>Call us: 555-{i}</p></div><div class=b>{middle}</div>"
            "<div class=c><p>All rights are ours</p></div><p>Copyright 2024</p>"
        )
        rows.append((i, f"https://Site.example:8080/{i}", page))
        want.append((i, "\n\n".join(text)))
    # The same page on other hosts is all there is to know there.
    lone = rows[0][2]
    full = "\n\n".join(blocks(lone))
    others = [(100 + i, f"http://h{i}.example/", lone) for i in range(3)]
    assert run(spark, rows + others) == want + [(i, full) for i, _, _ in others]


def test_articles_keep_their_common_lines_and_copies_stay(spark):
    rng = random.Random(2)
    rows, want = [], []
    for i in range(30):
        text = [words(rng, 10), "A line of every article"]
        rows.append((i, "http://a.example/x", f"<nav>n</nav><article>{''.join(f'<p>{t}</p>' for t in text)}<div class=box><p>Read our letters</p></div></article>"))
        want.append((i, "\n\n".join(text)))
    copy = "<div class=z><p>" + words(rng, 20) + "</p></div>"
    copies = [(100 + i, "http://b.example/x", copy) for i in range(50)]
    rest = [(200 + i, "http://b.example/y", f"<div class=z><p>{words(rng, 20)}</p></div>") for i in range(10)]
    want += [(i, blocks(h)[0]) for i, _, h in copies + rest]
    assert run(spark, rows + copies + rest) == want


def test_lists_of_links_outside_an_article_go(spark):
    page = "<div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><p>Text with <a href=3>a link</a> and much more of it.</p></div>"
    assert run(spark, [(1, "http://l.example", page)]) == [(1, "Text with a link and much more of it.")]


def test_branches_by_composite_importance():
    # 0 root, 1 branch with two blocks, 2 and 3 its blocks, 4 a block of its own
    parents, kinds, shares = [-1, 0, 1, 1, 0], [1, 0, 3, 3, 3], [0.0] * 5
    assert kept_blocks(parents, kinds, shares, {}) == [True] * 3
    assert kept_blocks(parents, kinds, shares, {1: (0.0, 1), 2: (0.0, 1), 3: (0.31, 1)}) == [False, False, True]
    assert kept_blocks(parents, kinds, shares, {1: (0.9, 30), 2: (0.0, 1), 3: (0.31, 1)}) == [False, True, True]
    assert kept_blocks(parents, kinds, shares, {4: (0.2, 1)}) == [True, True, False]


def test_edge_cases(spark):
    assert run(spark, []) == []
    rows = [
        (1, None, None), (1, "", ""), (2, "no host", "<p>a</p>"), (None, "http://x.example", "<p>b</p>"), (2, "//x.example", "<br><div></div>"),
        (3, "http://x.example/%", "<p>" + "word " * 400_000), (4, "http://x.example", "<div>" * 20_000 + "deep" + "</b>" * 1000), (5, "http://x.example", "&#xD800;&#0;\x00<p>퟿"),
    ]
    found = run(spark, rows)
    assert [t for i, t in found if i in (1, 2, None)] == ["", "", "", "a", "b"]
    assert dict(found)[3] == " ".join(["word"] * 400_000) and dict(found)[4] == "deep"
    assert len(dict(found)[5]) > 0


def test_unclosed_quotes_are_linear():
    page = "<p>x" + "<a href=\"" * 20_000 + "<div class='" * 20_000
    assert parse(page) is not None and parse(page + ">" + page) is not None
    assert blocks("<p>cut in a tag <a href='x") == ["cut in a tag"] and blocks("<p>cut <!-- in a comment") == ["cut"]
    assert blocks("<p>x<script>a > b") == ["x"] and blocks("<p>x<script>a</script>y") == ["xy"]


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_hosts_are_salted_alike(spark, monkeypatch, hot):
    rng = random.Random(hot)
    rows = [(i, f"http://h{i % hot}.example", f"<div class=k><p>Every page says this</p></div><div class=t><p>{words(rng, 9)}</p></div>") for i in range(60)]
    want = run(spark, rows)
    assert all("Every" not in t and t for _, t in want)
    real = sitetree.join_groups
    monkeypatch.setattr(sitetree, "join_groups", lambda a, b, k, n: real(a, b, k, n, hot_rows=10, max_keys=3))
    assert run(spark, rows) == want
