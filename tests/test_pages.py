import random
import urllib.robotparser
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from quern.functions import urls
from quern.functions.markup import is_plain, page_tokens
from quern.operators import frontier, pages
from quern.operators.robots import robots_filter, robots_rules, rules_for_agent
from quern.plans import site

# Markup, and what title, text and links must come out of it.
MESSY = {
    '<title>Home</title><a href="/x#frag">go</a> tail': ("Home", "Home go tail", ["/x#frag"]),
    "<title>A &eacute; b</title><a href=q>x</a>": ("A é b", "A é b x", ["q"]),
    "<a href=\"/a\" href=\"/b\">k</a><A HREF='c'>z</A>": ("", "k z", ["/b", "c"]),
    '<p title="x>y">text</p>': ("", "text", []),
    "<script>if(a<b){}</script>&lt;b&gt; &amp;lt; &#39;": ("", "if(a<b){} <b> &lt; '", []),
    "a<b c<!-- x --> d <title>one<b>two</b></title>": ("one two", "a d one two", []),
    "<title>one<b>two</b></title><title>three</title>": ("one two three", "one two three", []),
    "<title>never closed <p>more": ("never closed more", "never closed more", []),
    "<div>unclosed <script>x": ("", "unclosed", []),
    "tail &am": ("", "", []),
    "tail &amp;": ("", "tail &", []),
    "a & b &": ("", "", []),
    '<a href>n</a><a href="">e</a><a data-href="/no" href="/yes">q</a>': ("", "n e q", ["/yes"]),
    '<style>p{}</style><title/>z<script src="a.js"></script>': ("", "p{} z", []),
    "<script>var a = '</div>' + \"&amp;\"</script>": ("", 'var a = \'</div>\' + "&amp;"', []),
    "<SCRIPT>x</SCRIPT><Style>y</sTyle><br/>z<img src=a>": ("", "x y z", []),
    "<a href='/q?a=1&amp;b=2'>x</a>&nbsp;pad&nbsp;": ("", "x pad", ["/q?a=1&b=2"]),
    "<!DOCTYPE html><!-- a > b --><p>x<!-->y<p>z-->w": ("", "x w", []),
    "<?php x ?>after<![CDATA[ c ]]>more": ("", "after more", []),
    "<a\nhref = '/sp'>s</a><a href=/un/quoted>u</a>": ("", "s u", ["/sp", "/un/quoted"]),
    "": ("", "", []),
    "plain": ("", "plain", []),
}


def test_extraction_on_messy_markup(spark):
    df = spark.createDataFrame([(str(i), m) for i, m in enumerate(MESSY)], "url string, html string")
    got = {r.html: (r.title, r.text, r.links) for r in pages.page_extract(df).collect()}
    assert got == MESSY


def test_most_stored_pages_are_plain(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plain = df.select(is_plain(F.col("html"), page_tokens(F.col("html"))).alias("p"))
    assert plain.where("p").count() > 0.9 * df.count()


def test_css_variant(spark):
    html = "<head><title> T </title></head><body><p> a <b>b</b></p><script>s</script> c</body>"
    df = spark.createDataFrame([("u", html), ("v", "<title>x</title>no body")], "url string, html string")
    got = {r.url: (r.title, r.text) for r in pages.page_extract_css(df).collect()}
    assert got == {"u": ("T", "a  b s  c"), "v": ("x", "")}


# Links on https://ex.com/a/b?q=1#f: where they lead, and whether they stay on ex.com.
LINKS = {
    "/x#frag": ("https://ex.com/x", True),
    "/x?y=1": ("https://ex.com/x?y=1", True),
    "/a/../b": ("https://ex.com/b", True),
    "/./c": ("https://ex.com/c", True),
    "//other.org/z": ("https://other.org/z", False),
    "//ex.com/z": ("https://ex.com/z", True),
    "x": ("https://ex.com/a/x", True),
    "../up": ("https://ex.com/up", True),
    "?q=2": ("https://ex.com/a/b?q=2", True),
    "#top": ("https://ex.com/a/b?q=1", True),
    "": ("https://ex.com/a/b?q=1", True),
    "https://ex.com/p#q": ("https://ex.com/p", True),
    "https://ex.com": ("https://ex.com", True),
    "HTTP://EX.com/u": ("HTTP://EX.com/u", False),
    "http://other.org/": ("http://other.org/", False),
    "mailto:a@b.c": ("mailto:a@b.c", False),
    "javascript:void(0)": ("javascript:void(0)", False),
    "/sp ace": ("https://ex.com/sp ace", True),
    " /lead": ("https://ex.com/lead", True),
    "/semi;colon": ("https://ex.com/semi;colon", True),
    "/q?": ("https://ex.com/q", True),
    "ftp://ex.com/f": ("ftp://ex.com/f", False),
    "https:rel": ("https://ex.com/a/rel", True),
    "/é": ("https://ex.com/é", True),
    "/a//b": ("https://ex.com/a//b", True),
    "/..": ("https://ex.com/", True),
    "/a?b=../c": ("https://ex.com/a?b=../c", True),
    "http://[bad/x": (None, False),
}
# The same on other pages, where the page's own address matters.
ELSEWHERE = [
    ("http://Ex.com:8080", "/x?y=1", "http://Ex.com:8080/x?y=1", False),
    ("http://Ex.com:8080", "//ex.com/z", "http://ex.com/z", True),
    ("http://Ex.com:8080", "x", "http://Ex.com:8080/x", False),
    ("http://Ex.com:8080", "", "http://Ex.com:8080", False),
    ("http://Ex.com:8080", "https:rel", "https:rel", False),
    ("https://ex.com/a/", "x", "https://ex.com/a/x", True),
    ("https://ex.com/a/", "?q=2", "https://ex.com/a/?q=2", True),
    ("https://ex.com/x;p/y", "x", "https://ex.com/x;p/x", True),
    ("https://ex.com/x;p/y", "#top", "https://ex.com/x;p/y", True),
]


def test_resolve_and_normalize_links(spark):
    cases = [("https://ex.com/a/b?q=1#f", href, *want) for href, want in LINKS.items()] + ELSEWHERE
    df = spark.createDataFrame([(b, h) for b, h, _, _ in cases], "base string, href string")
    base, href = F.col("base"), F.col("href")
    got = df.select(base, href, urls.resolve_link(base, href), urls.normalize_link(base, href, F.lit("ex.com"))).collect()
    assert {tuple(r) for r in got} == {(b, h, url, url if stays else None) for b, h, url, stays in cases}


def test_host_predicates(spark):
    given = ["https://EX.com:80/x", "http://ex.com/", "https://u:p@ex.com/", "mailto:a@ex.com", "ftp://ex.com/", "x"]
    df = spark.createDataFrame([(u,) for u in given], "u string")
    rows = df.select(
        urls.hostname(F.col("u")), urls.same_netloc(F.col("u"), F.lit("ex.com")), urls.same_hostname(F.col("u"), F.lit("ex.com"))
    ).collect()
    assert [r[0] for r in rows] == [urlparse(u).hostname for u in given]
    assert [r[1] for r in rows] == [False, True, False, False, False, False]
    assert [r[2] for r in rows] == [True, True, True, False, True, False]


def test_html_only(spark):
    df = spark.createDataFrame(
        [(1, "text/html; charset=x", "h"), (2, None, "h"), (3, "application/pdf", "h"), (4, "text/html", "")],
        "i int, content_type string, html string",
    )
    assert [r.i for r in pages.html_responses(df).collect()] == [1]


ROBOTS = [
    "User-agent: *\nDisallow: /private\nAllow: /\n",
    "User-agent: Quern\nDisallow: /a\n\nUser-agent: *\nDisallow: /\n",
    "User-agent: other\n\nDisallow: /x\nUser-agent: *\nAllow: /x/y\nDisallow: /x\n# end",
    "User-agent: a\nUser-agent: quernbot\nDisallow: /p%41th\nDisallow: /é\nUser-agent: *\nDisallow:\n",
    "user-agent:*\ncrawl-delay: 3\ndisallow: *\n",
    "Disallow: /early\nUser-agent: *\nSitemap: http://x/y\nDisallow: /q?a=1\n\nDisallow: /late\nUser-agent: *\nDisallow: /second",
    "",
    "User-agent: *\nDisallow: /only # note\r\nAllow: /only/not\r\n",
]
PATHS = ["", "/", "/private/x", "/a", "/ab", "/x", "/x/y", "/x/z", "/pAth", "/p%41th", "/é", "/%C3%A9", "/q?a=1", "/q", "/late", "/early", "/second", "/only/not"]


def test_robots_equal_library(spark):
    agent = "QuernBot/1.0 (test)"
    files = spark.createDataFrame(
        [(f"h{i}.org", 200, body) for i, body in enumerate(ROBOTS)] + [("gone.org", 404, "User-agent: *\nDisallow: /"), ("down.org", None, None)],
        "host string, status int, body string",
    )
    hosts = [f"h{i}.org" for i in range(len(ROBOTS))] + ["gone.org", "down.org", "unknown.org"]
    table = spark.createDataFrame([(f"https://{h}{p}",) for h in hosts for p in PATHS], "url string")
    rules = rules_for_agent(robots_rules(files), agent)
    got = {r.url for r in robots_filter(table, rules).collect()}
    want = set()
    for host in hosts:
        library = urllib.robotparser.RobotFileParser()
        body = ROBOTS[int(host[1])] if host[0] == "h" else "User-agent: *\n" + ("Disallow: /" if host == "down.org" else "Allow: /")
        library.parse(body.splitlines())
        want |= {f"https://{host}{p}" for p in PATHS if library.can_fetch(agent, f"https://{host}{p}")}
    assert got == want
    assert {r.url for r in robots_filter(table, rules, hot_rows=1).collect()} == want


def ranks_by_level(graph, start, cap):
    """URL -> rank: per level, all offers sorted by parent rank and position, first offer of a URL counts."""
    ranks, level = {start: 1}, [start]
    while level:
        offers = sorted((ranks[p], i, dst) for p in level for i, dst in enumerate(graph.get(p, [])))
        fresh = list(dict.fromkeys(dst for _, _, dst in offers if dst not in ranks))[: cap - len(ranks)]
        ranks |= {dst: len(ranks) + k for k, dst in enumerate(fresh, 1)}
        level = fresh
    return ranks


@pytest.mark.parametrize("seed, cap", [(1, 1), (2, 15), (3, 40), (4, 10_000)])
def test_bounded_crawl_ranks(spark, seed, cap):
    rng = random.Random(seed)
    name = "https://ex.com/p/{}".format
    graph = {name(i): [name(rng.randrange(90)) for _ in range(rng.randint(0, 5))] for i in range(60)}
    rows = [(u, f"<title>t{u[-2:]}</title>" + "".join(f'<a href="{d}#s">x</a>' for d in dst) + '<a href="http://off.org/">o</a>') for u, dst in graph.items()]
    rows.append(("https://off.org/", "<title>off</title>"))
    df = spark.createDataFrame(rows, "url string, html string")
    got = frontier.bounded_crawl(df.union(df), name(0), cap).collect()
    want = {url: rank for url, rank in ranks_by_level(graph, name(0), cap).items() if url in graph}
    assert len(got) == len(want) and {r.url: r["rank"] for r in got} == want


def test_repeated_urls_are_taken_once(spark):
    rows = [
        (3, "https://ex.com/", "<title>late</title>"),
        (1, "https://ex.com/", ""),
        (2, "https://ex.com/", '<title>first</title><body><a href="HTTP://ex.com/b">b</a></body>'),
        (4, "HTTP://ex.com/b", "<title>b2</title>"),
        (4, "HTTP://ex.com/b", "<title>b1</title>"),
    ]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = frontier.bounded_crawl(df, "https://ex.com/", order=("page_id",)).collect()
    assert sorted((r["rank"], r.title) for r in got) == [(1, "first"), (2, "b1")]
    got = frontier.follow_links(df, "https://ex.com/", order=("page_id",)).collect()
    assert sorted((r["rank"], r.title) for r in got) == [(1, "first"), (2, "b1")]


def test_crawl_obeys_rules_and_skips_empty_pages(spark, tmp_path):
    rows = [
        ("https://ex.com/", '<a href="/a">a</a><a href="/no/b">b</a><a href="/e">e</a>'),
        ("https://ex.com/a", '<title>A</title><a href="c">c</a>'),
        ("https://ex.com/no/b", '<a href="/hidden">h</a>'),
        ("https://ex.com/hidden", "h"),
        ("https://ex.com/e", ""),
        ("https://ex.com/c", "end"),
    ]
    df = spark.createDataFrame(rows, "url string, html string")
    robots = spark.createDataFrame([("ex.com", 200, "User-agent: *\nDisallow: /no/")], "host string, status int, body string")
    rules = rules_for_agent(robots_rules(robots), "QuernBot/1.0")
    got = frontier.bounded_crawl(df, "https://ex.com/", 50, rules)
    assert sorted((r["rank"], r.url, r.depth) for r in got.collect()) == [
        (1, "https://ex.com/", 0), (2, "https://ex.com/a", 1), (5, "https://ex.com/c", 2),
    ]
    assert site.site_extract(df, "https://ex.com/", f"{tmp_path}/s", 50, rules) == 3
    back = spark.read.json(f"{tmp_path}/s")
    assert sorted(back.columns) == ["text", "title", "url"]
    with pytest.raises(ValueError):
        frontier.bounded_crawl(df, "https://ex.com/", 0)


def test_follow_links_ignores_port_and_case(spark):
    rows = [
        ("https://ex.com/", '<body><a href="https://EX.com:443/a">a</a><a href="https://sub.ex.com/">s</a></body>'),
        ("https://EX.com:443/a", "<title>A</title><body><p>x</p></body>"),
        ("https://sub.ex.com/", "s"),
    ]
    df = spark.createDataFrame(rows, "url string, html string")
    got = sorted((r.url, r.title, r.text) for r in frontier.follow_links(df, "https://ex.com/").collect())
    assert got == [("https://EX.com:443/a", "A", "x"), ("https://ex.com/", "", "a s")]
