"""Links and headings against a tree-building reference parser, URLs against urllib."""

from __future__ import annotations

import random
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from sheetmill.sources import html as H


class Tree(HTMLParser):
    """Elements of some tags, by the rules of a parser that keeps a stack of open elements."""

    def __init__(self, tags, with_href):
        super().__init__(convert_charrefs=True)
        self.tags, self.with_href = tags, with_href
        self.open, self.found, self.raw, self.run = [], [], 0, ""

    def flush(self, *_):
        for _, e in self.open:
            if e is not None and not self.raw and self.run:
                e[2].append(self.run)
        self.run = ""

    handle_comment = handle_decl = handle_pi = unknown_decl = flush

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.raw = tag if tag in ("script", "style") else 0
        attrs = dict(reversed(attrs))
        e = None
        if tag in self.tags and (not self.with_href or "href" in attrs):
            e = [tag, attrs.get("href") or "", []]
            self.found.append(e)
        if tag not in H.VOID:
            self.open.append((tag, e))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in H.VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        self.raw = 0
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.run += data


def parsed(text, tags, with_href=False):
    tree = Tree(tags, with_href)
    tree.feed(text)
    tree.close()
    tree.flush()
    return [(t, h, "".join(p), "".join(x.strip() for x in p)) for t, h, p in tree.found]


PIECES = [
    "plain ", " two words ", "5 < 6 ", "a &amp; b", "&lt;b&gt;", "&eacute;&#233;&#xE9;", "&amp;lt;", "&nbsp; x &nbsp;", "\n\t", "é🎉",
    "<b>", "</b>", "<p class='x'>", "</p>", "<div>", "</div>", "<br>", "<br/>", "<img src=x alt='>'>", "<i/>", "<H2>", "</h2>", "<h3 id=h>", "</H3 >",
    '<a href="/one">', "<A HREF='two?x=1&amp;y=2'>", "<a href=three>", "<a name=n>", "<a\n title='a > b' href = \"../four\" >", "<a href>", '<a data-href="no" title="href=no" href="yes">', "<a hrefs=no>", "</a>", "</A>", "<abbr>", "</abbr>",
    "<!-- <a href='/hidden'>hidden</a> <h2>no</h2> -->", "<!-- > -->", "<!DOCTYPE html>", "<?pi?>", "</x>",
    "<script>var s = '<a href=\"/no\">no</a><h2>no</h2>'; if (1 < 2) {}</script>", "<style media=x>h2 > a {}</style>", "<script src='x'></script>",
]


def test_elements_equal_a_tree_building_parser(spark):
    rng = random.Random(11)
    pages = ["", "no tags", *PIECES] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(4)
    got = df.select("i", H.elements("html", ("a",), True).alias("a"), H.elements("html", ("h2", "h3")).alias("h")).collect()
    for r in got:
        text = pages[r["i"]]
        shape = lambda es, href: [(e["tag"], e["href"] if href else "", e["text"], e["stripped"]) for e in es]
        assert shape(r["a"], True) == parsed(text, ("a",), True), text
        assert [(e[0], *e[2:]) for e in shape(r["h"], False)] == [(t, x, y) for t, _, x, y in parsed(text, ("h2", "h3"))], text


def test_long_pages(spark):
    """Long attributes, comments, runs of text, many links and deep nesting: no stack overflow."""
    pages = [
        f'<a title="{"x " * 60_000}" href="/y">far</a>',
        "<!-- " + "c - " * 60_000 + "--><a href=z>far</a>",
        "t < " * 60_000 + "<a href=z>far</a>",
        "<a " + " ".join(f"k{i}='v > {i}'" for i in range(20_000)) + " href=z>far</a>",
        "<script>" + "if (a < b) x(); " * 40_000 + "</script><a href=z>far</a>",
        "".join(f"<a href=/{i}>near</a> " for i in range(2000)) + "<a href=z>far</a>",
        "<div>" * 300 + "<a href=z>far" + "</div>" * 300,
        "<a href=z>far" + "<a " * 3000,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    got = {r["i"]: r["link"] for r in df.select("i", H.first_link_containing("html", F.lit("http://h/d/p"), "far").alias("link")).collect()}
    assert got == {0: "http://h/y", **{i: "http://h/d/z" for i in range(1, 8)}}


def test_links_resolve_as_urllib_does(spark):
    rng = random.Random(5)
    part = lambda: rng.choice(["a", "b.c", "..", ".", "", "d-e", "...", "x=1"])
    path = lambda n: "/".join(part() for _ in range(n))
    cases = []
    for _ in range(800):
        base = "http://host:80" + rng.choice(["", "/", "/" + "/".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) + rng.choice(["", "/"])]) + rng.choice(["", "?q=1/../2", "#f/x"])
        p = path(rng.randint(1, 6))
        while p.startswith("/") or "//" in p:
            p = p.lstrip("/").replace("//", "/")
        cases.append((base, rng.choice(["", "/"]) + p + rng.choice(["", "", "?x=../y", "#../z", "?a#b"])))
    cases += [("http://h/a/b", x) for x in ("", "#f", "?q", "//o/x/../y", "https://z/../q", "mailto:x@y", " /c ", "..", "../..", "./", "g/../../h/", "/..", "/./x/..", "/../../x")]
    cases = [(b, h) for b, h in cases if not h.strip().startswith("//") or h == "//o/x/../y"]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, base string, href string")
    got = {r["i"]: r["u"] for r in df.select("i", H.resolve_url("base", "href").alias("u")).collect()}
    for i, (base, href) in enumerate(cases):
        assert got[i] == urljoin(base, href.strip()), (base, href)


def test_nulls_and_strict(spark):
    df = spark.createDataFrame([(None, "http://h/"), ("<h2>x</h2>", None), ("<a href='y'>x</a>", None)], "html string, url string")
    rows = df.select(H.first_link_containing("html", "url", "x").alias("l"), H.first_heading_match("html", "x").alias("h")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (None, "x"), (None, None)]
