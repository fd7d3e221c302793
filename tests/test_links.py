"""Link extraction against a small parser-based rendition."""

import random
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from quadrangle.constants import FILE_TYPE_EXTENSIONS
from quadrangle.functions.urls import netloc
from quadrangle.operators.links import allowed_link, page_links

IMAGES = tuple("." + e for e in FILE_TYPE_EXTENSIONS["image"])


class _Tags(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        wanted = {"a": "href", "img": "src"}.get(tag)
        if wanted:
            self.found.append((tag, dict(attrs).get(wanted)))


def expected_links(url, html):
    parser, links = _Tags(), set()
    parser.feed(html)
    for tag, ref in parser.found:
        if not ref:
            continue
        target = urljoin(url, ref)
        image = target.lower().split("?")[0].split("#")[0].endswith(IMAGES)
        if tag == "img" and image:
            links.add(target)
        if tag == "a" and not any(ref.startswith(p) for p in ("#", "javascript", "mailto", "tel")):
            parts = urlparse(target)
            if parts.netloc == urlparse(url).netloc or image:
                query = f"?{parts.query}" if parts.query else ""
                links.add(f"{parts.scheme}://{parts.netloc}{parts.path}{query}")
    return links


PAGES = {
    "quotes": ('http://h/d/p.html', """<a href="/one">1</a><a href='two'>2</a><a href=three>3</a><A HREF = "four" >4</A>"""),
    "order": ('http://h/d/p.html', """<a class="x" data-href="no" href="yes" title='href="no2"'>t</a>"""),
    "decoy": ('http://h/', """<a title="a > b" alt=' href=no ' href="real">t</a><abbr href="no">x</abbr><a>none</a>"""),
    "entities": ('http://h/', """<a href="/s?a=1&amp;b=2">t</a><a href="/caf&#233;&#xe9;">t</a>"""),
    "rejected": ('http://h/', """<a href="#x">t</a><a href="mailto:a@b">t</a><a href="javascript:f()">t</a><a href="tel:1">t</a><a href="">t</a>"""),
    "domains": ('http://h:8080/', """<a href="http://h/other-port">t</a><a href="http://o/x">t</a><a href="http://o/x.PNG?s=1#f">t</a><a href="//h:8080/same">t</a>"""),
    "fragments": ('http://h/a/', """<a href="x#1">t</a><a href="x#2">t</a><img src="i.png#f"><img src="i.png#g">"""),
    "images": ('http://h/a/', """<img src="/x.js"><img alt="" src='../y.svg'/><img src=z.gif><img>"""),
    "inert": ('http://h/', """<!-- <a href="/c">t</a> --><script>var a='<a href="/s">';</script><style>a{}</style><a href="/live">t</a>"""),
    "lines": ('http://h/', """<a\n  class="k"\n  href="/multi"\n>t</a>"""),
    "params": ('http://h/', """<a href="/x;v=1?q=2">t</a><a href="/a.jpg;v=1">t</a>"""),
    "stray": ('http://h/', """<a title='it's' href="/x">t</a><a href=a"b>t</a><a rel=x/y href=/z>t</a><a href = '/w' x=>t</a>"""),
    "nothing": ('http://h/', "plain text"),
    "dots": ('http://h/a/b/c', """<a href="../up">t</a><a href="./here">t</a><a href="../../../../top">t</a><a href="?only=query">t</a>"""),
}


@pytest.mark.parametrize("name", PAGES)
def test_links_of_a_page(spark, name):
    url, html = PAGES[name]
    pages = spark.createDataFrame([(url, html)], "url string, html string")
    rows = page_links(pages, keep=["url"]).filter(allowed_link(netloc(F.col("url")))).collect()
    got = [r.link for r in rows]
    assert sorted(got) == sorted(expected_links(url, html))


def _random_page(rng):
    refs = ["/a", "b", "../c", "?q=1&amp;r=2", "#f", "http://o/x", "http://o/y.png", "//h/z", "d.gif#1", "mailto:x", "tel:1", "", "e;p=1", "/f/./g", "h i"]
    out = []
    for _ in range(rng.randrange(12)):
        tag = rng.choice(["a", "A", "a", "img", "IMG", "abbr", "p"])
        attrs = []
        for _ in range(rng.randrange(5)):
            name = rng.choice(["href", "HREF", "href", "src", "src", "class", "title", "data-href", "srcset"])
            ref = rng.choice(refs)
            quote = rng.choice(['"', "'", ""]) if ref and " " not in ref else '"'
            if name in ("title", "class"):
                ref, quote = rng.choice([("a > b", '"'), ("href='no'", '"'), (' src="no" ', "'"), ("k", "")])
            if any(a.lower().startswith(name.lower()) for a in attrs):
                continue
            attrs.append(f"{name}{rng.choice(['=', '=', ' = '])}{quote}{ref}{quote}")
        space = rng.choice([" ", "  ", "\n"])
        out.append(f"<{tag}{space}{space.join(attrs)}{rng.choice(['', ' '])}>text</{tag}>")
        if rng.random() < 0.2:
            out.append(rng.choice(['<!-- <a href="/no"> -->', "<script>'<a href=/no>'</script>", "< a", "5 > 3", "it's"]))
    return "".join(out)


def test_random_pages(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["http://h/d/p", "https://h/", "http://h/x/y/?q=1#f"]), _random_page(rng)) for i in range(900)]
    pages = spark.createDataFrame(rows, "i int, url string, html string")
    got = {}
    for r in page_links(pages, keep=["i", "url"]).filter(allowed_link(netloc(F.col("url")))).collect():
        got.setdefault(r.i, []).append(r.link)
    wrong = [
        (html, sorted(got.get(i, [])), sorted(expected_links(url, html)))
        for i, url, html in rows
        if sorted(got.get(i, [])) != sorted(expected_links(url, html))
    ]
    assert wrong == []
    assert sum(map(len, got.values())) > 500


def test_a_long_tag_does_not_exhaust_the_stack(spark):
    html = '<a title="' + "x" * 200_000 + '" ' + "b='1' " * 20_000 + 'href="/far">t</a>'
    pages = spark.createDataFrame([("http://h/", html)], "url string, html string")
    assert [r.link for r in page_links(pages).collect()] == ["http://h/far"]


def test_whole_pages_are_read(spark):
    html = "<p>" + "text " * 100_000 + '</p><a href="/last">t</a>'
    pages = spark.createDataFrame([("http://h/", html), ("http://h/null", None)], "url string, html string")
    assert [r.link for r in page_links(pages).collect()] == ["http://h/last"]
