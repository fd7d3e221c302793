import itertools
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from quadrangle.functions import urls

BASES = [
    "http://a/b/c/d;p?q=1", "http://a", "http://a/", "https://h:8080/x/", "http://a/b//c/",
    "http://user@h/b/c.html?x=/y/z#top", "https://h/é/ü.html", "http://h/a/../b/c",
]
REFS = [
    "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./",
    "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g",
    "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g?y/./x", "g#s/../x", "http://o/p/../q",
    "https://o/p?x=1#f", "HTTP://O/P", "//o:81/x", "mailto:x@h", "a b.pdf", "x|y[1].html", "ftp://f/x",
    "x//y", "/x//y", "  lead", "tab\tin", "q?", "h#", "é.pdf", "data:image.png", "http:", "a:b", "1a:b",
]


def _column(spark, rows, names):
    return spark.createDataFrame(rows, names)


def test_resolve_agrees_with_the_standard_library(spark):
    pairs = list(itertools.product(BASES, REFS))
    df = _column(spark, pairs, "base string, ref string")
    got = {(r.base, r.ref): r.url for r in df.select("base", "ref", urls.resolve(F.col("base"), F.col("ref")).alias("url")).collect()}
    wrong = {
        pair: (got[pair], urljoin(*pair))
        for pair in pairs
        if _normal(got[pair]) != _normal(urljoin(*pair))
    }
    assert wrong == {}


def _normal(url):
    """Scheme in lower case, and no empty query or fragment."""
    url = url.lstrip().replace("\t", "").rstrip("#").rstrip("?")
    head, colon, tail = url.partition(":")
    return head.lower() + colon + tail


def test_parts_agree_with_the_standard_library(spark):
    samples = [urljoin(b, r) for b, r in itertools.product(BASES, REFS)]
    df = _column(spark, [(s,) for s in sorted(set(samples))], "url string")
    for row in df.select("url", urls.url_parts(F.col("url")).alias("p"), urls.page_url(urls.url_parts(F.col("url"))).alias("page")).collect():
        want = urlparse(row.url)
        path = want.path + (";" + want.params if want.params else "")
        assert (row.p.scheme, row.p.netloc, row.p.path, row.p.query, row.p.fragment) == (
            want.scheme, want.netloc, path, want.query, want.fragment)
        page = f"{want.scheme}://{want.netloc}{want.path}" + (f"?{want.query}" if want.query else "")
        assert row.page == page


@pytest.mark.parametrize(
    "url, kind, bucket",
    [
        ("https://h/a.pdf", "pdf", "raw-documents"),
        ("https://h/a.PDF?x=1#y", "pdf", "raw-documents"),
        ("https://h/a.JPeG", "image", "raw-images"),
        ("https://h/a.csv", "json", "raw-json"),
        ("https://h/a.docx#p", "document", "raw-documents"),
        ("https://h/a.woff2", "skip", "raw-web-html"),
        ("https://h/a.html", "html", "raw-web-html"),
        ("https://h/pdf", "html", "raw-web-html"),
        ("https://h/a.pdf/", "html", "raw-web-html"),
        ("https://h/?f=a.pdf", "html", "raw-web-html"),
        ("pdf", "html", "raw-web-html"),
        ("", "html", "raw-web-html"),
    ],
)
def test_file_type_and_bucket(spark, url, kind, bucket):
    row = spark.createDataFrame([(url,)], "url string").select(
        urls.file_type(F.col("url")).alias("k"), urls.bucket(urls.file_type(F.col("url"))).alias("b")
    ).first()
    assert (row.k, row.b) == (kind, bucket)


def test_followable(spark):
    hrefs = ["", "#a", "javascript:x", "mailto:x", "tel:1", "telephone.html", "Mailto:x", "a#b", "/tel"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string")
    kept = [r.h for r in df.filter(urls.followable(F.col("h"))).collect()]
    assert kept == ["Mailto:x", "a#b", "/tel"]
