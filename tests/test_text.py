import html
import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from quadrangle.functions import text
from quadrangle.functions.urls import staged


def _apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", make(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_strip_removes_every_kind_of_edge_whitespace(spark):
    samples = ["  a b ", "\n\t a\n", " x　", "\x1cx\x1f", "", " \n ", "a  \n  b", " a\x85", "​a"]
    assert _apply(spark, samples, text.strip) == [s.strip() for s in samples]


def test_lossy_decoding_agrees_with_ignore(spark):
    rng = random.Random(7)
    pieces = [b"A", "é".encode(), "漢".encode(), "😀".encode(), "�".encode(), b"\xff", b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b"\x80", b"\xc0\xaf", b"\xed\xa0\x80"]
    samples = [b"", b"plain", b"A\xffB"] + [b"".join(rng.choices(pieces, k=12)) for _ in range(300)]
    got = _apply(spark, [bytearray(s) for s in samples], text.lossy_utf8, "binary")
    assert got == [s.decode("utf-8", errors="ignore") for s in samples]


def test_unescaping_agrees_with_the_standard_library(spark):
    samples = [
        "a&amp;b", "&lt;&gt;&quot;&apos;", "&#233;&#xE9;&#X1F600;", "&amp;#39;", "&amp;amp;", "&#38;lt;",
        "plain", "&", "&#0038;x", "&#128512;", "&amp;&#39;&#39;",
    ]
    got = _apply(spark, samples, lambda c: F.get(staged(F.array(c), *text.UNESCAPE_STEPS), F.lit(0)))
    assert got == [html.unescape(s) for s in samples]


def test_surrogate_reference_does_not_fail(spark):
    decode = lambda c: F.get(staged(F.array(c), *text.UNESCAPE_STEPS), F.lit(0))
    assert _apply(spark, ["&#55296;&#xD800;"], decode) == ["��"]


def test_iso_timestamp(spark):
    stamps = [datetime(2024, 6, 1, 8, 30), datetime(2024, 6, 1, 8, 30, 1, 250)]
    assert _apply(spark, stamps, text.iso_timestamp, "timestamp_ntz") == [s.isoformat() for s in stamps]


def test_other_time_formats(spark):
    stamp = [datetime(2024, 3, 5, 7, 8, 9)]
    assert _apply(spark, stamp, text.clock_timestamp, "timestamp_ntz") == ["2024-03-05 07:08:09"]
    assert _apply(spark, stamp, text.compact_timestamp, "timestamp_ntz") == ["20240305_070809"]
    assert _apply(spark, stamp, text.day_path, "timestamp_ntz") == ["year=2024/month=03/day=05"]


def test_json_object_agrees_with_the_standard_library(spark):
    samples = ['say "hi"', "back\\slash", "line\nbreak\ttab", "é漢😀", "", None, "a/b"]
    got = _apply(spark, samples, lambda c: text.json_object(first=c, second=F.lit("x")))
    assert got == [json.dumps({"first": s, "second": "x"}, ensure_ascii=False) for s in samples]


def test_keys_and_paths(spark):
    assert _apply(spark, ["Hassan II X"], text.slug) == ["hassan_ii_x"]
    assert _apply(spark, ["https://h/I123"], text.last_segment) == ["I123"]
    paths = ["a.pdf/b.docx", "x.doc", "x.document", "x.html"]
    assert _apply(spark, paths, text.json_extension) == ["a.json/b.json", "x.json", "x.jsonument", "x.html"]


def test_dynamic_markers_are_case_sensitive(spark):
    pages = ["x $(document).ready y", "uses React", "uses react", "", "getTabs()"]
    assert _apply(spark, pages, text.looks_dynamic) == [True, False, True, False, True]
