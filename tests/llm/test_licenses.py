import random
import re

import pytest
import regex
from compare import connect

from quadrangle.llm.licenses import NOTICES, PHRASES, Searcher, _holds, find_licenses, license_digests, scan_text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SAID = {p.text: p.label for p in PHRASES}


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(text):
    """Places of the phrases, word by word."""
    words = WORD.findall(lowered(text))
    places = [
        (i, label) for phrase, label in SAID.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited_labels(text, searcher):
    """Labels of notices within their number of edits of some run of whole words."""
    words = WORD.findall(lowered(text))
    found = set()
    for notice, k in zip(searcher.notices, searcher.edits, strict=True):
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                run = " ".join(words[i:j])
                if len(run) > len(notice.text) + k:
                    break
                if len(run) >= len(notice.text) - k and _holds(run, notice.core.split()) and distance(run, notice.text) <= k:
                    found.add(notice.label)
    return found


def test_labels_equal_edit_distance_on_damaged_notices():
    rng, searcher = random.Random(5), Searcher()
    for _ in range(150):
        notice = rng.choice(searcher.notices)
        letters = list(notice.text)
        for _ in range(rng.randint(0, searcher.edits[searcher.notices.index(notice)] + 1)):
            at = rng.randrange(len(letters))
            rng.choice([lambda: letters.pop(at), lambda: letters.insert(at, rng.choice("aex ")), lambda: letters.__setitem__(at, rng.choice("aex ")),])()
        text = rng.choice(["", "some Words, ", "été 7 "]) + "".join(letters) + rng.choice(["", ". More of it.", " x" * 20])
        row = scan_text(searcher, text)
        assert set(filter(None, row[5].split(","))) == edited_labels(text, searcher), text
        assert row[:5] == plain(text)


@pytest.mark.parametrize("text,labels", [
    ("Released under the MIT License.", "mit"), ("Released under the MIT Licence.", "mit"), ("under the BIT license", ""),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"), ("Licensed under the Apache License, Version 3.0.", ""),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY-ND 4.0.", ""), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("under the GNU General Public License, version 3.", "gpl-3"), ("the GNU Lesser General Public License version 3", "lgpl-3"),
    ("under  the\n* MIT-License; cc\tby  nc", "cc-by-nc,mit"),
])
def test_notices(text, labels):
    assert scan_text(Searcher(), text)[5] == labels


def test_spans_report_words_and_edits():
    *_, score, spans = scan_text(Searcher(), "Ünder this: relased under the MIT licence!")
    best = next(s for s in spans if s["text"].startswith("relased"))
    assert (best["label"], best["start"], best["n_words"], best["edits"]) == ("mit", 2, 5, 2)
    assert score == max(1 - s["edits"] / len(n.text) for s in spans for n in (*PHRASES, *NOTICES) if n.label == "mit" and distance(s["text"], n.text) == s["edits"])


def test_every_place_of_a_phrase_counts_and_pieces_cover_it():
    searcher = Searcher()
    text = "cc by nc " * 3 + "cc by nc-x by nc cc by cc by nc"
    assert scan_text(searcher, text)[:5] == plain(text)
    assert regex.fullmatch(r"(?:abcd){e<=1}", "abxcd").fuzzy_counts == (0, 1, 0)


def test_whole_table_against_plain_places_and_sql(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in license_digests(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {d: r[:5] for d, r in got.items()} == {d: plain(t) for d, t in texts.items()}
    assert all(set(r[4].split(",")) <= set(r[5].split(",")) for r in got.values() if r[4])
    counted = connect(path).execute(r"""
        SELECT doc_id, len(w), (length(' ' || t || ' ') - length(replace(' ' || t || ' ', ' under the mit license ', ' '))) // 22
             + (length(' ' || t || ' ') - length(replace(' ' || t || ' ', ' apache license version 2 ', ' '))) // 25
             + (length(' ' || t || ' ') - length(replace(' ' || t || ' ', ' cc by nc ', ' '))) // 9
        FROM (SELECT doc_id, w, array_to_string(w, ' ') AS t FROM (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents))
    """).fetchall()
    assert {d: (n, b) for d, n, b in counted} == {d: r[:2] for d, r in got.items()}


def test_edges(spark):
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (None, "under the mit license", 1, "x"), (4, "a" * 3_000_000 + " cc by nc " + "under the " * 50_000, 1, "x"), (4, "CC BY NC", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels int, spans string")
    got = [tuple(r) for r in find_licenses(docs).drop("spans").collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0), (None, 4, 1, 0, 0, "mit", "mit", 1.0),
        (4, 100_004, 1, 1, 1, "cc-by-nc", "cc-by-nc", 1.0), (4, 3, 1, 0, 0, "cc-by-nc", "cc-by-nc", 1.0),
    ], key=repr)
    assert find_licenses(docs.limit(0)).collect() == []
