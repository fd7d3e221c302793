import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from quadrangle.llm import spelling
from quadrangle.llm.spelling import near_counts, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows, typo_every=97):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    """By trying every edit, not by prefixes and suffixes."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Near words by deleting each code point in turn, and by leaving a gap in its place."""
    holders = {}
    for w in words:
        for i in range(len(w)):
            holders.setdefault((w[:i], w[i + 1 :]), []).append(w)
    near = {w: set() for w in words}
    for (front, back), group in holders.items():
        whole = [front + back] if front + back in words else []
        for w in group:
            near[w].update(x for x in [*group, *whole] if x != w)
            for x in whole:
                near[x].add(w)
    return near


def brute(words):
    forms, out = {}, {}
    near = neighbours(words)
    assert len(words) > 300 or near == {w: {x for x in words if x != w and is_near(w, x)} for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)
    return out


def result(docs, **more):
    rows = spelling_variants(docs, **more).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def vocabulary(rng, size):
    words = set()
    while len(words) < size:
        word = "".join(rng.choices("abé", k=rng.randint(5, 9)))
        words.add(word)
        at = rng.randrange(len(word))
        words.add(word[:at] + rng.choice(["", "a", "ÿb"]) + word[at + rng.randint(0, 1) :])
    return sorted(w for w in words if len(w) >= 5)


@pytest.mark.parametrize("cells", [1, 60, spelling.TILE_CELLS])
def test_near_words_however_often_groups_are_split(spark, monkeypatch, cells):
    monkeypatch.setattr(spelling, "TILE_CELLS", cells)
    monkeypatch.setattr(spelling, "TILE_ROWS", min(cells, spelling.TILE_ROWS))
    rng = random.Random(cells)
    words = {w: rng.randint(3, 40) for w in vocabulary(rng, 250)}
    words |= {"z" * 70: 3, "z" * 71: 9, "z" * 35 + "y" + "z" * 34: 9}
    df = spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3)
    got = {r.word: (r.n_near, r.best) for r in near_counts(df).collect()}
    wanted = {w: [x for x in words if x != w and is_near(w, x)] for w in words}
    assert got == {w: (len(xs), min(xs, key=lambda x: (-words[x], x))) for w, xs in wanted.items() if xs}


def test_tiles_of_any_size_agree(monkeypatch):
    rng = random.Random(2)
    words = vocabulary(rng, 200)
    words = [w for w in words if len(w) in (6, 7)]
    counts = [rng.randint(3, 9) for _ in words]
    keys = [np.full(len(words), x) for x in (1, 7, 0, 0, 1 << 30)]
    whole = spelling.near_words(words, counts, keys)
    monkeypatch.setattr(spelling, "TILE_ROWS", 3)
    assert all((a == b).all() for a, b in zip(whole, spelling.near_words(words, counts, keys), strict=True))


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = vocabulary(rng, 60)
    weights = [rng.choice([1, 3, 9, 30]) for _ in pool]
    rows = []
    for doc in range(120):
        words = rng.choices(pool, weights, k=40)
        words = [rng.choice([str.upper, str.title, str])(w) if w.isascii() else w for w in words]
        rows.append((doc - 5, rng.choice([" ", ", ", "¿", "中", "_7"]).join(words)))
    rows += [(1000, None), (1001, ""), (None, " ".join(pool)), (7, rows[0][1]), (7, rows[0][1])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string").repartition(5)
    assert result(docs) == brute(counted(rows))


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = counted([(r.doc_id, r.text) for r in docs.collect()])
    assert len(words) > 500
    assert result(docs) == brute(words)


def test_chains_of_forms(spark):
    text = " ".join(["abcde"] * 3 + ["abcdef"] * 6 + ["abcdefg"] * 12 + ["abcdefgh"] * 24 + ["abcdefghi"] * 48)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = result(docs, typo_every=0)
    assert got["abcde"] == ("abcdef", "abcdefghi", 3, 1, 6)
    assert {r[1] for r in got.values()} == {"abcdefghi"}


def test_long_texts_long_words_and_empty_tables(spark):
    long = "q" * 400_000
    rows = [(1, "hello " * 300_000 + "Hellos " * 4), (2, f"{long} {long} {long} {long}x {long}x {long}x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(docs, typo_every=0)
    assert got["hellos"][:2] == ("hello", "hello") and got["hello"][2] == 300_000
    assert got[long][3] == got[long + "x"][3] == 1 and len(got) == 4
    assert result(docs.limit(0)) == {}
