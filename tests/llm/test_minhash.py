import random
import re

import pytest

from quadrangle.llm.minhash import matches_for, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute(rows, k, percent):
    sets = [(d, shingles(t, k)) for d, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d), find(d) == d) for d, s in sets}


def result(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, **more).collect()}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, words, percent):
    rng = random.Random(words)
    rows = []
    for family in range(12):
        base = rng.choices([f"w{i}" for i in range(300)], k=rng.choice([1, 2, 4, 30, 120]))
        for _ in range(rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                text[rng.randrange(len(text))] = "Z" + str(rng.randrange(9))
            rows.append((rng.randrange(10**6), rng.choice([" ", "\n"]).join(text)))
    rows += [(2_000_000, None), (2_000_001, ""), (2_000_002, " \t"), (2_000_003, rows[0][1].upper()), (2_000_004, rows[0][1])]
    rows = list({d: (d, t) for d, t in rows}.values())
    assert result(spark, rows, words=words, percent=percent) == brute(rows, words, percent)


def test_chain_of_edits(spark):
    """Neighbours are linked, the two ends are not: one component over many links."""
    words, rows = [f"x{i}" for i in range(200)], []
    for step in range(40):
        rows.append((500 - step, " ".join(words)))
        words[step * 4] = f"y{step}"
    assert result(spark, rows, words=3, percent=85) == brute(rows, 3, 85)


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, sig int")
    assert near_duplicates(empty).collect() == []
    text = " ".join(map(str, range(30)))
    rows = [(7, text, 1), (7, "other text " * 9, 2), (3, text, 3), (None, text, 4), (9, "other text " * 9, 5)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, u int")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == [(0, 0, True), (3, 3, True), (7, 3, False), (7, 3, False), (9, 3, False)]


def test_families_of_edits(spark):
    """Copies edited apart, few of them within reach of the first, some of each other."""
    rng = random.Random(11)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(100)]
        texts = [list(base)]
        for _ in range(60):
            text = list(rng.choice([base, base, rng.choice(texts)]))
            for _ in range(rng.randint(1, 6)):
                at = rng.randrange(len(text))
                text[at : at + rng.choice([1, 1, 0])] = rng.choice([[], [f"e{rng.randrange(10**6)}"], [f"e{rng.randrange(4)}"]])
            texts.append(text)
        rows += [(rng.randrange(10**9), " ".join(t)) for t in texts]
    for words, percent in ((3, 85), (5, 80)):
        assert result(spark, rows, words=words, percent=percent) == brute(rows, words, percent)


def test_match_threshold():
    assert matches_for(100) == 64
    assert 30 <= matches_for(80) < matches_for(85) < 64
