import random
import re

import pytest

from quadrangle.llm.decontaminate import contained_items, contamination

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def words_in(text):
    return len(WORD.findall(text or ""))


def brute(docs, items):
    out = {}
    for doc, text in docs:
        found = []
        for item, wanted in items:
            k = min(5, words_in(wanted))
            if k:
                own = shingles(wanted, k)
                both = len(own & shingles(text, k))
                if 100 * both >= 80 * len(own):
                    found.append((item, both, len(own)))
        out[doc] = sorted(found)
    return out


def result(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = contained_items(d, spark.createDataFrame(items, "item_id long, text string"))
    return {r.doc_id: [tuple(i) for i in r["items"]] for r in out.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 12, 30, 60, 200, 500])))) for i in range(60)]
    items += [(100, items[5][1]), (101, ""), (102, None)]
    docs = []
    for doc in range(120):
        text = rng.choices(vocabulary, k=rng.choice([0, 20, 300, 3000]))
        for _ in range(rng.randint(0, 3)):
            passage = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if passage:
                    passage[rng.randrange(len(passage))] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() for w in passage]
        docs.append((doc, rng.choice([" ", "\n", " \t"]).join(text)))
    docs += [(500, None), (501, "")]
    assert result(spark, docs, items) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    from quadrangle.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 3)
    items = [(i, " ".join(f"i{i}x{j}" for j in range(12))) for i in range(10)]
    docs = [(i, "some words " + " and ".join(items[j][1] for j in (i, (i + 3) % 10))) for i in range(10)]
    assert result(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2), (1, "a b c d e f", 1, 2), (None, "a b c d e f", 3, 4), (2, "x " * 300_000 + "a b c d e f", 5, 6)], "doc_id long, text string, `items` int, `item_id` int")
    items = spark.createDataFrame([(7, "A b c d e f", 0), (None, "a b c d e f", 0)], "item_id long, text string, doc_id int")
    out = contained_items(docs, items)
    assert out.columns == ["doc_id", "text", "item_id", "items"]
    assert [[tuple(i) for i in r["items"]] for r in out.collect()] == [[(7, 2, 2)]] * 4
    assert contained_items(docs.limit(0), items).collect() == []
    assert {r.n_items for r in contamination(docs, items.limit(0)).collect()} == {0}
    assert {tuple(r)[1:] for r in contamination(docs, items).collect()} == {(True, 1, 7, 1.0)}
