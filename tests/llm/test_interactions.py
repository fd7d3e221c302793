import random
import re
from itertools import permutations
from math import factorial

from quadrangle.llm import interactions
from quadrangle.llm.interactions import filter_interactions, path_counts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Every order applied to the rows themselves; docs: (doc_id, text, lang)."""
    least = {}
    for doc, text, _ in docs:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    rows = []
    for doc, text, lang in docs:
        text = text or ""
        words = WORDS.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc is not None and doc > least[text],
        }
        said = [(q, t) for d, q, t in labels if d == doc and d is not None]
        rows.append((lang or "", fails, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in mine)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(r[1][f] for r in mine) - len(gone), alone,
                    sum(r[2] for r in gone), sum(r[3] for r in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def result(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in interactions.COUNTS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_path_counts_are_factorials():
    reaching, leaving = path_counts(5)
    for state in range(32):
        size = state.bit_count()
        assert (reaching[state], leaving[state]) == (factorial(size), factorial(5 - size))


def test_equals_brute_force_with_nulls_copies_and_clashing_columns(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["alpha", "Beta", "gam#ma", "delta", "x\x0by", "é ß"] + [f"w{i}" for i in range(400)], k=rng.choice([0, 5, 199, 200, 260]))) for _ in range(12)]
    texts += [None, "", " \t\r\n", "a " * 300, "AB " * 250, "w " * 150_000]
    rows = [(rng.choice([*range(40), None]), rng.choice(texts), rng.choice(["en", "de", None])) for _ in range(90)]
    rows += [(7, texts[0], "en")] * 3 + [(7, texts[0], "de"), (None, texts[0], "en"), (3, "a|b", "")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(30)] + [(4, 1, 1), (4, 0, None), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, fails int, part string").repartition(5)
    known = spark.createDataFrame([(*r, 9) for r in labels], "doc_id long, quality int, toxic int, n int")
    wanted = brute(rows, labels)
    assert len(wanted) == 1800
    assert result(filter_interactions(docs, known)) == wanted


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_interactions(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "x", "en")], docs.schema)
    got = result(filter_interactions(one, labels))
    assert len(got) == 600 and got["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
