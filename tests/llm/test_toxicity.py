import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quadrangle.llm import toxicity
from quadrangle.llm.transducers import KINDS, clause_kinds, compose, Transducer


def test_composition_feeds_one_machine_to_the_next():
    swap = Transducer(0, {(0, "a"): (0, "b"), (0, "b"): (0, "a")})
    count = Transducer(0, {(n, s): ((n + (s == "a")) % 2, str(n)) for n in (0, 1) for s in "ab"})
    both = compose(swap, count, "ab")
    assert both.read("abba") == count.read(swap.read("abba"))


@pytest.mark.parametrize("symbols,kind", [
    ("wIw", "plain insult"), ("TwI", "targeted insult"), ("ITw", "targeted insult"), ("NwI", "negated insult"),
    ("NwwwwI", "plain insult"), ("RwI", "reported insult"), ("HwT", "threat"),
])
def test_grammar(symbols, kind):
    assert clause_kinds(symbols) == {kind}


def test_threat_needs_a_target_and_clauses_are_separate():
    assert clause_kinds("wHw") == frozenset()
    grammar = toxicity.Grammar(["oaf$", "blit"])
    counts = dict(zip(KINDS, grammar.counts("Oaf here. You blitter! Not an oaf; he said oaf"), strict=True))
    assert counts == {"plain insult": 1, "targeted insult": 1, "negated insult": 1, "reported insult": 1, "threat": 0}
    assert sum(grammar.counts("loaf oafish rablit")) == 0
    assert sum(grammar.counts("")) == 0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    assert out.count() == docs.count()
    judged = out.where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").select("doc_id", "toxic", "predicted", "score").collect()
    right = sum(r.toxic == r.predicted for r in judged)
    assert right / len(judged) > 0.97
    # some held-out toxic rows hold no word that tells toxic rows apart (9 of 144, junk with
    # a stray label); text alone cannot catch those, and they are told here without the model
    known = docs.join(labels, "doc_id").select("doc_id", "toxic", "text", toxicity.learnable().alias("seen")).collect()
    words = {r.doc_id: set(toxicity.LETTERS.findall(r.text.lower())) for r in known}
    marked, plain = (Counter(w for r in known if r.seen and r.toxic == t for w in words[r.doc_id]) for t in (1, 0))
    telling = {w for w, n in marked.items() if len(w) > 3 and n >= 4 and plain[w] <= 0.1 * n}
    caught = {r.doc_id: r.predicted for r in judged if r.toxic}
    told = [d for d in caught if words[d] & telling]
    assert len(told) / len(caught) > 0.9
    assert sum(caught[d] for d in told) / len(told) > 0.9
    assert sum(caught.values()) / len(caught) > 0.85
    clean = [r for r in judged if not r.toxic]
    assert sum(r.predicted for r in clean) / len(clean) < 0.01


def test_edges(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=20)) + (" blitterling." if i % 3 == 0 else "."), 7) for i in range(300)]
    rows += [(900, None, 1), (901, "", 1), (None, "blitterling", 1), (902, "a " * 300_000 + "blitterling", 1), (0, rows[0][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {}
    for r in toxicity.toxicity(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r.predicted)
    assert got[902] == [1] and got[None] == [1] and got[0] == [1, 1]
    assert got[900] == got[901] == [0]
    none = toxicity.toxicity(docs, labels.limit(0)).agg(F.max("predicted"), F.count("*")).first()
    assert tuple(none) == (0, len(rows))
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
