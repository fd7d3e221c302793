import random

import pytest
from pyspark.sql import functions as F

from quadrangle.llm.tokencount import EDITS, ROW_EDITS, Counted, apply_edits, attach_edits, build_trees, cut_leaves, document_edits, encoding, read_ranks


@pytest.fixture(scope="module")
def count():
    own = encoding("ranks", read_ranks())
    return lambda text: len(own.encode_ordinary(text))


def changed(text, edits):
    for start, removed, inserted in edits:
        start = min(max(0, start), len(text))
        removed = min(max(0, removed), len(text) - start)
        text = text[:start] + inserted + text[start + removed :]
    return text


def random_text(rng, n):
    return "".join(rng.choices([" ", "  ", "\n", "the", "don't", "é", "日", "123", ".", " a", "x", "\t", " ", "'s", "\x1c"], k=n))


@pytest.mark.parametrize("seed", range(4))
def test_counts_follow_edits(count, seed):
    rng = random.Random(seed)
    for _ in range(30):
        text = random_text(rng, rng.choice([0, 1, 40, 2000]))
        held, now = Counted.build(text, count), text
        assert held.tokens.total() == count(text)
        for _ in range(12):
            edit = (rng.randint(-3, len(now) + 5), rng.choice([0, 1, 9, 700]), random_text(rng, rng.choice([0, 1, 5, 3000 if rng.random() < 0.1 else 2])))
            held.edit(*edit)
            now = changed(now, [edit])
            assert held.text == now
            assert held.tokens.total() == count(now)
            assert held.chars.total() == len(now)


def test_only_the_touched_region_is_encoded(count):
    text = "some plain words here " * 5000
    held = Counted.build(text, count)
    held.edit(50_000, 3, "changed")
    assert 0 < held.encoded < 2000


def test_leaves_join_up():
    assert cut_leaves("") == []
    text = "ab cd  ef " * 200
    assert sum(cut_leaves(text, 16)) == len(text) and len(cut_leaves(text, 16)) > 20
    assert cut_leaves("x" * 5000) == [5000]


def test_given_tables_and_edits_table(spark, count):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    edited = docs.select("doc_id", "text", "source", F.expr(ROW_EDITS).alias("edits")).collect()
    wanted = {}
    for r in edited:
        wanted[r.doc_id] = (count(r.text), count(changed(r.text, [(e.start, e.removed, e.inserted) for e in r.edits])))
    assert {r.doc_id: (r.n_before, r.n_tokens) for r in document_edits(docs).collect()} == wanted
    table = docs.select("doc_id", F.explode(F.expr(ROW_EDITS)).alias("e")).select("doc_id", "e.*")
    out = apply_edits(attach_edits(build_trees(docs), table))
    assert {r.doc_id: (r.n_before, r.n_tokens) for r in out.collect()} == wanted


def test_edges(spark, count):
    rows = [(1, None, None, 5), (1, "a b", None, 5), (2, "", "s", 5), (None, "words here", "s", 5), (3, "w " * 200_000, "s", 5), (4, "z" * 20_000, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int")
    got = sorted((r.doc_id or 0, r.n_before, r.n_tokens) for r in document_edits(docs).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3, 4]
    assert got[3] == (2, 0, count(" s "))
    assert got[4][1] == count("w " * 200_000)
    assert document_edits(docs.limit(0)).collect() == []
    plain = apply_edits(build_trees(docs.where("doc_id = 2"))).first()
    assert (plain.n_before, plain.n_tokens, plain.n_reencoded) == (0, 0, 0)
    odd = spark.createDataFrame([(2, "abc", [(None, None, 9, None), (1, 99, 1, "d")])], f"doc_id long, text string, edits {EDITS}")
    assert apply_edits(build_trees(odd)).first().text == ""


def test_very_long_runs_of_blanks(spark, count):
    from quadrangle.llm.tokencount import RANKS, count_tokens, encoding, read_ranks

    own = encoding("ranks", read_ranks(RANKS))
    blanks = [" ", "\n", "\t\n ", "\u00a0 ", "\r\n"]
    for one in blanks:
        for before, after in (("", ""), ("a", "b"), ("x.", " ?"), ("1", "\x1c"), ("é", "7")):
            text = before + one * 12_000 + after + " word" + one * 10_001
            assert count_tokens(own, text) == count(text)
    rows = [(1, " " * 1_500_000), (2, "a" + "\n" * 1_500_000 + "b"), (3, "\r\n \t" * 400_000)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    got = {r.doc_id: r.n_before for r in document_edits(docs).collect()}
    assert got == {d: count_tokens(own, t) for d, t in rows}
