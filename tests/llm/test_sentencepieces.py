import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quadrangle.llm.sentencepieces import BLANK, MODEL, Vocabulary, best_path, dictionary, document_pieces, encode, lattice, refined
from quadrangle.llm.textscan import buffers


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(spark, model, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: r for r in encode(docs, **more).collect()}
    assert len(out) == len(rows)
    for doc, text in rows:
        assert out[doc].ids == model.encode(text or ""), (doc, (text or "")[:80])
        assert out[doc].decoded == (text or "").replace("▁", " ")
        assert out[doc].round_trip == ("▁" not in (text or ""))


def odd_texts():
    rng = random.Random(3)
    alphabet = "aeth  \n\t.,-é日①😀ß▁'\x00<s>09"
    texts = ["", None, " ", "\n", "\n\n a", " a ", "a  b", "▁▁", "a▁b", "x" * 61, "=" * 5000, "ab" * 400, " " * 300 + "z", "the" * 30, "<0x41> <unk> </s>", "é"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 90))) for _ in range(300)]
    texts += ["".join(rng.choices("thesingando", k=rng.randint(1, 60))) for _ in range(300)]
    return list(enumerate(texts))


@pytest.mark.parametrize("head", [1 << 22, 40, 0])
def test_equals_the_encoder_on_odd_texts(spark, model, head):
    check(spark, model, odd_texts(), head_units=head)


def test_units_are_cut_where_no_piece_lies():
    vocabulary = Vocabulary()
    inside = {piece.replace(BLANK, " ") for piece, _, _ in vocabulary.rows if len(piece) > 1}
    words = [" ció\u00f1 niñ\u00e9ó the", "é日①😀ß", "andtionanre", " le\u00ea \u00e8ment", "x", "=" * 70] * 3
    data, offsets = buffers(pa.array(words, pa.large_string()))
    starts = refined(data, offsets[:-1], vocabulary)
    ends = np.r_[starts[1:], len(data)]
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    want = []
    for word in words:
        over = {p for i in range(len(word)) for j in range(i + 2, min(len(word), i + vocabulary.longest) + 1) if word[i:j] in inside for p in range(i + 1, j)}
        cuts = [0, *(p for p in range(1, len(word)) if p not in over), len(word)]
        want += [word[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    # a place may stay uncut by chance, but no piece's place is cut
    assert "".join(got) == "".join(want) and len(got) >= 0.9 * len(want) > len(words) + 6
    edges = set(np.cumsum([len(w) for w in want]).tolist())
    assert set(np.cumsum([len(g) for g in got]).tolist()) <= edges
    assert got[: len(got) // 3] * 3 == got


@pytest.mark.parametrize("head", [1 << 22, 5])
def test_words_glued_by_foreign_letters_make_no_units_of_their_own(spark, model, head):
    ends = ["the", "le", "que", "sch", "tion", "ich", "ly", "ing", "er", "on"]
    texts = [f"a{x}ñ é{y}ó ü{z}" for x in ends for y in ends for z in ends]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert dictionary(docs, Vocabulary()).count() <= 10 * len(ends)
    check(spark, model, list(enumerate(texts)), head_units=head)


def test_given_tables(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, model, [(r.doc_id, r.text) for r in docs.collect()], head_units=2000)


def test_long_text_repeated_rows_and_empty_table(spark, model):
    check(spark, model, [(1, " ".join(str(i) for i in range(150_000)))])
    rows = [(1, "the same", 0, 0), (1, "the same", 0, 0), (1, "another one", 0, 0), (None, "the same", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, unit int")
    got = sorted((r.doc_id or 0, r.decoded) for r in encode(docs, head_units=0).collect())
    assert got == [(0, "the same"), (1, "another one"), (1, "the same"), (1, "the same")]
    assert document_pieces(docs.limit(0)).collect() == []
    for head in (0, 1 << 20):
        sums = {r.doc_id: (r.n_pieces, r.ids_sha256, r.round_trip) for r in document_pieces(docs.where("doc_id IS NULL"), head_units=head).collect()}
        ids = model.encode("the same")
        assert sums == {None: (len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest(), True)}


def test_best_path_over_unigram_scores(spark):
    rng = random.Random(5)
    vocabulary = Vocabulary()
    pieces = {c: -rng.uniform(3, 6) for c in "abcd"} | {"".join(rng.choices("abcd", k=rng.randint(2, 4))): -rng.uniform(1, 9) for _ in range(60)}
    vocabulary.rows = [(p, i, s) for i, (p, s) in enumerate(pieces.items())]
    vocabulary.longest, vocabulary.merges = 4, False
    units = sorted({"".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(80)})
    words = spark.createDataFrame([(u, 1) for u in units], "unit string, n long")

    def best(unit):
        found = [(0.0, [])] + [(math.inf, [])] * len(unit)
        for stop in range(1, len(unit) + 1):
            for start in range(stop):
                cost = -pieces.get(unit[start:stop], -math.inf) if unit[start:stop] in pieces else (1e6 if stop - start == 1 else math.inf)
                if found[start][0] + cost < found[stop][0]:
                    found[stop] = (found[start][0] + cost, [*found[start][1], start])
        return sum(1 << p for p in found[len(unit)][1]) | 1 << len(unit)

    got = {r.unit: r.cuts for r in lattice(words, vocabulary, spark).withColumn("cuts", F.expr(best_path(vocabulary))).collect()}
    assert got == {u: best(u) for u in units}
