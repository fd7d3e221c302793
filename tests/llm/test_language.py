import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrangle.llm import gru, language


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(3, hidden=3).items()}
    data = rng.integers(97, 103, (7, 4)).astype(np.uint8)
    mask = (np.arange(7)[:, None] < np.array([7, 5, 3, 7])).astype(np.float64)
    label = np.array([0, 1, 2, 1])
    loss = lambda: gru.loss_and_gradients(p, data, mask, label)[0]
    _, g = gru.loss_and_gradients(p, data, mask, label)
    for name in p:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            if name[0] == "w":
                at = (int(rng.integers(97, 103)), at[1])
            kept, step = p[name][at], 1e-2
            p[name][at] = kept + step
            up = loss()
            p[name][at] = kept - step
            down = loss()
            p[name][at] = kept
            assert g[name][at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=2e-4)


def test_segments_cover_every_letter_once():
    texts = [b"abc", b"", b"x" * 1000, b"1 2", "é".encode() * 70]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    seen = np.zeros(len(texts), int)
    for _, _, weight, rows in gru.segments(data, offsets, 64, 3):
        np.add.at(seen, rows, weight.sum(axis=0))
    assert seen.tolist() == [3, 0, 1000, 0, 140]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs)
    assert out.count() == docs.count()
    judged = out.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.97


def test_edges(spark):
    rows = [(i, ["the and thing with", "der und nicht schön"][i % 2] * 3, ["en", "de"][i % 2], 1) for i in range(60)]
    rows += [(100, None, None, 1), (101, "", "en", 1), (102, "12 -- 3", "de", 1), (None, "und der schöne", "de", 1), (103, "—…", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in language.identify(docs, steps=60).collect()}
    assert all(got[i][:2] == ("und", 0.0) for i in (100, 101, 102, 103))
    assert got[None][0] == "de" and got[None][2] is False
    assert [got[i][0] for i in range(60)] == ["en", "de"] * 30
    assert language.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_reading_equals_the_network_that_was_trained():
    rng = np.random.default_rng(3)
    p = gru.initial(4)
    data = rng.integers(0, 256, (30, 9)).astype(np.uint8)
    mask = (np.arange(30)[:, None] < rng.integers(1, 31, 9)).astype(np.float32)
    mask[:3, 2] = 0  # a segment that begins its text
    assert np.allclose(gru.probabilities(p, data, mask), np.exp(gru.log_probabilities(p, data, mask)), atol=1e-5)


def test_very_long_texts_repeated_rows_and_ties(spark):
    words = {"aa": "kalo kalu ", "bb": "timi timo "}
    rows = [(i, words[lang] * 20, lang) for i in range(60) for lang in [["aa", "bb"][i % 2]]]
    rows += [(100, "kalo " * 600_000, None), (101, "timi " * 5, "aa"), (101, "timi " * 5, "aa"), (102, "é" * 1000, None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = {}
    for r in language.identify(docs, steps=60).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[100][0][0] == "aa" and got[100][0][1] > 0.9
    assert len(got[101]) == 2 and got[101][0] == got[101][1] and got[101][0][0] == "bb"
    assert got[102][0][0] in words
    assert language.identify(docs.limit(0)).collect() == []
