import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quadrangle.llm import countmin
from quadrangle.llm.substrings import _later, _runs, drop_repeated_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    """Reference result for rows with distinct doc_ids."""
    seen, out = {}, {}
    words = {doc: WORD.findall(text or "") for doc, text in rows}
    for doc in sorted(words):
        for i in range(len(words[doc]) - width + 1):
            seen.setdefault(tuple(words[doc][i : i + width]), (doc, i))
    for doc, text in rows:
        w = words[doc]
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] != (doc, i):
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc] = (len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest())
    return out


def result(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text, r.kept_sha256) for r in drop_repeated_substrings(docs, **more).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [" ".join(rng.choices("abcdé", k=rng.randint(5, 40))) for _ in range(6)]
    rows = []
    for doc in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices("uvwxyzß", k=rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        rows.append((doc * 3, rng.choice([" ", "\n", "\t ", "  "]).join(parts)))
    rows += [(1000, None), (1001, ""), (1002, rows[5][1]), (1003, rows[5][1]), (1004, "a " * 90), (1005, "a " * 90), (1006, " \n ")]
    assert result(spark, rows, width=6, gram=3) == brute(rows, 6)


def test_default_width_on_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text, r.kept_sha256) for r in drop_repeated_substrings(docs).collect()}
    assert got == brute(rows, 20)
    assert any(v[1] for v in got.values())


def test_long_text_and_long_word(spark):
    long = " ".join(str(i % 700) for i in range(400_000))
    rows = [(1, long), (2, "x" * 2_500_000 + " end"), (3, "k " * 25)]
    assert result(spark, rows) == brute(rows, 20)


def test_empty_table_repeated_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_words long")
    assert drop_repeated_substrings(empty).collect() == []
    text = " ".join(map(str, range(30)))
    rows = [(1, text, 5, 1.0), (1, text, 6, 2.0), (2, text, 7, 3.0), (None, text, 8, 4.0)]
    out = drop_repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string, start int, window double")).collect()
    assert sorted((r.doc_id or 99, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 30), (99, 30)]


def test_common_passage_is_compared_once_a_piece():
    passage = " ".join(map(str, range(60)))
    texts = [f"a{i} {passage} b{i}" for i in range(300)]
    columns = [pa.array(range(300), pa.int64()), pa.array(range(300), pa.int64()), pa.array(texts)]
    piece = pa.record_batch(columns, ["doc", "text_key", "text"])
    every = lambda values: np.ones(len(values), bool)  # noqa: E731  as a full sketch has it
    rows = _runs(piece, every, 20, 8).to_pylist()
    assert sum(r["many"] for r in rows) == 300 * 43
    # windows within the passage are sent by the first document alone
    hashes = [w for r in rows for w in r["windows"] or ()]
    assert len(hashes) <= 43 + 300 * 20 and sum(r["windows"] is None for r in rows) >= 299 * 2
    rows.sort(key=lambda r: (r["anchor"], r["doc"], r["text_key"], r["start"]))
    for step in (1, 7, len(rows)):
        batches = [pa.RecordBatch.from_pylist(rows[i : i + step], _runs(piece, every, 20, 8).schema) for i in range(0, len(rows), step)]
        late = {(r["doc"], s) for b in _later(batches) for r in b.to_pylist() for s in range(r["start"], r["start"] + r["many"])}
        assert late == {(doc, s) for doc in range(1, 300) for s in range(1, 42)}


@pytest.mark.parametrize("held", [0, 3, 1 << 18])
def test_a_full_sketch_and_anchors_of_many_windows_cost_no_word(spark, monkeypatch, held):
    # two rows a batch, so that an anchor's windows are held over many batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    monkeypatch.setattr(countmin, "cells_for", lambda keys: 1 << 16)
    rng = random.Random(held)
    passages = [" ".join(str(rng.randrange(10**6)) for _ in range(rng.randint(5, 30))) for _ in range(8)]
    rows = [(doc * 7 % 401, " ".join(rng.choice(passages) if rng.random() < 0.3 else str(rng.randrange(10**6)) for _ in range(40))) for doc in range(200)]
    try:
        assert result(spark, rows, width=6, gram=3, held=held) == brute(rows, 6)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
