import random

import pytest

from quadrangle.llm.lines import LineRuns, drop_repeated_lines

BLANKS = " \t\n\x0b\f\r"


def brute(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != doc for x in lines]
        out[doc] = (len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g))
    return out


def result(docs):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in drop_repeated_lines(docs).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [rng.choice(["ÉTÉ ", "line ", "Ünder "]) * rng.randint(2, 6) + str(i) for i in range(12)]
    rows = []
    for doc in rng.sample(range(10**9), 80):
        lines = [rng.choice([str.upper, str.lower, str])(rng.choice(pool)) for _ in range(rng.randint(1, 9))]
        lines = [rng.choice(["", " ", "\t", "\x0b"]) + x + rng.choice(["", "\r", " \f", " "]) for x in lines]
        rows.append((doc, "\n".join(lines)))
    rows += [(-5, None), (-4, ""), (-3, "\n\n"), (-2, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(docs) == brute(rows)


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == brute(rows)


def test_runs_are_compacted(spark):
    runs = LineRuns(spark)
    for batch in range(7):
        runs.add(spark.createDataFrame([(100 - batch, 1, 1), (200 - batch, 2, batch)], "doc_id long, k1 long, k2 long"))
    assert [len(level) for level in runs.levels] == [1, 2]
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 100)]


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, line string")
    assert drop_repeated_lines(empty).collect() == []
    line = "a line of more than twenty letters"
    rows = [(d, t, 1, 2, 3) for d, t in [(1, line), (1, line + "\nb"), (2, line), (3, line), (3, line), (None, line)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone int, n_lines int, text_key int")
    out = drop_repeated_lines(docs)
    assert out.columns == ["doc_id", "text", "gone", "text_key", "n_lines", "n_dropped", "kept_text"]
    got = sorted((r.doc_id or 0, r.kept_text, r.n_dropped) for r in out.collect())
    assert got == [(0, line, 0), (1, "", 1), (1, "b", 1), (2, "", 1), (3, line, 0), (3, line, 0)]
