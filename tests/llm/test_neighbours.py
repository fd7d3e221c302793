import numpy as np

from quadrangle.llm import hnsw
from quadrangle.llm.neighbours import nearest


def brute(rows, asked, k):
    vectors = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in asked:
        if q in vectors:
            near = sorted((-float((vectors[i] * vectors[q]).sum()), i) for i in vectors if i != q)[:k]
            out[q] = [i for _, i in near]
    return out


def recall(found, wanted):
    return sum(len(set(found.get(q, [])) & set(w)) for q, w in wanted.items()) / sum(map(len, wanted.values()))


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(out[r.query_id])
    return out


def test_graph_recall_on_clustered_points():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(0, 1, (1500, 32)), rng.normal(0, 0.01, (1500, 32)) + rng.normal(0, 1, 32)])
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    layers = hnsw.build(hnsw.lift(points, 1.0))
    asked = points[::30]
    found = hnsw.search(hnsw.lift(points, 1.0), layers, np.c_[asked, np.zeros(len(asked))].astype(np.float32), 128)
    true = np.argsort(-(asked @ points.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.tolist(), true.tolist(), strict=True)]) > 0.95


def test_given_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = results(nearest(table, "vec_id % 20 = 0", shard_rows=500))
    wanted = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert set(found) == set(wanted)
    assert recall(found, wanted) >= 0.95


def test_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 4).round(3).tolist()) for i in range(1, 60)]
    rows += [(i, [9.0, 9.0, 9.0, 9.0]) for i in range(100, 180)]
    rows += [(200, None), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [float("nan"), 1.0, 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0, 1.0]), (300, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("x", "vector")
    plain = [(i, np.float32(v).tolist() if v and None not in v else v) for i, v in rows if i < 200]
    asked = [i for i, _ in plain if i % 20 == 0]
    assert results(nearest(df, "vec_id % 20 = 0")) == brute(plain, asked, 20)


def test_empty_repeated_and_few(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, rank int")
    assert nearest(empty, "vec_id % 20 = 0").collect() == []
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [2.0, 0.0], 1), (1, [3.0, 0.0], 1), (None, [1.0, 1.0], 1)]
    out = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, class int"), "vec_id = 0").collect()
    assert [tuple(r) for r in out] == [(0, 1, 1, 2.0)]
