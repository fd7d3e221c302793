import collections

from quadrangle.llm.sharding import assign_shards, document_shards, write_shards


def pages(out):
    held = collections.defaultdict(list)
    for r in out.collect():
        held[r.depth, r.prefix, r.page].append(r)
    return held


def check(held, limit):
    for (depth, _, page), rows in held.items():
        assert len(rows) == 1 or sum(r.n_bytes for r in rows) <= limit
        if page == 0:
            assert all(r.shard_rows == len(rows) and r.shard_bytes == sum(x.n_bytes for x in rows) for r in rows)
    # no bucket lies inside another, and siblings together do not fit
    buckets = {(d, p): rows[0].shard_bytes for (d, p, _), rows in held.items()}
    for (depth, prefix), size in buckets.items():
        assert not any((d, prefix >> depth - d) in buckets for d in range(depth))
        if (depth, prefix ^ 1) in buckets:
            assert size + buckets[depth, prefix ^ 1] > limit


def test_every_shard_fits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for limit in (20_000, 300_000, 10**9):
        held = pages(assign_shards(docs.select("doc_id", "text"), ["doc_id", "text"], limit))
        assert sum(map(len, held.values())) == docs.count()
        check(held, limit)
        assert limit < 10**9 or list(held) == [(0, 0, 0)]


def test_copies_long_rows_nulls_and_clashing_names(spark):
    rows = [(1, "copy of a row " * 10, 0)] * 200 + [(i, "text", 0) for i in range(50)] + [(None, None, 0), (None, "", 0), (7, "y" * 50_000, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, h int").repartition(4).withColumnRenamed("h", "page")
    out = assign_shards(table, ["doc_id", "text"], 1000)
    assert out.select("row.*").columns == ["doc_id", "text", "page"]
    held = pages(out)
    assert sum(map(len, held.values())) == len(rows)
    check(held, 1000)
    assert any(page for _, _, page in held)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert document_shards(empty).collect() == []


def test_written_shards(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = write_shards(docs, ["doc_id", "text"], f"{folder}/shards", 100_000)
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == n
