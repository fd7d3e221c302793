"""Nearest vectors by inner product: one small-world graph per shard, results merged.

Rows with the same vector form one class and are indexed once; a class carries only as
many of its smallest vec_ids as a result list can hold. Classes are dealt to shards by
hash, shards are built apart and written to the shared folder as flat arrays, and every
block of queries visits every shard. The best classes of all shards are then merged and
their members listed.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrangle.llm import hnsw
from quadrangle.session import cut

SHARD_ROWS = 4096
QUERY_ROWS = 512
BEAM = 160
NEAREST = 20


def _pack(vectors):
    return np.ascontiguousarray(vectors, "<f8").tobytes()


def _build(rows, radius):
    vectors = np.stack([np.frombuffer(v, "<f8") for v in rows["vector"]])
    points = hnsw.lift(vectors, radius)
    layers = hnsw.build(points)
    return pd.DataFrame(
        {
            "shard": [int(rows["shard"].iloc[0])],
            "classes": [rows["class"].astype("int64").tolist()],
            "vectors": [vectors.tobytes()],
            "nodes": [[nodes.astype("<i4").tobytes() for nodes, _ in layers]],
            "links": [[links.astype("<i4").tobytes() for _, links in layers]],
        }
    )


def _search(batches, radius, keep, size):
    """The `keep` nearest classes of one shard for each query of one block."""
    for frame in batches:
        for row in frame.itertuples(index=False):
            classes = np.asarray(row.classes, np.int64)
            vectors = np.frombuffer(row.vectors, "<f8").reshape(len(classes), -1)
            points = hnsw.lift(vectors, radius)
            layers = []
            for nodes, links in zip(row.nodes, row.links, strict=True):
                nodes = np.frombuffer(nodes, "<i4").astype(np.int64)
                layers.append((nodes, np.frombuffer(links, "<i4").astype(np.int64).reshape(len(nodes), -1)))
            asked = np.stack([np.frombuffer(v, "<f8") for v in row.query_vectors])
            found = hnsw.search(points, layers, np.c_[asked, np.zeros(len(asked))].astype(np.float32), size)
            # nearness in double precision, on the vectors as given
            score = np.where(found >= 0, (vectors[found] * asked[:, None, :]).sum(axis=2), -np.inf)
            ids = np.where(found >= 0, classes[found], np.iinfo(np.int64).max)
            order = np.lexsort((ids, -score), axis=1)[:, :keep]
            score, ids = np.take_along_axis(score, order, axis=1), np.take_along_axis(ids, order, axis=1)
            hit = np.isfinite(score)
            yield pd.DataFrame(
                {"query_id": np.repeat(np.asarray(row.query_ids, np.int64), hit.sum(axis=1)), "class": ids[hit], "score": score[hit]}
            )


def nearest(embeddings, queries, k=NEAREST, shard_rows=SHARD_ROWS, size=BEAM):
    """(query_id, rank, vec_id, score): the `k` nearest rows found for every query row.

    `queries` is a condition on `embeddings`. Nearness is the inner product in double
    precision, ties go to the smaller vec_id, and a query never finds its own vec_id.
    Rows without vec_id, and vectors that are null, empty, zero or hold a null or
    non-finite component, take no part; nor do vectors that do not have the commonest
    number of components. Of rows that share a vec_id the one with the smallest vector
    counts. With fewer than `k` candidates all that are found are listed. Other columns
    are ignored.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    usable = cut(usable.withColumn("length", length).withColumn("size", F.size("vector")))
    sizes = usable.groupBy("size").agg(F.count("*").alias("n"), F.max("length").alias("radius"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    spark = embeddings.sparkSession
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.col("size") == common["size"])
    radius = common["radius"]

    # the class id is its smallest vec_id; its next ones follow in `members`
    ranked = Window.partitionBy("vector").orderBy("vec_id")
    firsts = usable.select("vec_id", "vector", F.row_number().over(ranked).alias("nth")).where(F.col("nth") <= k + 1)
    classes = cut(firsts.groupBy("vector").agg(F.min("vec_id").alias("class"), F.sort_array(F.collect_list("vec_id")).alias("members")))
    shards = max(1, -(-classes.count() // shard_rows))
    to_bytes = F.pandas_udf(lambda column: column.map(_pack), "binary")
    packed = classes.select("class", to_bytes("vector").alias("vector"), F.pmod(F.xxhash64("class"), F.lit(shards)).cast("int").alias("shard"))
    index = cut(
        packed.groupBy("shard").applyInPandas(
            lambda rows: _build(rows, radius),
            "shard int, classes array<long>, vectors binary, nodes array<binary>, links array<binary>",
        )
    )
    asked = usable.where(queries).select(F.col("vec_id").alias("query_id"), to_bytes("vector").alias("query_vector"))
    asked = cut(asked)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    grouped = (
        asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list("query_id").alias("query_ids"), F.collect_list("query_vector").alias("query_vectors"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    visits = grouped.repartition(blocks * shards, "block", "shard").join(index, "shard")
    found = visits.select("classes", "vectors", "nodes", "links", "query_ids", "query_vectors").mapInPandas(
        lambda batches: _search(batches, radius, k + 1, size), "query_id long, class long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    listed = top.join(classes.select("class", "members"), "class").select("query_id", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        listed.where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
