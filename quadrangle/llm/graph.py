"""Connected components of an edge table, in rounds of shuffles."""

from pyspark.sql import functions as F

from quadrangle.session import cut


def _mark(edges):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges):
    """(u, v): every node that is not the smallest of its component, and that smallest.

    `edges` has columns `u` and `v`, in any order and number. Every round hangs each
    node's larger neighbours, then its smaller ones, on the smallest node it knows; the
    number of rounds grows with the logarithm of the longest path. Rounds are written to
    the shared folder, and a hub is split by adaptive execution as any hot join key."""
    e = cut(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("v", "u"))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").where("u <> v")
        e = cut(small.distinct())
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e
