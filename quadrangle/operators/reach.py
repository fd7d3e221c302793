"""Bounded breadth-first reach over a link table."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from quadrangle.constants import MAX_CRAWL_DEPTH
from quadrangle.functions.urls import file_type
from quadrangle.session import cut, scratch_path

HOT_SHARE = 10_000
HOT_MINIMUM = 1_000_000


def spread_hot_sources(edges, hot_minimum=HOT_MINIMUM):
    """Split the outgoing links of hub pages into slots.

    A source is hot when it holds more than one in `HOT_SHARE` of all links (and at
    least `hot_minimum`), so there are fewer than `HOT_SHARE` hot sources and the
    slots given out in total stay below twice that: both are safe to broadcast.
    Returns the links with a `slot` column, and the table (src, slots) of hot sources;
    without hot sources the links as they are, and None.
    """
    total = edges.count()
    per_slot = max(total // HOT_SHARE, hot_minimum)
    if total <= per_slot:
        return edges, None
    hot = cut(
        edges.groupBy("src")
        .agg(F.count(F.lit(1)).alias("_links"))
        .filter(F.col("_links") > per_slot)
        .select("src", F.ceil(F.col("_links") / per_slot).cast("int").alias("slots"))
    )
    if hot.isEmpty():
        return edges, None
    slot = F.pmod(F.xxhash64("dst"), F.coalesce("slots", F.lit(1))).cast("int")
    return edges.join(F.broadcast(hot), "src", "left").withColumn("slot", slot).drop("slots"), hot


@contextmanager
def _laid_out(links, columns):
    """The links bucketed by the columns every round joins on.

    They are shuffled once here; the rounds then move only the frontier to them. The
    catalog entry goes away at the end.
    """
    spark = links.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"links_{uuid.uuid4().hex}"
    (
        links.repartition(buckets, *columns)
        .write.format("parquet")
        .bucketBy(buckets, *columns)
        .option("path", scratch_path(spark, "links"))
        .saveAsTable(name)
    )
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _follow_links(sources, links, hot):
    """Links leaving `sources`; a hot source meets its links slot by slot."""
    if hot is None:
        return sources.join(links, "src")
    every_slot = F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1))
    slotted = sources.join(F.broadcast(hot), "src", "left").withColumn("slot", every_slot)
    return slotted.drop("slots").join(links, ["src", "slot"])


def _next_frontier(frontier, visited, links, hot, groups, follow):
    """URLs one link away from the frontier's pages that no earlier round has seen."""
    keys = [*groups, "url"]
    sources = frontier.filter(file_type(F.col("url")) == "html").select(
        *groups, F.col("url").alias("src")
    )
    steps = _follow_links(sources, links, hot)
    if follow is not None:
        steps = steps.filter(follow)
    found = steps.select(*groups, F.col("dst").alias("url")).distinct()
    return found.join(visited.select(*keys), keys, "left_anti")


def reach(edges, seeds, groups=(), max_depth=MAX_CRAWL_DEPTH, follow=None, hot_minimum=HOT_MINIMUM):
    """Every URL within `max_depth` links of a seed, once per group, at its smallest depth.

    `edges`: src, dst and whatever `follow` looks at. `seeds`: the group columns and
    `url`. All groups (crawls) walk together. Only URLs of type html are expanded;
    `follow` is an optional condition on a link, which may use the group columns.
    """
    frontier = cut(seeds.select(*groups, "url").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    slotted, hot = spread_hot_sources(edges, hot_minimum)
    with _laid_out(slotted, ["src"] if hot is None else ["src", "slot"]) as links:
        for depth in range(1, max_depth + 1):
            found = _next_frontier(frontier, visited, links, hot, groups, follow)
            frontier = cut(found.withColumn("depth", F.lit(depth)))
            if frontier.isEmpty():
                break
            visited = visited.unionByName(frontier)
    return visited
