"""Audit of how text filters overlap, over every order of applying them.

A document is reduced to the set of filters it fails, and those sets are counted per part
of the corpus. The states of a run are the subsets of filters applied so far; applying one
more filter is an edge, and what it removes depends on its two ends alone, however the
first was reached. Orders reaching a state and orders leaving it are counted forward and
backward over the lattice: an edge is walked by their product, which weights its removals
in the filter's Shapley sum. The steps of each order are read off the same edges.
"""

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
BLANKS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)


def own_failures(docs):
    """doc_id, part, a digest of the text, and the failed filters among A to D as bits."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split("text", BLANKS), "")
    cut_up = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text")).withColumn("words", words)
    n_words, capitals = F.size("words"), F.char_length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = [
        n_words < MIN_WORDS,
        100 * F.size(F.array_distinct("words")).cast("long") < 50 * n_words.cast("long"),
        100 * capitals.cast("long") > 3 * F.char_length("text").cast("long"),
        F.col("text").rlike(MARKS),
    ]
    bits = sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))
    return cut_up.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("fails"))


def failure_sets(docs, labels):
    """(part, fails, n, good, toxic): documents of every part by the set of filters they fail.

    Filter E fails on a text that a smaller doc_id has too, anywhere in the table. Copies
    are counted per text before they meet, so a text that fills the table is a few rows.
    Without doc_id a document neither fails E nor makes another fail it."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = own_failures(docs).join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    kind = ["digest", "fails", "part", "good", "toxic"]
    copies = marked.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    named = F.col("doc_id").isNotNull()
    texts = copies.groupBy(*kind).agg(
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
        F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("low"),
    )
    # a text has one row per part and label by now
    least = F.min("low.doc_id").over(Window.partitionBy("digest"))
    first = F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(0)
    halves = F.array(
        F.struct(F.col("fails"), (F.col("unnamed") + F.col("first")).alias("n")),
        F.struct((F.col("fails") + 16).alias("fails"), (F.col("named") - F.col("first")).alias("n")),
    )
    split = texts.withColumn("least", least).withColumn("first", first).select("part", "good", "toxic", F.explode(halves).alias("half"))
    n = F.col("half.n")
    return split.groupBy("part", F.col("half.fails").alias("fails")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic")
    )


def path_counts(k):
    """Orders that reach each subset of `k` filters from none, and orders that lead from it to all."""
    states = range(1 << k)
    reaching, leaving = [0] * len(states), [0] * len(states)
    reaching[0] = leaving[-1] = 1
    for state in states[1:]:
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(k) if state >> f & 1)
    for state in states[-2::-1]:
        leaving[state] = sum(leaving[state | 1 << f] for f in range(k) if not state >> f & 1)
    return reaching, leaving


def edges(found, k):
    """{(state, filter): (removed, good lost, toxic lost)} and documents kept per state.

    `found`: {failed set: (n, good, toxic)}."""
    kept = [
        [sum(row[i] for fails, row in found.items() if not fails & state) for i in range(3)] for state in range(1 << k)
    ]
    lost = {
        (state, f): tuple(a - b for a, b in zip(kept[state], kept[state | 1 << f], strict=True))
        for state in range(1 << k) for f in range(k) if not state >> f & 1
    }
    return lost, [row[0] for row in kept]


def order_rows(found, filters=FILTERS):
    """(filter_order, step, counts...) of every order and step, from one part's failed sets."""
    k = len(filters)
    lost, kept = edges(found, k)
    reaching, leaving = path_counts(k)
    shapley = [0] * k
    for (state, f), (removed, _, _) in lost.items():
        shapley[f] += reaching[state] * leaving[state | 1 << f] * removed
    failing = [sum(row[0] for fails, row in found.items() if fails >> f & 1) for f in range(k)]
    alone = [found.get(1 << f, (0,))[0] for f in range(k)]
    for order in permutations(range(k)):
        name, state = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            removed, good, toxic = lost[state, f]
            state |= 1 << f
            yield name, step, kept[state], removed, failing[f] - removed, alone[f], good, toxic, shapley[f]


def _audited(batches):
    for batch in batches:
        for row in batch.to_pylist():
            found = {x["fails"]: (x["n"], x["good"], x["toxic"]) for x in row["found"]}
            columns = list(zip(*order_rows(found), strict=True))
            types = [pa.string(), pa.int32(), *[pa.int64()] * len(COUNTS)]
            arrays = [pa.array([row["part"]] * len(columns[0]), pa.string())]
            arrays += [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            yield pa.record_batch(arrays, ["part", "filter_order", "step", *COUNTS])


def filter_interactions(docs, labels):
    """(part, filter_order, step, counts): every step of every order of the five filters.

    A: under 200 words; B: fewer than half of the words distinct; C: over 3 % capitals;
    D: one of `#$%&*|`; E: a smaller doc_id has the same text. Parts are the values of
    `lang`, null as the empty string; a null text is empty (it fails A, and E as any
    other). Per part all 600 rows are there, zeros included; an empty table has no part.
    Repeated rows count each; rows that share the smallest doc_id of a text do not fail E.
    A document labelled more than once is good or toxic if any of its labels says so, and
    neither without a label. Further columns of either table are not read."""
    sets = failure_sets(docs, labels)
    per_part = sets.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("found"))
    return per_part.mapInArrow(_audited, SCHEMA)


INTERACTIONS_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT doc_id, part,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 3 * length(body) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END) AS fails
  FROM doc
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), sets AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, fails
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS own, CAST(list_sum(bits[1:step]) AS INTEGER) - bits[step] AS earlier
  FROM orders, range(1, 6) t(step)
), walked AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN fails & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & earlier = 0 AND fails & own <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & earlier <> 0 AND fails & own <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & earlier = 0 AND fails & own <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & earlier = 0 AND fails & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM walked
"""
