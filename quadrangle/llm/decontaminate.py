"""Benchmark items inside documents: size-partitioned MinHash containment, then exact sets.

The shingle with the least hash under one of an item's hash functions lies in a document
with a probability equal to the item's containment in it, however long the document is.
So an item is signed by its `signature` least-hash shingles, one per function, and a
document is searched for those shingles alone. Items are partitioned by size: up to
`EXACT_SIZE` shingles the signature is the whole set, above it has as many functions as
the partition needs, and each partition has its own number of matches below which a
contained item falls once in ten million. Items that reach it are checked on all their
shingles.

Documents are read once per block of `BLOCK_ITEMS` items and never shuffled. A block is
sent to every task; its size is bounded by that number of items and, as items are cut
into blocks by their shingle counts too, by `BLOCK_SHINGLES`.
"""

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quadrangle.llm.textscan import bounds, buffers, grams, mix, pieces, scan
from quadrangle.session import cut

EXACT_SIZE = 32
SIGNATURE = {64: 40, 256: 48, None: 64}
BLOCK_ITEMS = 50_000
BLOCK_SHINGLES = 4_000_000
MISS = 1e-7
FILTER_BITS = 22

_U = np.uint64
_MUL = np.random.default_rng(31).integers(0, 2**62, 64, dtype=np.uint64) * _U(2) + _U(1)


def least_matches(functions, percent):
    """Matches that an item of `percent` containment misses with at most `MISS`."""
    p, below = percent / 100, 0.0
    for m in range(functions + 1):
        below += comb(functions, m) * p**m * (1 - p) ** (functions - m)
        if below > MISS:
            return max(1, m)
    return functions


def _item_sets(batches, words):
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = buffers(piece.column("text"))
            hashes, rows, _, _ = scan(data, offsets, lower=True)
            begins = bounds(rows, piece.num_rows)
            sets, lengths = [], []
            for row in range(piece.num_rows):
                own = hashes[begins[row] : begins[row + 1]]
                k = min(words, len(own))
                sets.append(np.unique(grams(own, np.zeros(len(own), np.int64), k)[0]).view(np.int64).tolist() if k else [])
                lengths.append(k)
            yield pa.record_batch(
                [piece.column("item_id"), pa.array(lengths, pa.int32()), pa.array(sets, pa.list_(pa.int64()))], ["item_id", "k", "members"]
            )


class Index:
    """Signatures of a block of items, by shingle, for one shingle length."""

    def __init__(self, items, percent):
        self.percent = percent
        self.ids = np.array([i for i, _ in items], np.int64)
        self.sets = [np.asarray(s, np.int64).view(np.uint64) for _, s in items]
        shingles, owners, self.least = [], [], np.zeros(len(items), np.int64)
        self.times = []
        for n, own in enumerate(self.sets):
            if len(own) <= EXACT_SIZE:
                picked, times = own, np.ones(len(own), np.int64)
                self.least[n] = -(-percent * len(own) // 100)
            else:
                size = next(v for top, v in SIGNATURE.items() if top is None or len(own) <= top)
                hashed = own[:, None] * _MUL[:size]
                picked, times = np.unique(own[(hashed ^ (hashed >> _U(29))).argmin(axis=0)], return_counts=True)
                self.least[n] = least_matches(size, percent)
            shingles.append(picked)
            owners.append(np.full(len(picked), n))
            self.times.append(times)
        shingles, owners = np.concatenate(shingles), np.concatenate(owners)
        times = np.concatenate(self.times)
        order = np.argsort(shingles, kind="stable")
        self.owners, self.times = owners[order], times[order]
        self.shingles, self.first = np.unique(shingles[order], return_index=True)
        self.first = np.r_[self.first, len(order)]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._low(self.shingles)] = True

    @staticmethod
    def _low(values):
        return (values & _U((1 << FILTER_BITS) - 1)).astype(np.int64)

    def found(self, values, rows, n):
        """(row, item id, contained, size) of items contained in the texts' shingles."""
        maybe = np.flatnonzero(self.filter[self._low(values)])
        at = np.minimum(np.searchsorted(self.shingles, values[maybe]), len(self.shingles) - 1)
        hit = self.shingles[at] == values[maybe]
        pairs = np.unique(np.stack([rows[maybe[hit]], at[hit]]), axis=1)
        ends = bounds(rows, n)
        out = []
        for row in np.unique(pairs[0]):
            own = pairs[1][pairs[0] == row]
            spans = [slice(self.first[a], self.first[a + 1]) for a in own]
            items = np.concatenate([self.owners[s] for s in spans])
            matches = np.bincount(items, np.concatenate([self.times[s] for s in spans]), len(self.ids))
            likely = np.flatnonzero((matches >= self.least) & (matches > 0))
            if len(likely):
                members = np.unique(values[ends[row] : ends[row + 1]])
                for item in likely:
                    both = int(np.isin(self.sets[item], members, assume_unique=True).sum())
                    if 100 * both >= self.percent * len(self.sets[item]):
                        out.append((int(row), int(self.ids[item]), both, len(self.sets[item])))
        return out


def _search(batches, indexes):
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = buffers(piece.column("text"))
            hashes, rows, _, _ = scan(data, offsets, lower=True)
            found = [[] for _ in range(piece.num_rows)]
            for k, index in indexes.value.items():
                values, at = grams(hashes, rows, k)
                for row, item, both, size in index.found(values, rows[at], piece.num_rows):
                    found[row].append({"item_id": item, "both": both, "size": size})
            found = [sorted(f, key=lambda x: x["item_id"]) for f in found]
            yield pa.record_batch([*piece.columns, pa.array(found, ITEMS_ARROW)], [*piece.schema.names, "items"])


ITEMS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("both", pa.int64()), ("size", pa.int64())]))
ITEMS = "array<struct<item_id:long,both:long,size:long>>"


def _blocks(items):
    """Items of one block at a time, as {k: [(item_id, shingles)]}."""
    sized = items.select("item_id", F.size("members").alias("size"))
    total = sized.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    blocks = max(1, -(-total.n // BLOCK_ITEMS), -(-(total["size"] or 0) // BLOCK_SHINGLES))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "members"), F.lit(blocks)) == block).collect()
        by_length = {}
        for row in sorted(rows, key=lambda r: (r.item_id, r.members)):
            by_length.setdefault(row.k, []).append((row.item_id, row.members))
        yield by_length


def contained_items(docs, benchmark, words=5, percent=80):
    """Every column and row of `docs`, and `items`: the benchmark items contained in it.

    An item is contained when the document holds at least `percent` per cent of its
    distinct `words`-word shingles (of an item with fewer words, the whole item), words
    being cut at blanks and lower-cased in ASCII. `items` is an array of (item_id, both,
    size) ordered by item_id, empty where there are none, as for null and empty texts.
    Items without id or words take no part; items that share an id are looked for each
    by itself. A column of `docs` named `items` is replaced."""
    spark = docs.sparkSession
    sets = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL")
    sets = cut(sets.mapInArrow(lambda batches: _item_sets(batches, words), "item_id long, k int, members array<long>").where("k > 0"))
    docs = docs.drop("items")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", items {ITEMS}"
    out = docs.withColumn("items", F.array().cast(ITEMS))
    for number, block in enumerate(_blocks(sets)):
        if not block:
            continue
        indexes = spark.sparkContext.broadcast({k: Index(items, percent) for k, items in block.items()})
        if number == 0:
            out = docs.mapInArrow(lambda batches, indexes=indexes: _search(batches, indexes), shape)
        else:
            out = out.withColumnRenamed("items", "earlier_items").mapInArrow(
                lambda batches, indexes=indexes: _search(batches, indexes), shape.removesuffix(f"items {ITEMS}") + f"earlier_items {ITEMS}, items {ITEMS}"
            ).withColumn("items", F.array_sort(F.concat("earlier_items", "items"))).drop("earlier_items")
    return out


def contamination(docs, benchmark, words=5, percent=80):
    """(doc_id, contaminated, n_items, best_item, best_share) for every row of `docs`.

    `best_item` is the item with the largest share of its shingles in the document, the
    smallest id among equals; null where nothing is contained."""
    found = contained_items(docs.select("doc_id", "text"), benchmark, words, percent)
    share = F.transform("items", lambda i: F.struct((i.both / i["size"]).alias("share"), (-i.item_id).alias("minus"), ))
    best = F.array_max(share)
    return found.select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_items"),
        (-best.minus).alias("best_item"),
        best.share.alias("best_share"),
    )


CONTAMINATION_SQL = """
WITH texts AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'item', item_id, text FROM benchmark
), worded AS (
  SELECT kind, id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM texts
), shingled AS (
  SELECT DISTINCT kind, id, shingle FROM (
    SELECT kind, id, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
    FROM worded)
), sizes AS (
  SELECT id, count(*) AS n FROM shingled WHERE kind = 'item' GROUP BY id
), shares AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_both, any_value(s.n) AS n
  FROM shingled i JOIN shingled d ON d.kind = 'doc' AND i.kind = 'item' AND d.shingle = i.shingle JOIN sizes s ON s.id = i.id
  GROUP BY d.id, i.id HAVING 100 * count(*) >= 80 * any_value(s.n)
)
SELECT doc_id, count(item_id) > 0 AS contaminated, count(item_id) AS n_items,
       min(item_id) FILTER (place = 1) AS best_item, max(n_both / n) AS best_share
FROM (SELECT d.doc_id, s.item_id, s.n_both, s.n,
             row_number() OVER (PARTITION BY d.doc_id ORDER BY s.n_both / s.n DESC NULLS LAST, s.item_id) AS place
      FROM documents d LEFT JOIN shares s ON d.doc_id = s.doc_id)
GROUP BY doc_id
"""
