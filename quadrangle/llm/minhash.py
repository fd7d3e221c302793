"""Near duplicates by an inverted join over MinHash signature coordinates.

Texts with the same shingle set form one class, found by grouping, whatever its size.
Classes are posted under (coordinate, value) pairs of their signature, rarest first: two
signatures that agree in at least `matches` of `COORDINATES` places agree in one of the
first `COORDINATES - matches + 1` in that order, so the rest is skipped, and pairs met in
one class only need no posting either. `matches` is set so that two texts at the wanted
similarity fall below it once in ten million.

A posting list of n classes is not turned into n * n pairs. Each list compares its members
with one pivot o, the member that shares most pairs with others, on their full shingle
sets. What is left are pairs of which at least one member a is not linked to o. They are
told by what sets them apart from o: with D(x) the symmetric difference of x and o, a
linked b must have over (1 - u) / 2 of D(b) in common with D(a), u = (1 - t) / (1 + t) for
similarity t, and D(a) and D(b) differ in at most |a| (1 - t) / t places. So an inverted
join over the rarest elements of the differences finds them, and copies that were edited
apart from each other never meet. Pairs found so are kept if they reach the match count,
and confirmed on their full sets. No link that could change a component is left out.
"""

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quadrangle.llm import countmin
from quadrangle.llm.graph import components
from quadrangle.llm.textscan import bounds, buffers, grams, mix, pieces, scan
from quadrangle.session import cut

COORDINATES = 64
MISS = 1e-7
CODE_BITS = 57

_U = np.uint64
_rng = np.random.default_rng(77)
_XOR = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_MUL = _rng.integers(0, 2**62, COORDINATES, dtype=np.uint64) * _U(2) + _U(1)

SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, sig array<long>"


def matches_for(percent, coordinates=COORDINATES):
    """Largest match count that a pair of `percent` similarity misses with at most `MISS`."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if below > MISS:
            return max(1, m)
    return coordinates


def shingle_sets(batch, words):
    """For each row the sorted distinct shingle hashes of its text, lower-cased in ASCII."""
    data, offsets = buffers(batch.column("text"))
    hashes, rows, _, _ = scan(data, offsets, lower=True)
    begins = bounds(rows, batch.num_rows)
    values, at = grams(hashes, rows, words)
    ends = bounds(rows[at], batch.num_rows)
    for row in range(batch.num_rows):
        n = begins[row + 1] - begins[row]
        if n >= words:
            yield np.unique(values[ends[row] : ends[row + 1]])
        elif n:
            short = hashes[begins[row] : begins[row + 1]]
            yield mix(grams(short, np.zeros(n, np.int64), n)[0] + _U(n) * _XOR[0])
        else:
            yield np.zeros(0, np.uint64)


def _sign(batches, words):
    for batch in batches:
        for piece in pieces(batch):
            count, k1, k2, signatures = [], [], [], []
            for own in shingle_sets(piece, words):
                count.append(len(own))
                k1.append(int(own.sum().view(np.int64)))
                k2.append(int(mix(own + _U(1)).sum().view(np.int64)))
                if not len(own):
                    signatures.append(None)
                    continue
                low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
                for lo in range(0, len(own), 1 << 16):
                    part = (own[lo : lo + (1 << 16), None] ^ _XOR) * _MUL
                    low = np.minimum(low, (part ^ (part >> _U(32))).min(axis=0))
                signatures.append(low.view(np.int64).tolist())
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(count, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(signatures, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "k1", "k2", "sig"],
            )


def _codes(signatures):
    """(coordinate, value) pairs of a list of signatures as single numbers."""
    values = np.asarray(signatures.flatten()).view(np.uint64).reshape(len(signatures), COORDINATES)
    return (values >> _U(64 - CODE_BITS)) | (np.arange(COORDINATES, dtype=np.uint64) << _U(CODE_BITS))


def _code_batches(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            yield part, _codes(part.column("sig"))


def _touched(batches, cells):
    own = countmin.Partial(cells)
    for _, codes in _code_batches(batches):
        yield from own.add(codes.ravel())
    yield from own.flush()


def _posted(batches, sketch):
    """(post, rep) for the pairs that may be met in several classes."""
    for part, codes in _code_batches(batches):
        rows, at = np.nonzero(countmin.repeated(sketch.value, codes.ravel()).reshape(codes.shape))
        yield pa.record_batch([pa.array(codes[rows, at].view(np.int64)), part.column("rep").take(pa.array(rows))], ["post", "rep"])


def _sets(batches, words, sketch):
    """(rep, members) of documents that may be named in the sketch."""
    for batch in batches:
        keys = np.asarray(batch.column("doc_id")).view(np.uint64)
        batch = batch.filter(pa.array(countmin.repeated(sketch.value, keys)))
        for piece in pieces(batch):
            sets = [own.view(np.int64).tolist() for own in shingle_sets(piece, words)]
            yield pa.record_batch([piece.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["rep", "members"])


def _compared(pairs, members):
    """Pairs (u, v) with the full sets of both, and the size of their intersection."""
    return (
        pairs.join(members.select(F.col("rep").alias("u"), F.col("members").alias("of_u")), "u")
        .join(members.select(F.col("rep").alias("v"), F.col("members").alias("of_v")), "v")
        .withColumn("both", F.size(F.array_intersect("of_u", "of_v")))
    )


def near_duplicates(docs, words=5, percent=80):
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Documents are linked when the sets of their `words`-word shingles (the whole text as
    one where it has fewer words) have 100 * intersection >= percent * union.
    `component_id` is the smallest doc_id reachable over links, `kept` whether the row
    has it. A null, empty or blank text has no shingles and is linked with nothing. Rows
    that share a doc_id are one document: linked, and kept or dropped together. A row
    without doc_id takes no part and is kept, with a null component. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    matches = matches_for(percent)
    prefix = COORDINATES - matches + 1
    signed = cut(docs.mapInArrow(lambda batches: _sign(batches, words), SIGNED))
    known = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = cut(known.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")))

    # Any order of the pairs serves the prefix, if all use the same: by how many classes
    # have them, so that frequent pairs are hardly ever posted
    cells = countmin.cells_for(classes.count() * COORDINATES)
    signatures = classes.select("rep", "sig")
    sketch = spark.sparkContext.broadcast(
        countmin.merged(signatures.mapInArrow(lambda batches: _touched(batches, cells), countmin.PARTIAL_SCHEMA), cells)
    )
    tokens = signatures.mapInArrow(lambda batches: _posted(batches, sketch), "post long, rep long").distinct()
    common = tokens.groupBy("post").count().where("count > 1")
    shared = tokens.join(common, "post").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("count", "post"))).alias("by_count"), F.sum("count").alias("weight")
    )
    # pairs of one class alone come first in the order, so what is left of the prefix is short
    left = F.greatest(F.lit(0), F.size("by_count") - (COORDINATES - prefix))
    posts = cut(shared.select(F.explode(F.slice("by_count", F.lit(1), left)).alias("pair"), "rep", "weight").select("pair.post", "rep", "weight"))
    several = posts.groupBy("post").agg(F.count("*").alias("n"), F.max(F.struct("weight", -F.col("rep"))).alias("top")).where("n > 1")
    live = cut(posts.join(several.select("post", (-F.col("top.col2")).alias("pivot")), "post").select("post", "rep", "pivot"))

    wanted = countmin.membership(live.select("rep").distinct())
    members = cut(docs.where("doc_id IS NOT NULL").mapInArrow(lambda batches: _sets(batches, words, wanted), "rep long, members array<long>"))

    def likely(pairs):
        agreeing = F.size(F.filter(F.zip_with("a.sig", "b.sig", lambda x, y: x == y), lambda same: same))
        return (
            pairs.join(signatures.alias("a"), pairs.u == F.col("a.rep"))
            .join(signatures.alias("b"), pairs.v == F.col("b.rep"))
            .where(agreeing >= matches)
            .select("u", "v").distinct()
        )

    union = F.size("of_u") + F.size("of_v") - F.col("both")
    linked = 100 * F.col("both") >= percent * union

    # documents whose rows fall into several classes tie those classes together
    ties = known.join(classes, ["k1", "k2", "n_shingles"]).select("doc_id", "rep").distinct()
    tied = ties.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("top")).where("u <> top").drop("top")
    edges = ties.join(tied, "doc_id").select("u", F.col("rep").alias("v"))

    pairs = live.where("rep <> pivot").select(F.col("pivot").alias("u"), F.col("rep").alias("v")).distinct()
    apart = F.array_union(F.array_except("of_u", "of_v"), F.array_except("of_v", "of_u"))
    related = cut(
        _compared(pairs, members).select("u", "v", linked.alias("linked"), F.size("of_v").alias("n"), apart.alias("apart"))
    )
    edges = edges.union(related.where("linked").select("u", "v"))
    labels = components(edges)

    def label(rows, column, name):
        own = labels.select(F.col("u").alias(column), F.col("v").alias("label"))
        return rows.join(own, column, "left").withColumn(name, F.coalesce("label", column)).drop("label")

    # pairs of members of one pivot that are not linked over it, by what sets them apart from it
    rest = label(label(related, "u", "home"), "v", "own")
    open_ = rest.where("home <> own").select("u").distinct()
    rest = cut(rest.join(open_, "u", "left_semi"))
    t = percent / 100
    most = F.floor(F.col("n") * ((1 - t) / t))
    half = F.floor(F.size("apart") * (1 / (1 + t)))  # (1 + u) / 2 of the difference
    length = F.least(F.size("apart"), F.when(F.col("linked"), F.least(most, half)).otherwise(most) + 2)
    sizes = ["u", "v", "own", "home", "n", "length", "size"]
    elements = rest.withColumns({"length": length, "size": F.size("apart")}).select(*sizes, F.explode("apart").alias("e"))
    often = elements.groupBy("u", "e").count().where("count > 1")
    ordered = elements.join(often, ["u", "e"]).groupBy(*sizes).agg(F.sort_array(F.collect_list(F.struct("count", "e"))).alias("by_count"))
    first = F.greatest(F.lit(0), F.col("length") - (F.col("size") - F.size("by_count"))).cast("int")
    pairs_of = ordered.select("u", "v", "own", "home", "n", "size", F.size("by_count").alias("shared"), F.posexplode(F.slice("by_count", F.lit(1), first)).alias("at", "pair"))
    marks = cut(pairs_of.select("u", "v", "own", "home", "n", "size", (F.col("shared") - F.col("at")).alias("left"), "pair.e"))
    # linked members have this many places of their differences in common; where two first
    # meet, no more than what is left of either's list can follow
    common = F.expr(f"(a.size + b.size - {(1 - t) / (1 + t)!r}D * (a.n + b.n)) / 2 - 1e-6D")
    meet = (
        marks.where("own <> home").alias("a")
        .join(marks.alias("b"), ["u", "e"])
        .where(F.expr("a.own <> b.own") & (F.least("a.left", "b.left") >= common))
        .select(F.least("a.v", "b.v").alias("u"), F.greatest("a.v", "b.v").alias("v"))
    )
    more = _compared(likely(meet.distinct()), members).where(linked).select("u", "v")
    labels = components(labels.union(more))

    roots = classes.join(labels, classes.rep == labels.u, "left").select("k1", "k2", "n_shingles", F.coalesce("v", "rep").alias("root"))
    return signed.join(roots, ["k1", "k2", "n_shingles"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("root", "doc_id"), F.lit(True)).alias("kept"),
    )
