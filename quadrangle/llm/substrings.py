"""Removal of word sequences that occur earlier in the corpus, found by a count-min prefilter.

Every window of `width` consecutive words is a candidate. The sketch counts one anchor
per window, the smallest hash of the `gram`-word runs in it: equal windows have equal
anchors at equal offsets, so an anchor seen once proves its windows unique, and there
are several times fewer anchors than windows. A second pass sends only windows whose
anchor may be repeated; those are compared exactly, so a collision costs work, never a
word. They travel once, as one row for the windows that share an anchor, dealt and
sorted by anchor; the first row of each window is then known as the rows go by. A row
whose windows all start earlier in the same piece of input needs no comparison, so a
passage common to very many documents makes one row a piece to compare.

Whole texts that occur more than once are told by a first sketch over text hashes. Of
those the smallest doc_id stands for its copies: every window of a copy starts earlier
there, so a copy of at least `width` words loses all of them and sends no windows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrangle.llm import countmin
from quadrangle.llm.textscan import bounds, buffers, grams, mix, pieces, scan
from quadrangle.session import cut

WIDTH = 20
GRAM = 8
BYTES_PER_ANCHOR = 40
NO_ID = 2**63 - 1
RUNS_SCHEMA = "anchor long, doc long, text_key long, start int, many int, windows array<long>"
LATER_SCHEMA = "doc long, text_key long, start int, many int, anchor long, window long"
HELD_WINDOWS = 1 << 18
RUN_LIST = pa.list_(pa.struct([("start", pa.int32()), ("many", pa.int32())]))

TEXT_CHECKS = ("crc32(text) AS check", "octet_length(text) AS size")

_U = np.uint64


def _smallest(values, span):
    """Smallest value and its leftmost index in every run of `span` values."""
    best, index, size = values, np.arange(len(values)), 1
    while size < span:
        step = min(size, span - size)
        left, right = best[:-step], best[step:]
        take = right < left
        index = np.where(take, index[step:], index[:-step])
        best = np.where(take, right, left)
        size += step
    return best, index


def _windows(batch, width, gram):
    """Hash, row, start and anchor (value, place) of every window of a batch's texts."""
    data, offsets = buffers(batch.column("text"))
    hashes, rows, first, last = scan(data, offsets)
    begins = bounds(rows, batch.num_rows)
    whole, at = grams(hashes, rows, width)
    part = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    values, where = grams(hashes, rows, gram)
    part[where] = values
    if len(at):
        best, place = _smallest(part, width - gram + 1)
        best, place = best[at], place[at]
    else:
        best, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return whole, rows[at], at - begins[rows[at]], best, place


def _anchors(best, place):
    """Each anchor once per place it has in the text."""
    new = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
    return best[new], np.cumsum(new) - 1


def _sketch(over, keys, cells):
    """Merge the sketches of `keys(batch)` over all partitions; `over` runs a function of
    batches on a table."""

    def partial(batches):
        own = countmin.Partial(cells)
        for batch in batches:
            for piece in pieces(batch):
                yield from own.add(keys(piece))
        yield from own.flush()

    return countmin.merged(over(partial, countmin.PARTIAL_SCHEMA), cells)


def _text_keys(batch):
    return mix(np.asarray(batch.column("text_key")).view(np.uint64))


def _once(batches, sketch):
    """Rows whose text is certainly the only one of its kind."""
    for batch in batches:
        yield batch.filter(pa.array(~countmin.repeated(sketch, _text_keys(batch))))


def _keyed(docs):
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )


def distinct_texts(docs):
    """A function that runs another one, of batches of (doc, text, text_key), on the
    smallest doc_id of every different text; and the bytes of all texts.

    Texts seen once by the sketch are read where they lie; only possible copies are
    shuffled, by their checksums, and written down."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    size = keyed.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    sketch = spark.sparkContext.broadcast(_sketch(keyed.select("text_key", F.lit("").alias("text")).mapInArrow, _text_keys, countmin.cells_for(size.n)))
    several = keyed.mapInArrow(
        lambda batches: (b.filter(pa.array(countmin.repeated(sketch.value, _text_keys(b)))) for b in batches), keyed.schema
    )
    # keep one text per key: identical texts make min_by's choice immaterial
    firsts = cut(
        several.selectExpr("*", *TEXT_CHECKS)
        .groupBy("text_key", "check", "size")
        .agg(F.min("doc").alias("doc"), F.first("text").alias("text"))
        .select("doc", "text", "text_key")
    )

    def over(function, schema):
        single = keyed.mapInArrow(lambda batches: function(_once(batches, sketch.value)), schema)
        return single.unionByName(firsts.mapInArrow(function, schema))

    return over, size.bytes or 0


def repeated_windows(docs, width=WIDTH, gram=GRAM, held=HELD_WINDOWS):
    """(doc, text_key, starts): windows that occur earlier, per distinct text, as the start
    of each unbroken run of them and how many it has."""
    spark = docs.sparkSession
    over, size = distinct_texts(docs)

    def anchors(batch):
        _, _, _, best, place = _windows(batch, width, gram)
        return _anchors(best, place)[0]

    cells = countmin.cells_for(size // BYTES_PER_ANCHOR)
    sketch = spark.sparkContext.broadcast(_sketch(over, anchors, cells))

    def suspects(batches):
        for batch in batches:
            for piece in pieces(batch):
                yield _runs(piece, lambda values: countmin.repeated(sketch.value, values), width, gram)

    found = over(suspects, RUNS_SCHEMA)
    place = ["doc", "text_key", "start"]
    # equal windows share their anchor: each meets its like in one partition
    sent = found.repartition("anchor").sortWithinPartitions("anchor", *place)
    seen = cut(sent.mapInArrow(lambda batches: _later(batches, held), LATER_SCHEMA))
    late = seen.where("window IS NULL").select(*place, "many")
    # windows of anchors with very many different ones are sent on by themselves
    order = Window.partitionBy("anchor", "window").orderBy(*place)
    more = seen.where("window IS NOT NULL").withColumn("nth", F.row_number().over(order)).where("nth > 1")
    return late.unionByName(more.select(*place, "many")).groupBy("doc", "text_key").agg(F.collect_list(F.struct("start", "many")).alias("starts"))


def _first_of(*keys):
    """For rows in order: whether each is the first that holds its keys."""
    order = np.lexsort((np.arange(len(keys[0])), *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _runs(piece, repeated, width, gram):
    """The windows of a piece whose anchor may be repeated, a row for those that share one.

    `windows` holds their hashes; it is null, and the row spread by its place instead of its
    anchor, where each starts earlier in this piece."""
    whole, rows, starts, best, place = _windows(piece, width, gram)
    values, back = _anchors(best, place)
    hit = repeated(values)[back] if len(values) else np.zeros(0, bool)
    whole, rows, starts, back = whole[hit], rows[hit], starts[hit], back[hit]
    anchor = values[back] if len(values) else np.zeros(0, np.uint64)
    doc, key = (np.asarray(piece.column(c)) for c in ("doc", "text_key"))
    new = np.r_[True, (back[1:] != back[:-1]) | (rows[1:] != rows[:-1])] if len(back) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    # a window's first place in the piece, by doc_id and text
    order = np.lexsort((starts, key[rows], doc[rows]))
    first = np.zeros(len(order), bool)
    first[order[_first_of(whole[order], anchor[order])]] = True
    sure = np.add.reduceat(first, head) == 0 if len(head) else np.zeros(0, bool)
    size = np.diff(np.r_[head, len(back)])
    ends = np.r_[0, np.cumsum(np.where(sure, 0, size))].astype(np.int32)
    windows = pa.ListArray.from_arrays(
        pa.array(ends), pa.array(whole[np.repeat(~sure, size)].view(np.int64)), mask=pa.array(sure) if len(sure) else None
    )
    spread = mix(doc[rows[head]].view(np.uint64) ^ mix(key[rows[head]].view(np.uint64) + starts[head].astype(np.uint64)))
    dealt = np.where(sure, spread, anchor[head]).view(np.int64)
    columns = [pa.array(dealt), pa.array(doc[rows[head]]), pa.array(key[rows[head]]), pa.array(starts[head].astype(np.int32)), pa.array(size.astype(np.int32)), windows]
    return pa.record_batch(columns, ["anchor", "doc", "text_key", "start", "many", "windows"])


def _later(batches, limit=HELD_WINDOWS):
    """Runs of windows that are not the first of their kind; rows come by anchor and place.

    Held from batch to batch are different windows of the last anchor alone, up to `limit`
    of them and one batch's. Beyond that, a window not held comes with its hash, undecided."""
    last, held = None, np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        anchors, starts, many = (np.asarray(batch.column(c)) for c in ("anchor", "start", "many"))
        lists = batch.column("windows")
        sure = np.asarray(lists.is_null())
        size = np.where(sure, 0, many)
        windows, own = np.asarray(lists.flatten()), np.repeat(np.arange(len(many)), size)
        of = anchors[own]
        old = held if len(of) and last == of[0] else held[:0]
        first = _first_of(np.r_[old, windows], np.r_[np.repeat(of[:1], len(old)), of])[len(old) :]
        undecided = first & (of == of[0]) if len(of) and len(old) >= limit else np.zeros(len(of), bool)
        if len(of):
            tail = first & (of == of[-1]) & ~undecided
            held = np.r_[old if of[-1] == of[0] else old[:0], windows[tail]]
            last = of[-1]
        # later windows in unbroken runs, those of rows that needed no comparison as they are
        at = starts[own] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        late = np.flatnonzero(~first)
        new = np.r_[True, (np.diff(late) != 1) | (np.diff(own[late]) != 0)] if len(late) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        rows = np.r_[own[late[begin]], np.flatnonzero(sure), own[undecided]]
        hashes = np.r_[np.zeros(len(rows) - undecided.sum(), np.int64), windows[undecided]]
        decided = np.arange(len(rows)) < len(rows) - undecided.sum()
        yield pa.record_batch(
            [
                batch.column("doc").take(pa.array(rows)), batch.column("text_key").take(pa.array(rows)),
                pa.array(np.r_[at[late[begin]], starts[sure], at[undecided]].astype(np.int32)),
                pa.array(np.r_[np.diff(np.r_[begin, len(late)]), many[sure], np.ones(undecided.sum())].astype(np.int32)),
                batch.column("anchor").take(pa.array(rows)), pa.array(hashes, mask=decided),
            ],
            ["doc", "text_key", "start", "many", "anchor", "window"],
        )


def _removed(starts, many, n, width):
    """Mask of words covered by runs of `many` windows that begin at `starts`."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + many - 1 + width, n), -1)
    return np.cumsum(edges[:n]) > 0


def _split(batch, marked, touched):
    hit = countmin.repeated(marked.value, np.asarray(batch.column("doc")).view(np.uint64))
    return batch.filter(pa.array(hit if touched else ~hit))


def _touched(batches, marked):
    for batch in batches:
        yield _split(batch, marked, True)


def _unmarked(batches, marked):
    for batch in batches:
        batch = _split(batch, marked, False)
        copy, starts = pa.array([False] * batch.num_rows, pa.bool_()), pa.nulls(batch.num_rows, RUN_LIST)
        yield pa.record_batch([batch.column("doc_id"), batch.column("text"), copy, starts], ["doc_id", "text", "copy", "starts"])


def _strip(batches, width):
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = buffers(piece.column("text"))
            hashes, rows, first, last = scan(data, offsets)
            begins = bounds(rows, piece.num_rows)
            starts, copies = piece.column("starts"), piece.column("copy").to_pylist()
            texts, words, dropped, digests = [], [], [], []
            for row in range(piece.num_rows):
                lo, hi = begins[row], begins[row + 1]
                n = int(hi - lo)
                gone = np.zeros(n, bool)
                if copies[row] and n >= width:
                    gone[:] = True
                elif starts[row].is_valid:
                    runs = starts[row].values
                    gone = _removed(*(runs.field(c).to_numpy(zero_copy_only=False) for c in ("start", "many")), n, width)
                kept = np.flatnonzero(~gone) + lo
                raw = data[offsets[row] : offsets[row + 1]].tobytes()
                base = offsets[row]
                if len(kept) == n:
                    text = b" ".join(raw.split())
                else:
                    text = b" ".join([raw[a:b] for a, b in zip((first[kept] - base).tolist(), (last[kept] - base).tolist(), strict=True)])
                texts.append(text.decode())
                words.append(n)
                dropped.append(int(gone.sum()))
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(words, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )


def drop_repeated_substrings(docs, width=WIDTH, gram=GRAM, held=HELD_WINDOWS):
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) for every row of `docs`.

    Words covered by a window that starts earlier (smaller doc_id, or the same document
    and an earlier start) go. Null or empty text: no words, the digest of the empty
    string. Rows that share a doc_id count in the order of their text hash; rows equal
    in both are copies of one document, which all lose only what that document loses.
    Rows without doc_id come last. Other columns are ignored.
    """
    gram = min(gram, width)
    late = repeated_windows(docs, width, gram, held)
    keyed = _keyed(docs).selectExpr("*", *TEXT_CHECKS).drop("text")
    same = ["text_key", "check", "size"]
    leads = keyed.groupBy(*same).agg(F.min("doc").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = keyed.join(leads, same).where("doc > lead").select("doc", "text_key").distinct()
    marks = late.withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc", "text_key", F.lit(None).cast("array<struct<start:int,many:int>>").alias("starts"), F.lit(True).alias("copy"))
    )
    marks = cut(marks)
    marked = countmin.membership(marks.select("doc").distinct())
    full = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"doc": F.coalesce("doc_id", F.lit(NO_ID)), "text_key": F.xxhash64("text")}
    )
    shape = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    # texts that lose nothing are finished where they are read, the others meet their marks
    whole = full.mapInArrow(lambda batches: _strip(_unmarked(batches, marked), width), shape)
    touched = full.mapInArrow(lambda batches: _touched(batches, marked), full.schema)
    joined = touched.join(marks, ["doc", "text_key"], "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "starts"
    )
    return whole.unionByName(joined.mapInArrow(lambda batches: _strip(batches, width), shape))
