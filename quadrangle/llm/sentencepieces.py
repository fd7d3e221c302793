"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units that no piece can cross: first between two ASCII characters that
stand side by side in no piece, such as a letter and the blank after it, then, in what that
leaves, wherever no piece of the table lies over the place. Words that foreign letters glue
together come apart there, so there are fewer different units, and shorter ones. The
different units of the corpus are counted; every substring of a
unit of at most the longest piece's length is exploded and equi-joined to the piece table,
and the edges found are grouped by unit. A higher-order aggregate then folds each unit's
edges: for unigram models the Viterbi path of the best total score, for merge (BPE)
models, whose scores are merge ranks and not log probabilities, the merges themselves,
one a step, always of the best-ranked edge that joins two neighbours. Characters outside
the vocabulary become bytes.

The most frequent `HEAD_UNITS` units are sent to every task as sorted arrays; a text
made of these alone is put together where it is read. Texts with rarer units are
shuffled, compressed, to meet theirs. Units longer than a bit mask are merged in place
by the same rule.
"""

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from quadrangle.llm.textscan import _powers, buffers, mix, pieces, segment_hashes
from quadrangle.session import cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
LONGEST_UNIT = 60
HEAD_UNITS = 1 << 22
HEAD_IDS = 64
ENCODE_BYTES = 1 << 20
HELD_UNITS = 1 << 19
TALLY_BYTES = 4 << 20
TALLY_PLACES = 1 << 20
TALLY_ROWS = 1 << 15
SPAN_BITS = 22
SPAN_SLICE = 1 << 15  # bytes
IS_PIECE, IS_HEAD = 1, 2


class Vocabulary:
    """The piece table of a model file: text, id and rank of every ordinary piece."""

    def __init__(self, path=MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_at = [0] * 256
        self.rows, self.text = [], []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_at[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.rows.append((piece, i, float(model.get_score(i))))
                self.text.append(piece.replace(BLANK, " ").encode())
        # merge models have whole-numbered scores: the negated order of their merges
        self.merges = all(score == int(score) for _, _, score in self.rows)
        self.longest = max(len(piece) for piece, _, _ in self.rows)
        # ASCII characters that stand side by side in some piece, the blank sign as a blank
        self.pairs = np.zeros(256 * 256, bool)
        self.pairs.reshape(256, 256)[128:] = self.pairs.reshape(256, 256)[:, 128:] = True
        for text in self.text:
            raw = np.frombuffer(text, np.uint8).astype(np.int64)
            self.pairs[raw[:-1] * 256 + raw[1:]] = True
        self.by_text = {piece: (-score, i) for piece, i, score in self.rows}
        # by hash: whether a text is a piece of two characters or more, or begins one
        self.spans = np.zeros(1 << SPAN_BITS, np.uint8)
        for piece, _, _ in self.rows:
            codes = np.frombuffer(piece.replace(BLANK, " ").encode("utf-32-le"), "<u4")
            places = _span_places(np.cumsum(_code_values(codes)))
            self.spans[places[1:-1]] |= IS_HEAD
            self.spans[places[1:][-1:]] |= IS_PIECE

    def table(self, spark):
        """(key, piece, id, rank): a fixed number of rows, whatever the corpus."""
        order = {score: rank for rank, score in enumerate(sorted({-score for _, _, score in self.rows}))}
        rows = [(piece, i, order[-score]) for piece, i, score in self.rows]
        return spark.createDataFrame(rows, "text string, id int, rank long").withColumn("key", F.xxhash64("text"))

    def merged(self, unit):
        """Ids of one unit by merging the best neighbours until none is left."""
        symbols, after = list(unit), list(range(1, len(unit) + 1))
        before = list(range(-1, len(unit) - 1))
        waiting = []

        def offer(i):
            if i >= 0 and symbols[i] is not None and after[i] < len(unit):
                both = symbols[i] + symbols[after[i]]
                if both in self.by_text:
                    heapq.heappush(waiting, (self.by_text[both][0], i, both))

        for i in range(len(unit)):
            offer(i)
        while waiting:
            _, i, both = heapq.heappop(waiting)
            if symbols[i] is None or after[i] >= len(unit) or symbols[i] + symbols[after[i]] != both:
                continue
            gone = after[i]
            symbols[i], symbols[gone], after[i] = both, None, after[gone]
            if after[i] < len(unit):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        ids = []
        for symbol in symbols:
            if symbol in self.by_text:
                ids.append(self.by_text[symbol][1])
            elif symbol is not None:
                ids += [self.bytes_at[b] for b in symbol.encode()]
        return ids


def units(data, offsets, pairs):
    """Texts with a blank put before each that is not empty: (bytes, offsets, unit starts)."""
    full = np.flatnonzero(np.diff(offsets))
    data = np.insert(data, offsets[full], 32)
    offsets = offsets + np.r_[0, np.cumsum(np.diff(offsets) > 0)]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = edge[:-1].copy()
    start[1:] |= ~pairs[data[:-1].astype(np.int32) * 256 + data[1:]]
    return data, offsets, np.flatnonzero(start)


def _code_values(codes):
    """Terms whose running sum hashes code points, as `textscan` does with bytes."""
    return mix(codes.astype(np.uint64) + np.uint64(1)) * _powers(len(codes) + 1)[0][: len(codes)]


def _span_places(hashes):
    return (hashes >> np.uint64(64 - SPAN_BITS)).astype(np.int64)


def refined(data, starts, vocabulary):
    """Unit starts with those added, inside units, that no piece lies over.

    What is cut depends on the unit alone. A hash met by chance only leaves a place uncut."""
    cuts = [starts]
    # slices that end between units, so that little is held at a time
    slices = np.unique(np.searchsorted(starts, np.arange(0, len(data), SPAN_SLICE)))
    slices = slices[slices < len(starts)]
    for lo, hi in zip(slices, np.r_[slices[1:], len(starts)], strict=True):
        first, last = starts[lo], starts[hi] if hi < len(starts) else len(data)
        own = data[first:last]
        heads = np.flatnonzero((own & 0xC0) != 0x80)
        codes = np.frombuffer(own.tobytes().decode().encode("utf-32-le"), "<u4")
        begin = np.searchsorted(heads, starts[lo:hi] - first)
        run = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_code_values(codes), out=run[1:])
        down = _powers(len(codes) + 1)[1]
        over = np.zeros(len(codes) + 1, np.int32)
        at, size = np.arange(len(codes)), np.diff(np.r_[begin, len(codes)])
        left = np.repeat(begin + size, size) - at
        for length in range(2, vocabulary.longest + 1):
            inside = left >= length
            at, left = at[inside], left[inside]
            kind = vocabulary.spans[_span_places((run[at + length] - run[at]) * down[at])]
            found = at[kind & IS_PIECE > 0]
            over[found + 1] += 1
            over[found + length] -= 1
            longer = kind & IS_HEAD > 0
            at, left = at[longer], left[longer]
        cuts.append(first + heads[np.cumsum(over[:-1]) == 0])
    return np.unique(np.concatenate(cuts))


def _long(data, starts):
    """Which units have more code points than the lattice takes."""
    size = np.diff(np.r_[starts, len(data)])
    long = size > LONGEST_UNIT
    for i in np.flatnonzero(long):
        own = data[starts[i] : starts[i] + size[i]]
        long[i] = ((own & 0xC0) != 0x80).sum() > LONGEST_UNIT
    return long


def _plain(column):
    """Text with the blank sign read as a blank, as encoders do."""
    return pa.array([t.replace(BLANK, " ") if t and BLANK in t else t for t in column.to_pylist()], pa.string())


def _read(piece, pairs):
    column = piece.column("text")
    data, offsets = buffers(column)
    if (data == 0xE2).any():
        data, offsets = buffers(_plain(column))
    return units(data, offsets, pairs)


def _texts(data, starts, picked):
    """The texts of some units as an Arrow array."""
    size = np.r_[starts[1:], len(data)][picked] - starts[picked]
    flat = _gather(data, starts[picked], size)
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    return pa.StringArray.from_buffers(len(picked), pa.py_buffer(offsets), pa.py_buffer(flat))


def _words(data, starts, picked):
    ends = np.r_[starts[1:], len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(starts[picked].tolist(), ends[picked].tolist(), strict=True)]


class Tally:
    """Counts of units by hash, with the text of each kept once.

    A table with one place per low bits of the hash counts what it already holds; only
    the rest is sorted."""

    def __init__(self):
        self.known, self.counts, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words, self.many = [], 0
        self.held = np.zeros(TALLY_PLACES, np.uint64)
        self.hits = np.zeros(TALLY_PLACES, np.int64)

    def add(self, hashes, text_of):
        """Count `hashes`; `text_of` gives the texts of units by their index."""
        place = (hashes & np.uint64(TALLY_PLACES - 1)).astype(np.int32)
        hit = self.held[place] == hashes
        self.hits += np.bincount(place[hit], minlength=TALLY_PLACES)
        rest = np.flatnonzero(~hit)
        found, first, times = np.unique(hashes[rest], return_index=True, return_counts=True)
        at = np.searchsorted(self.known, found)
        old = np.zeros(len(found), bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == found[inside]
        self.counts[at[old]] += times[old]
        new = ~old
        self.at = np.insert(self.at, at[new], self.many + np.arange(new.sum()))
        self.known, self.counts = np.insert(self.known, at[new], found[new]), np.insert(self.counts, at[new], times[new])
        self.words.append(text_of(rest[first[new]]))
        self.many += int(new.sum())
        place = (found & np.uint64(TALLY_PLACES - 1)).astype(np.int32)
        free = self.held[place] == 0
        self.held[place[free]] = found[free]

    def rows(self, vocabulary):
        """(unit, n) of the refined units that the lattice takes."""
        held = np.flatnonzero(self.hits)
        self.counts[np.searchsorted(self.known, self.held[held])] += self.hits[held]
        words = pa.concat_arrays([pa.array([], pa.large_string()), *self.words])
        counts = self.counts[np.argsort(self.at)]
        for lo in range(0, len(words), TALLY_ROWS):
            data, offsets = buffers(words.slice(lo, TALLY_ROWS))
            starts = refined(data, offsets[:-1], vocabulary)
            own = lo + np.searchsorted(offsets, starts, side="right") - 1
            short = np.flatnonzero(~_long(data, starts))
            _, first, back = np.unique(segment_hashes(data, starts)[short], return_index=True, return_inverse=True)
            n = np.zeros(len(first), np.int64)
            np.add.at(n, back, counts[own[short]])
            yield pa.record_batch([_texts(data, starts, short[first]), pa.array(n, pa.int64())], ["unit", "n"])


def _tally(batches, vocabulary):
    """(unit, n) for the units of one task, each once unless there are very many."""
    vocabulary = vocabulary.value
    tally = Tally()
    for batch in batches:
        for piece in pieces(batch, limit=TALLY_BYTES):
            data, offsets, starts = _read(piece, vocabulary.pairs)
            if not len(starts):
                continue
            tally.add(segment_hashes(data, starts), lambda own, d=data, s=starts: _texts(d, s, own).cast(pa.large_string()))
            if tally.many > HELD_UNITS:
                yield from tally.rows(vocabulary)
                tally = Tally()
    yield from tally.rows(vocabulary)


def lattice(words, vocabulary, spark):
    """(unit, n, size, edges): the pieces found in each unit, best rank first.

    An edge has its place and id, the bits of its two ends and of the places inside it.
    A character by itself is an edge only where paths are scored; merging needs none.
    """
    least = 2 if vocabulary.merges else 1
    signed = words.withColumn("sign", F.replace("unit", F.lit(" "), F.lit(BLANK))).withColumn("size", F.char_length("unit"))
    starts = signed.selectExpr("*", "explode(sequence(0, size - 1)) AS start")
    # a last character alone still gives its unit a row
    lengths = starts.selectExpr("*", f"explode(sequence({least}, greatest({least}, least({vocabulary.longest}, size - start)))) AS len")
    spread = lengths.selectExpr("unit", "n", "size", "start", "len", "substring(sign, start + 1, len) AS piece").withColumn("key", F.xxhash64("piece"))
    # joined on a number, which is fast to look up; the text itself decides
    table = F.broadcast(vocabulary.table(spark))
    found = spread.join(table, (spread.key == table.key) & (spread.piece == table.text) & F.expr("start + len <= size"), "left")
    # edges travel as one number: rank, place, length and id
    code = F.expr("shiftleft(rank, 34) | shiftleft(CAST(start AS BIGINT), 28) | shiftleft(CAST(len AS BIGINT), 22) | id")
    grouped = found.where("id IS NOT NULL OR (start = 0 AND len <= 2)").groupBy("unit", "n", "size").agg(F.collect_list(code).alias("codes"))
    start, length = "CAST(shiftright(c, 28) & 63 AS INT)", "CAST(shiftright(c, 22) & 63 AS INT)"
    edges = f"""transform(array_sort(codes), c -> struct({start} AS start, {length} AS len, c & 4194303L AS id,
        shiftleft(1L, {start}) | shiftleft(1L, {start} + {length}) AS ends,
        shiftleft(1L, {start} + {length}) - shiftleft(1L, {start} + 1) AS inside)) AS edges"""
    return grouped.selectExpr("unit", "n", "size", edges)


# the cuts, and the longer pieces between neighbouring ones in text order, as place and id
PATH = """struct(cuts, array_sort(transform(
    filter(edges, e -> (cuts & e.ends) = e.ends AND (cuts & e.inside) = 0L AND e.len > 1),
    e -> shiftleft(CAST(e.start AS BIGINT), 32) | e.id)) AS found)"""

# the best-ranked edge over exactly two neighbouring symbols is merged, a step for each;
# the sign bit tells that none is left
MERGES = f"""
    aggregate(sequence(0, least(size, size(edges))), shiftleft(1L, size + 1) - 1L, (cuts, step) ->
        if(cuts < 0, cuts, coalesce(cuts & ~get(filter(edges, e ->
            (cuts & e.ends) = e.ends AND bit_count(cuts & e.inside) = 1), 0).inside, cuts | {-(2**63) + 1}L - 1L)),
        cuts -> element_at(transform(array(cuts & {2**63 - 1}L), cuts -> {PATH}), 1))"""

# best cost and last start per place; a character outside the vocabulary costs `OUTSIDE`
OUTSIDE = 1e6


def best_path(vocabulary):
    """The expression of the best path over a unigram model's costs, as cuts."""
    costs = [0.0] * (1 + max(i for _, i, _ in vocabulary.rows))
    for _, i, score in vocabulary.rows:
        costs[i] = -score
    return VITERBI.replace("COST", "array(" + ", ".join(f"{c!r}D" for c in costs) + ")[CAST(e.id AS INT)]")


VITERBI = f"""
    aggregate(
        sort_array(concat(
            transform(edges, e -> struct(e.start + e.len AS stop, e.start AS start, COST AS cost)),
            transform(sequence(0, size - 1), s -> struct(s + 1 AS stop, s AS start, {OUTSIDE}D AS cost)))),
        transform(sequence(0, size), p -> struct(if(p = 0, 0D, double('infinity')) AS cost, 0 AS start)),
        (best, e) -> if(best[e.start].cost + e.cost < best[e.stop].cost,
            transform(best, (b, p) -> if(p = e.stop, struct(best[e.start].cost + e.cost AS cost, e.start AS start), b)), best),
        best -> aggregate(sequence(1, size), struct(size AS at, shiftleft(1L, size) AS cuts),
            (way, step) -> if(way.at = 0, way, struct(best[way.at].start AS at, way.cuts | shiftleft(1L, best[way.at].start) AS cuts)),
            way -> way.cuts))"""


def dictionary(docs, vocabulary):
    """(unit, n, path) for every different unit of `docs` of at most `LONGEST_UNIT` characters.

    The path holds the cuts, as bits, and the pieces of two characters and more."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    words = docs.select("text").mapInArrow(lambda batches: _tally(batches, shared), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    edges = lattice(words, vocabulary, spark)
    path = MERGES if vocabulary.merges else f"element_at(transform(array({best_path(vocabulary)}), cuts -> {PATH}), 1)"
    return edges.select("unit", "n", F.expr(path).alias("path"))


def _hashed(batches, vocabulary):
    """(h, n, ids): units by hash; single characters get their piece's id, or bytes."""
    vocabulary = vocabulary.value
    alone = np.full(0x110000, -1, np.int32)
    for piece, (_, i) in vocabulary.by_text.items():
        if len(piece) == 1:
            alone[32 if piece == BLANK else ord(piece)] = i
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = buffers(batch.column("unit"))
        cuts = np.asarray(batch.column("path").field("cuts")).astype("<u8")
        rows, at = np.nonzero(np.unpackbits(cuts.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        own = rows[1:] == rows[:-1]
        rows, start, size = rows[:-1][own], at[:-1][own], np.diff(at)[own]
        text = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets[:-1]]
        letter = text[heads[rows] + start]
        ids = alone[letter]
        ids[size > 1] = np.asarray(batch.column("path").field("found").flatten()) & 0xFFFFFFFF
        many = np.ones(len(ids), np.int64)
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            spelled = [chr(c).encode() for c in letter[unknown].tolist()]
            many[unknown] = [len(x) for x in spelled]
            begin = np.cumsum(many) - many
            ids = np.repeat(ids, many)
            for place, raw in zip(begin[unknown].tolist(), spelled, strict=True):
                ids[place : place + len(raw)] = [vocabulary.bytes_at[x] for x in raw]
        stop = np.cumsum(np.bincount(rows, many, batch.num_rows).astype(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, stop].astype(np.int32)), pa.array(ids, pa.int32()))
        yield pa.record_batch([pa.array(segment_hashes(data, offsets[:-1]).view(np.int64)), batch.column("n"), lists], ["h", "n", "ids"])


class Head:
    """Frequent units as sorted hashes with their ids in one flat array."""

    def __init__(self, table):
        hashes = np.asarray(table.column("h").combine_chunks()).view(np.uint64) if table.num_rows else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        lists = table.column("ids").combine_chunks().take(pa.array(order)) if table.num_rows else pa.array([], pa.list_(pa.int32()))
        ends = np.r_[0, np.cumsum(np.asarray(lists.value_lengths(), np.int64))]
        ids = np.asarray(lists.flatten())
        self.hashes = hashes[order]
        self.first = ends.astype(np.int32) if ends[-1] < 1 << 31 else ends
        self.ids = ids.astype(np.uint16) if not len(ids) or ids.max() < 1 << 16 else ids
        # hashes are spread evenly, so their first bits lead to a run of one to two
        self.bits = max(1, (max(1, len(hashes)) - 1).bit_length() - 1)
        heads = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.runs = np.r_[np.searchsorted(self.hashes, heads), len(hashes)].astype(np.int32)

    def find(self, hashes):
        """Index of each unit, -1 where it is not among the frequent ones."""
        head = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.runs[head], self.runs[head + 1]
        found = np.full(len(hashes), -1, np.int32)
        left = np.flatnonzero(at < stop)
        while len(left):
            own = at[left]
            same = self.hashes[own] == hashes[left]
            found[left[same]] = own[same]
            left, own = left[~same], own[~same] + 1
            at[left] = own
            left = left[own < stop[left]]
        return found


def _gather(flat, first, size):
    """The runs `flat[first : first + size]` one after the other."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(first - np.r_[0, ends[:-1]], size) + np.arange(ends[-1])]


class Cut:
    """The texts of a piece cut into units, and those looked up among the frequent ones.

    A unit found there is refined already; only the others are cut further."""

    def __init__(self, piece, head, vocabulary):
        self.data, self.offsets, self.starts = _read(piece, vocabulary.pairs)
        self.hashes = segment_hashes(self.data, self.starts) if len(self.starts) else np.zeros(0, np.uint64)
        self.found = head.find(self.hashes)
        missed = np.flatnonzero(self.found < 0)
        if len(missed):
            self._refine(missed, head, vocabulary)
        self.long = _long(self.data, self.starts)
        self.found[self.long] = -1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.rare = np.flatnonzero((self.found < 0) & ~self.long)
        self.rare_rows = np.searchsorted(self.bounds, self.rare, side="right") - 1

    def _refine(self, missed, head, vocabulary):
        """Cut the missed units, each text once, and look their parts up."""
        _, first, back = np.unique(self.hashes[missed], return_index=True, return_inverse=True)
        size = np.diff(np.r_[self.starts, len(self.data)])
        texts = missed[first]
        flat = _gather(self.data, self.starts[texts], size[texts])
        begin = np.r_[0, np.cumsum(size[texts])[:-1]]
        parts = refined(flat, begin, vocabulary)
        hashes = segment_hashes(flat, parts)
        found = head.find(hashes)
        ends = np.searchsorted(parts, np.r_[begin, len(flat)])
        each = np.diff(ends)[back]
        own = _gather(np.arange(len(parts)), ends[:-1][back], each)
        at = np.repeat(self.starts[missed] - begin[back], each) + parts[own]
        known = np.ones(len(self.starts), bool)
        known[missed] = False
        starts = np.r_[self.starts[known], at]
        order = np.argsort(starts, kind="stable")
        self.hashes = np.r_[self.hashes[known], hashes[own]][order]
        self.found = np.r_[self.found[known], found[own]][order]
        self.starts = starts[order]


class Encoder:
    """Puts ids of whole texts together, and reads them back."""

    def __init__(self, head, vocabulary):
        self.head, self.vocabulary = head, vocabulary
        self.size = np.array([len(t) for t in vocabulary.text], np.int64)
        self.first = np.r_[0, np.cumsum(self.size)[:-1]]
        self.flat = np.frombuffer(b"".join(vocabulary.text), np.uint8)

    def ids(self, cut_, rare):
        """Ids of all texts, and where each ends; `rare` holds [(unit number, ids)] per text."""
        long = np.flatnonzero(cut_.long)
        more = {}
        for unit, word in zip(long.tolist(), _words(cut_.data, cut_.starts, long), strict=True):
            more[unit] = self.vocabulary.merged(word.replace(" ", BLANK))
        for row, own in enumerate(rare or ()):
            for x in own or ():
                more[int(cut_.bounds[row]) + x["at"]] = x["ids"]
        known = cut_.found >= 0
        if known.all():
            at = cut_.found
            first = self.head.first[at]
            size = self.head.first[at + 1] - first
            ids = _gather(self.head.ids, first, size).astype(np.int32)
        else:
            at = cut_.found[known]
            first, size = self.head.first[at], np.zeros(len(known), np.int64)
            size[known] = self.head.first[at + 1] - first
            for unit, own in more.items():
                size[unit] = len(own)
            begin = np.cumsum(size) - size
            ids = np.empty(int(size.sum()), np.int32)
            ids[_gather_places(begin[known], size[known])] = _gather(self.head.ids, first, size[known])
            for unit, own in more.items():
                ids[begin[unit] : begin[unit] + len(own)] = own
        return ids, np.r_[0, np.cumsum(size, dtype=np.int64)][cut_.bounds]

    def decode(self, ids, stop):
        """UTF-8 bytes of all texts, each with the blank put before it, and where each ends."""
        size = self.size[ids]
        return _gather(self.flat, self.first[ids], size), np.r_[0, np.cumsum(size)][stop]


def _gather_places(begin, size):
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(begin - np.r_[0, ends[:-1]], size) + np.arange(ends[-1])


def _rare(batches, head, vocabulary):
    """(doc, text_key, at, h) of units that are neither frequent nor long."""
    for batch in batches:
        for piece in pieces(batch, limit=ENCODE_BYTES):
            own = Cut(piece, head.value, vocabulary.value)
            rows = own.rare_rows
            yield pa.record_batch(
                [
                    piece.column("doc").take(pa.array(rows)), piece.column("text_key").take(pa.array(rows)),
                    pa.array((own.rare - own.bounds[rows]).astype(np.int32)), pa.array(own.hashes[own.rare].view(np.int64)),
                ],
                ["doc", "text_key", "at", "h"],
            )


def _near(batches, head, vocabulary, digest):
    """Texts of frequent and long units alone, encoded."""
    encoder = Encoder(head.value, vocabulary.value)
    for batch in batches:
        for piece in pieces(batch, limit=ENCODE_BYTES):
            own = Cut(piece, head.value, vocabulary.value)
            if len(own.rare):
                kept = np.ones(piece.num_rows, bool)
                kept[own.rare_rows] = False
                piece = piece.filter(pa.array(kept))
                own = Cut(piece, head.value, vocabulary.value)
            yield _encoded(piece, own, encoder, None, digest)


def _far(batches, head, vocabulary):
    """The other texts, compressed."""
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        for piece in pieces(batch, limit=ENCODE_BYTES):
            own = Cut(piece, head.value, vocabulary.value)
            part = piece.take(pa.array(np.unique(own.rare_rows)))
            blobs = [pack.compress(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.record_batch([part.column("doc_id"), part.column("doc"), part.column("text_key"), pa.array(blobs, pa.binary())], ["doc_id", "doc", "text_key", "blob"])


def _encoded(piece, own, encoder, rare, digest):
    ids, stop = encoder.ids(own, rare)
    decoded, ends = encoder.decode(ids, stop)
    texts, offsets = buffers(piece.column("text"))
    lead = (np.diff(ends) > 0).astype(np.int64)
    begin, size = ends[:-1] + lead, np.diff(ends) - lead
    whole = texts
    if len(decoded) and lead.any():
        whole = np.delete(decoded, ends[:-1][lead > 0])
    same = size == np.diff(offsets)
    if len(whole) != len(texts) or not np.array_equal(whole, texts):
        same &= [np.array_equal(decoded[b : b + n], texts[o : o + n]) for b, n, o in zip(begin, size, offsets, strict=False)]
    if digest:
        many = np.diff(stop)
        sums = [hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(stop[:-1], stop[1:], strict=True)]
        return pa.record_batch([piece.column("doc_id"), pa.array(many, pa.int64()), pa.array(sums, pa.string()), pa.array(same)], ["doc_id", "n_pieces", "ids_sha256", "round_trip"])
    lists = pa.ListArray.from_arrays(pa.array(stop.astype(np.int32)), pa.array(ids, pa.int32()))
    read = [decoded[b : b + n].tobytes().decode() for b, n in zip(begin, size, strict=True)]
    return pa.record_batch([piece.column("doc_id"), lists, pa.array(read, pa.string()), pa.array(same)], ["doc_id", "ids", "decoded", "round_trip"])


def _joined(batches, head, vocabulary, digest):
    unpack = zstandard.ZstdDecompressor()
    encoder = Encoder(head.value, vocabulary.value)
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = [unpack.decompress(b).decode() for b in part.column("blob").to_pylist()]
            piece = pa.record_batch([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
            yield _encoded(piece, Cut(piece, head.value, vocabulary.value), encoder, part.column("rare").to_pylist(), digest)


def encode(docs, path=MODEL, head_units=HEAD_UNITS, digest=False):
    """(doc_id, ids, decoded, round_trip) for every row of `docs`.

    `ids` are the model's pieces of the whole text with a blank put before it, `decoded`
    the text read back from them, `round_trip` whether that is the text given; it is not
    where a text holds the blank sign U+2581 itself, which reads back as a blank. A null
    or empty text has no pieces, and an empty text decoded. Rows that share doc_id and
    text are encoded alike; a null doc_id is kept. Other columns are ignored. With `digest` the
    columns are (doc_id, n_pieces, ids_sha256, round_trip): the ids are counted and hashed,
    as little-endian 32-bit numbers, where they are made.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    words = spark.sparkContext.broadcast(vocabulary)
    known = cut(dictionary(docs, vocabulary).mapInArrow(lambda batches: _hashed(batches, words), "h long, n long, ids array<int>"))
    total = known.count()
    floor = 0
    if total > head_units:
        floor = known.agg(F.percentile_approx("n", 1 - head_units / total, 10_000)).first()[0]
    # bounded by `head_units` times `HEAD_IDS` ids
    frequent = known.where((F.col("n") > floor) & (F.size("ids") <= HEAD_IDS))
    head = spark.sparkContext.broadcast(Head(frequent.select("h", "ids").toArrow()))

    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    shape = "doc_id long, n_pieces long, ids_sha256 string, round_trip boolean" if digest else "doc_id long, ids array<int>, decoded string, round_trip boolean"
    near = keyed.select("doc_id", "text").mapInArrow(lambda batches: _near(batches, head, words, digest), shape)
    rest = known.where((F.col("n") <= floor) | (F.size("ids") > HEAD_IDS)).select("h", "ids")
    if rest.isEmpty():
        return near
    rare = keyed.mapInArrow(lambda batches: _rare(batches, head, words), "doc long, text_key long, at int, h long").distinct()
    met = rare.join(rest, "h").groupBy("doc", "text_key").agg(F.collect_list(F.struct("at", "ids")).alias("rare"))
    far = keyed.mapInArrow(lambda batches: _far(batches, head, words), "doc_id long, doc long, text_key long, blob binary")
    far = far.join(met, ["doc", "text_key"]).select("doc_id", "blob", "rare")
    return near.unionByName(far.mapInArrow(lambda batches: _joined(batches, head, words, digest), shape))


def document_pieces(docs, **more):
    """(doc_id, n_pieces, ids_sha256, round_trip) for every row of `docs`."""
    return encode(docs.select("doc_id", "text"), digest=True, **more)
