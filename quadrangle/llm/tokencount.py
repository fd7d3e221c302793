"""Token counts that follow edits, from a segment tree of pre-tokens per document.

A text is cut into leaves of whole pre-tokens: a single blank between two other characters
always begins a pre-token, so counts of leaves add up to the count of the text. A tree
keeps the sums of the leaves' characters and tokens. An edit finds its leaves by walking
down the character sums, re-encodes those and one leaf of context on each side, and
updates the sums on the way up. The trees are a table like any other; the vocabulary is
read once and sent to every task.
"""

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F

from quadrangle.llm.textscan import pieces
from quadrangle.session import cut

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the blanks `\s` stands for in the pattern
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
LEAF_CHARS = 256
GROWN = 16

EDITS = "array<struct<seq:long,start:long,removed:long,inserted:string>>"
TREE = "array<bigint>"
_encodings = {}


def read_ranks(path=RANKS):
    """The vocabulary file: one token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(name, ranks):
    """One encoder per process and vocabulary."""
    if name not in _encodings:
        _encodings[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[name]


def cut_leaves(text, size=LEAF_CHARS):
    """Lengths of leaves of about `size` characters; a leaf grows until a blank allows a cut."""
    out, begin, n = [], 0, len(text)
    while n - begin > size:
        at = text.find(" ", begin + size)
        while 0 < at < n - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < n - 1:
            break
        out.append(at - begin)
        begin = at
    if n > begin:
        out.append(n - begin)
    return out


class SumTree:
    """Sums over a fixed number of leaves, in one array: node i has children 2i and 2i + 1."""

    def __init__(self, heap):
        self.heap = heap
        self.size = len(heap) // 2

    @classmethod
    def over(cls, values):
        size = 1 << max(0, len(values) - 1).bit_length()
        heap = np.zeros(2 * size, np.int64)
        heap[size : size + len(values)] = values
        for i in range(size - 1, 0, -1):
            heap[i] = heap[2 * i] + heap[2 * i + 1]
        return cls(heap)

    def total(self):
        return int(self.heap[1])

    def leaf(self, i):
        return int(self.heap[self.size + i])

    def set(self, i, value):
        i += self.size
        change = value - self.heap[i]
        while i:
            self.heap[i] += change
            i //= 2

    def find(self, offset):
        """The leaf that holds place `offset`, and where that leaf begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if offset >= begin + self.heap[i]:
                begin += int(self.heap[i])
                i += 1
        return i - self.size, begin


class Counted:
    """A text with its two trees."""

    def __init__(self, text, chars, tokens, count):
        self.text, self.chars, self.tokens, self.count = text, chars, tokens, count
        self.encoded = 0

    @classmethod
    def build(cls, text, count):
        lengths, begin, tokens = cut_leaves(text), 0, []
        for length in lengths:
            tokens.append(count(text[begin : begin + length]))
            begin += length
        return cls(text, SumTree.over(lengths), SumTree.over(tokens), count)

    def edit(self, start, removed, inserted):
        """Replace `removed` characters from `start` on; places outside the text are moved to its ends."""
        start = min(max(0, start), len(self.text))
        removed = min(max(0, removed), len(self.text) - start)
        last = max(0, len(self.text) - 1)
        low, begin = self.chars.find(min(start, last))
        high, _ = self.chars.find(min(start + max(0, removed - 1), last))
        # one leaf of context on either side that holds text
        if low:
            low, begin = self.chars.find(max(0, begin - 1)) if begin else (low, begin)
        stop = begin + sum(self.chars.leaf(i) for i in range(low, high + 1))
        if stop < len(self.text):
            high, after = self.chars.find(stop)
            stop = after + self.chars.leaf(high)
        grown = self.text[begin:start] + inserted + self.text[start + removed : stop]
        self.text = self.text[:begin] + grown + self.text[stop:]
        lengths = cut_leaves(grown)
        slots = high - low + 1
        if len(lengths) > slots and sum(lengths[slots - 1 :]) > GROWN * LEAF_CHARS:
            self._regrow(low, high, lengths, grown)
            return
        if len(lengths) > slots:
            lengths = [*lengths[: slots - 1], sum(lengths[slots - 1 :])]
        at = 0
        for i in range(slots):
            length = lengths[i] if i < len(lengths) else 0
            self.chars.set(low + i, length)
            self.tokens.set(low + i, self._encode(grown[at : at + length]))
            at += length

    def _encode(self, text):
        self.encoded += len(text)
        return self.count(text) if text else 0

    def _regrow(self, low, high, lengths, grown):
        """Give the region new leaves of its own; counts of all other leaves stay."""
        size, at, counts = self.chars.size, 0, []
        for length in lengths:
            counts.append(self._encode(grown[at : at + length]))
            at += length
        for name, new in (("chars", lengths), ("tokens", counts)):
            old = getattr(self, name).heap[size:]
            setattr(self, name, SumTree.over(np.r_[old[:low], new, old[high + 1 :]]))


def count_tokens(own, text):
    """Tokens of a text, long runs of blanks encoded apart.

    The pattern makes one pre-token of a run of blanks, less its last one where more text
    follows; its matcher cannot take runs of about a million, so they are cut out here."""
    total, begin = 0, 0
    for run in LONG_BLANKS.finditer(text):
        stop = run.end() - (run.end() < len(text))
        total += len(own.encode_ordinary(text[begin : run.start()]))
        total += len(own._encode_single_piece(text[run.start() : stop].encode()))
        begin = stop
    return total + len(own.encode_ordinary(text[begin:]))


def _counter(ranks):
    own = encoding("ranks", ranks.value)
    return lambda text: count_tokens(own, text)


def _built(batches, ranks):
    count = _counter(ranks)
    for batch in batches:
        for piece in pieces(batch):
            held = [Counted.build(t, count) for t in piece.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    piece.column("doc_id"), piece.column("text"),
                    pa.array([h.chars.heap for h in held], pa.list_(pa.int64())), pa.array([h.tokens.heap for h in held], pa.list_(pa.int64())),
                    piece.column("edits"),
                ],
                ["doc_id", "text", "chars", "tokens", "edits"],
            )


def _edited(batches, ranks):
    count = _counter(ranks)
    for batch in batches:
        for piece in pieces(batch):
            rows = zip(*(piece.column(c).to_pylist() for c in ("text", "chars", "tokens", "edits")), strict=True)
            texts, chars, tokens, before, after, encoded = [], [], [], [], [], []
            for text, c, t, edits in rows:
                held = Counted(text, SumTree(np.array(c, np.int64)), SumTree(np.array(t, np.int64)), count)
                before.append(held.tokens.total())
                for e in sorted(edits or [], key=lambda e: (e["seq"] is None, e["seq"])):
                    held.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                texts.append(held.text)
                chars.append(held.chars.heap)
                tokens.append(held.tokens.heap)
                after.append(held.tokens.total())
                encoded.append(held.encoded)
            yield pa.record_batch(
                [
                    piece.column("doc_id"), pa.array(texts, pa.string()), pa.array(chars, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64())),
                    pa.array(before, pa.int64()), pa.array(after, pa.int64()), pa.array(encoded, pa.int64()),
                ],
                ["doc_id", "text", "chars", "tokens", "n_before", "n_tokens", "n_reencoded"],
            )


def _ranks(spark, path):
    return spark.sparkContext.broadcast(read_ranks(path))  # one fixed vocabulary


def build_trees(docs, path=RANKS):
    """(doc_id, text, chars, tokens, edits): the trees of every row's whole text.

    `chars` and `tokens` are `SumTree` arrays. Texts may be of any length, and so may words
    and runs of blanks in them; a stretch without a place to cut is one leaf. A null text is the empty text, whose trees
    hold one empty leaf. A column `edits` of type `EDITS` is passed on, else it is null."""
    ranks = _ranks(docs.sparkSession, path)
    edits = F.col("edits") if "edits" in docs.columns else F.lit(None)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(lambda b: _built(b, ranks), f"doc_id long, text string, chars {TREE}, tokens {TREE}, edits {EDITS}")


def attach_edits(trees, edits):
    """Trees with the edits of their doc_id: `edits` holds (doc_id, seq, start, removed, inserted).

    The edits of one document are brought together, as they must be applied in order."""
    grouped = edits.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("seq", "start", "removed")], "inserted")).alias("edits")
    )
    return trees.drop("edits").join(grouped, "doc_id", "left")


def apply_edits(trees, path=RANKS):
    """Trees after their `edits`, with `n_before`, `n_tokens` and `n_reencoded`.

    Edits are applied by ascending `seq` (ties in the order of the array, nulls last) to
    the text as the ones before left it; places are code points, those outside the text
    move to its nearer end; null counts as 0 or nothing. `n_reencoded` is the number of
    characters that were encoded again. Rows that share a doc_id are edited each by
    itself."""
    ranks = _ranks(trees.sparkSession, path)
    return trees.mapInArrow(
        lambda b: _edited(b, ranks),
        f"doc_id long, text string, chars {TREE}, tokens {TREE}, n_before long, n_tokens long, n_reencoded long",
    )


# three edits taken from the row itself: its beginning repeated in the middle, a stretch
# dropped, and its source written over some letters
ROW_EDITS = f"""
    CAST(array(
        struct(1L AS seq, length(text) DIV 2 AS start, 0 AS removed, left(text, 20) AS inserted),
        struct(2L AS seq, length(text) DIV 3 AS start, 15 AS removed, '' AS inserted),
        struct(3L AS seq, 2 * length(text) DIV 3 AS start, 5 AS removed, concat(' ', source, ' ') AS inserted)
    ) AS {EDITS})"""


def document_edits(docs, path=RANKS):
    """(doc_id, n_before, n_tokens, n_reencoded): counts kept up over the edits of each row."""
    with_edits = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source").withColumn("edits", F.expr(ROW_EDITS))
    trees = cut(build_trees(with_edits, path))
    return apply_edits(trees, path).select("doc_id", "n_before", "n_tokens", "n_reencoded")
