"""Grouping of spelling variants: words that differ by exactly one edited code point.

Two words are one edit apart exactly if their common prefix and common suffix together
reach the longer length minus one. Words are therefore compared as rows of padded
code-point matrices, one aligned left and one right, tile against tile.

Only words that can be near meet in a tile. Let L be the longer length of a pair; every
word takes part for L its length and its length plus one. What is not yet known to be
shared is the middle of a word; of a pair with a middle of m code points, half of m, rounded
down, is shared at the middle's front or at its back. So a group of words with a common
front and back is split on a longer front, and on a longer back, and a pair that shares
both is left to the front's side (`cap`). Groups above `TILE_CELLS` code points and
`TILE_ROWS` words are split again until the middle is one code point, where no more words
than letters can be left; smaller ones go to the tiles. No group is limited, and a pair
meets exactly once.
"""

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quadrangle.llm.textscan import pieces
from quadrangle.session import cut

MIN_CHARS = 5
MIN_COUNT = 3
FACTOR = 2
TYPO_EVERY = 97
TILE_CELLS = 1 << 14
TILE_ROWS = 64
TILE_BYTES = 1 << 22
CHUNK_CELLS = 1 << 20
FLUSH_WORDS = 200_000

# one byte per code point: letters kept, A-Z in lower case, all else a blank
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_KEY = ["L", "lo", "hi", "cap"]


def _text_words(doc_id, text, typo_every, min_chars):
    """(word, occurrences) of one text, words as Latin-1 bytes, planted typos applied."""
    found = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    start = crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
    for run, n in found.items():
        size = len(run)
        if size < min_chars:
            continue
        if typo_every:
            h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % typo_every == 0:
                at = h % size
                run = run[:at] + run[at + 1 :]
                if size == min_chars:
                    continue
        yield run, n


def _counted(batches, typo_every, min_chars):
    total = {}
    for batch in batches:
        for piece in pieces(batch):
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                for run, n in _text_words(doc_id, text or "", typo_every, min_chars):
                    total[run] = total.get(run, 0) + n
            if len(total) > FLUSH_WORDS:
                yield _word_batch(total)
                total = {}
    if total:
        yield _word_batch(total)


def _word_batch(total):
    words = b"\n".join(total).decode("latin-1").split("\n")
    return pa.record_batch([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def word_counts(docs, min_chars=MIN_CHARS, min_count=MIN_COUNT, typo_every=TYPO_EVERY):
    """(word, n): runs of Latin letters, A-Z in lower case, with at least `min_count` uses.

    With `typo_every` > 0, a run loses the code point h % length where h, the crc32 of
    `<doc_id>:<run>`, divides evenly by it (a null doc_id reads as nothing)."""
    found = docs.select("doc_id", "text").mapInArrow(lambda batches: _counted(batches, typo_every, min_chars), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _split(nodes):
    """Every node's two children: half of the middle added to the front, or to the back."""
    half = F.expr("(L - lo - hi) div 2").cast("int")
    children = F.array(
        F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"), F.col("cap").alias("cap")),
        F.struct(F.col("lo").alias("lo"), (F.col("hi") + half).alias("hi"), F.least("cap", F.col("lo") + half).alias("cap")),
    )
    return _keyed(nodes.select("word", "n", "L", F.explode(children).alias("c")).select("word", "n", "L", "c.*"))


def _keyed(nodes):
    front, back = F.expr("substring(word, 1, lo)"), F.expr("if(hi = 0, '', substring(word, -hi, hi))")
    return nodes.withColumn("k", F.xxhash64(*_KEY, front, back))


def _matrices(words):
    """Code points of words as two padded matrices, the second read from the back."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if len(flat) and flat.max() < 256:
        flat = flat.astype(np.uint8)
    width = int(sizes.max())
    left = np.zeros((len(words), width), flat.dtype)
    right = np.zeros_like(left)
    at = np.arange(width)[None, :]
    left[at < sizes[:, None]] = flat
    right[at >= width - sizes[:, None]] = flat
    return left, right[:, ::-1], sizes


def near_words(words, counts, keys):
    """Near words of every word among those of its group: number, and best (count, word) index.

    `keys`: arrays k, L, lo, hi, cap, rows of one group adjacent; words of a group distinct.
    Groups are laid out as tiles of rows, each compared with the tiles up to where its last
    group ends; a tile that spans several groups compares within them."""
    left, right, sizes = _matrices(words)
    rows, width = left.shape
    k, longest, lo, hi, cap = keys
    order = sorted(range(rows), key=lambda i: (-counts[i], words[i]))
    rank = np.empty(rows, np.int64)
    rank[order] = np.arange(rows)
    fresh = np.r_[True, (k[1:] != k[:-1]) | (longest[1:] != longest[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (cap[1:] != cap[:-1])]
    group = np.cumsum(fresh)
    ends = np.searchsorted(group, group, side="right")
    near, best = np.zeros(rows, np.int64), np.full(rows, rows)
    step = max(1, min(TILE_ROWS, int((TILE_BYTES / max(width, 1)) ** 0.5)))
    for a in range(0, rows, step):
        b = min(rows, a + step)
        for c in range(a, int(ends[b - 1]), step):
            d = min(int(ends[b - 1]), c + step)
            front = (left[a:b, None, :] != left[None, c:d, :]).argmax(2)
            back = (right[a:b, None, :] != right[None, c:d, :]).argmax(2)
            size, some = longest[a:b, None], (sizes[a:b, None], sizes[None, c:d])
            found = (group[a:b, None] == group[None, c:d]) & (np.arange(a, b)[:, None] < np.arange(c, d)[None, :])
            found &= (front + back >= size - 1) & (np.maximum(*some) == size)
            # what the group's key promises, and the pair's only place
            found &= (front >= lo[a:b, None]) & (back >= hi[a:b, None]) & (front < cap[a:b, None])
            if not found.any():
                continue
            near[a:b] += found.sum(1)
            near[c:d] += found.sum(0)
            best[a:b] = np.minimum(best[a:b], np.where(found, rank[None, c:d], rows).min(1))
            best[c:d] = np.minimum(best[c:d], np.where(found, rank[a:b, None], rows).min(0))
    chosen = np.array([*order, -1])[best]
    return near, chosen


def _chunks(batches):
    """Runs of rows of one L that end where a group ends, of about `CHUNK_CELLS` code points."""
    held, cells, last = [], 0, None
    for batch in batches:
        for piece in pieces(batch, "word"):
            size, k = piece.column("L").to_numpy(), piece.column("k").to_numpy()
            grown = size != np.r_[last[0] if last else size[0], size[:-1]]
            fresh = np.flatnonzero(grown | (k != np.r_[last[1] if last else k[0], k[:-1]]))
            last = size[-1], k[-1]
            cuts = np.flatnonzero(grown).tolist()
            if len(fresh) and cells + int(size.sum()) >= CHUNK_CELLS:
                cuts.append(int(fresh[-1]))
            lo = 0
            for cut_at in sorted(set(cuts)):
                held.append(piece.slice(lo, cut_at - lo))
                yield pa.Table.from_batches(held)
                held, cells, lo = [], 0, cut_at
            held.append(piece.slice(lo))
            cells += int(size[lo:].sum())
    if held:
        yield pa.Table.from_batches(held)


def _compared(batches):
    """Partial (word, near, best_n, best) per group and word, from rows sorted by group."""
    for chunk in _chunks(batches):
        if chunk.num_rows < 2:
            continue
        words, counts = chunk.column("word").to_pylist(), chunk.column("n").to_pylist()
        keys = [chunk.column(c).to_numpy().astype(np.int64) for c in ("k", *_KEY)]
        near, best = near_words(words, counts, keys)
        at = np.flatnonzero(near)
        yield pa.record_batch(
            [
                pa.array([words[i] for i in at], pa.string()), pa.array(near[at], pa.int64()),
                pa.array([counts[i] for i in best[at]], pa.int64()), pa.array([words[i] for i in best[at]], pa.string()),
            ],
            ["word", "near", "best_n", "best"],
        )


def near_counts(vocabulary):
    """(word, n_near, best): for every word with a near word, how many, and the most used one
    (of equals the first in code-point order). `vocabulary`: word (unique), n."""
    size = F.char_length("word")
    nodes = vocabulary.select("word", "n", F.explode(F.array(size, size + 1)).alias("L")).select(
        "*", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(1 << 30).alias("cap")
    )
    nodes, found = _split(nodes), None
    while True:
        full = cut(
            nodes.groupBy("k", *_KEY).agg(F.count("*").alias("rows"))
            .where((F.col("rows") > TILE_ROWS) & (F.col("rows") * F.col("L") > TILE_CELLS))
            .where("L - lo - hi > 1")
            .select(F.col("k").alias("full")).distinct()
        )
        more = full.count()
        ready = nodes.join(full, F.col("k") == F.col("full"), "left_anti") if more else nodes
        # groups are small by now, so a partition holds many and no group fills one
        tiles = ready.repartition("k").sortWithinPartitions("L", "k", *_KEY)
        part = tiles.mapInArrow(_compared, "word string, near bigint, best_n bigint, best string")
        found = part if found is None else found.union(part)
        if not more:
            break
        nodes = cut(_split(nodes.join(full, F.col("k") == F.col("full"), "left_semi").drop("k")))
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    ).select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def roots(forms):
    """(word, root): the last word of each chain of forms, by doubling.

    `forms`: word (unique), form. Uses at least double along a chain, so it ends, and the
    number of rounds is the logarithm of the longest, which is itself a logarithm."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        step = cut(reached.join(onward, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        ))
        reached = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return reached


def spelling_variants(docs, min_chars=MIN_CHARS, min_count=MIN_COUNT, factor=FACTOR, typo_every=TYPO_EVERY):
    """(word, form, root, n, n_near, form_n), one row per word of the whole table.

    Words are runs of `[A-Za-z\\u00C0-\\u00FF]`, A-Z in lower case, with at least
    `min_chars` code points and `min_count` uses (see `word_counts` for planted typos). Two
    words are near if one edited code point turns one into the other. `form` is the near
    word with most uses (of equals the first in code-point order) if it has at least
    `factor` times the word's own, else null; `root` the word that forms lead to in the
    end, the word itself if it has none. Null and empty texts hold no word, a null doc_id
    reads as nothing before the colon, repeated rows count each, texts and words may be of
    any length, an empty table has no words, and further columns are not read."""
    words = cut(word_counts(docs, min_chars, min_count, typo_every))
    near = near_counts(words).withColumnRenamed("word", "near_word")
    has_form = F.col("best_n") >= factor * F.col("n")
    judged = cut(words.join(near, F.col("word") == F.col("near_word"), "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best_n")).alias("form_n"),
    ))
    ends = roots(judged.where("form IS NOT NULL").select("word", "form")).withColumnRenamed("word", "ended")
    return judged.join(ends, F.col("word") == F.col("ended"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
