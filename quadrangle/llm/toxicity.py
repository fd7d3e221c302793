"""Toxicity from a weighted finite-state grammar over clauses.

The insult transducer is learned: whole words and word stems that mark toxic documents
in a bounded sample of labelled rows. Targets, negations, reporting verbs and threats are
short fixed lists. A clause with an insult or a threat is read as symbols by the composed
grammar (`transducers`), which tells plain, targeted, negated and reported insults and
directed threats apart; their weights are fitted on the same sample. Text alone enters a
score.
"""

import re
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quadrangle.llm.textscan import pieces
from quadrangle.llm.transducers import INSULT, KINDS, NEGATION, REPORT, TARGET, THREAT, WORD, clause_kinds
from quadrangle.session import cut

SAMPLE_TOXIC = 3_000
SAMPLE_CLEAN = 6_000
STEMS = range(4, 9)
MAX_CANDIDATES = 5_000
MIN_SUPPORT = 4
MIN_SHARE = 0.012
MIN_PRECISION = 0.9
COVER = 3
CLEAN_COST = 3
ENTRIES_TRIED = 50_000
THRESHOLD = 0.7

# Fixed word lists of the grammar.
TARGETS = "you your yours yourself they them he she him her this du dich dir ihr euch sie tu toi vous te tú usted ustedes él ella".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais nunca jamás".split()
REPORTS = "said says wrote called calls quoted claims claimed sagte sagt schrieb nannte laut dit selon écrit dijo dice según escribió".split()
THREATS = "kill hurt destroy shoot strangle töten umbringen verletzen erschießen tuer frapper détruire matar golpear destruir".split()

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
LETTERS = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]")
ENDS = ".!?;:\n"
TAGS = {**dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(THREATS, THREAT)}


class Grammar:
    """Matcher for one lexicon; an entry ending in `$` is a whole word, others are stems."""

    def __init__(self, lexicon):
        self.words = frozenset(x[:-1] for x in lexicon if x.endswith("$"))
        self.stems = tuple(x for x in lexicon if not x.endswith("$"))
        self.automaton = ahocorasick.Automaton()
        for entry in {*self.words, *self.stems, *THREATS}:
            self.automaton.add_word(entry, len(entry))
        self.automaton.make_automaton()

    def _symbol(self, token):
        if token in self.words or (self.stems and token.startswith(self.stems)):
            return INSULT
        return TAGS.get(token, WORD)

    def counts(self, text):
        """How many clauses of `text` hold each kind of pattern."""
        found = dict.fromkeys(KINDS, 0)
        text = text.lower()
        done = 0
        for end, size in self.automaton.iter(text):
            start = end - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            begin = max([text.rfind(c, done, start) for c in ENDS]) + 1
            begin = max(begin, done)
            stop = CLAUSE_END.search(text, end)
            done = stop.start() if stop else len(text)
            for kind in clause_kinds([self._symbol(t) for t in TOKEN.findall(text, begin, done)]):
                found[kind] += 1
        return [found[kind] for kind in KINDS]


def _evidence(counts):
    """Numbers of clauses per kind, each further clause adding less."""
    return np.log1p(np.asarray(counts, float).reshape(-1, len(KINDS)))


class Model:
    """A lexicon and the weight of each clause kind."""

    def __init__(self, lexicon=(), weights=(0.0,) * len(KINDS), bias=-4.0):
        self.lexicon, self.weights, self.bias = tuple(lexicon), np.asarray(weights, float), float(bias)

    def scores(self, counts):
        return 1 / (1 + np.exp(-(_evidence(counts) @ self.weights + self.bias)))


def features(text):
    """Whole words and stems of a text, each once."""
    found = set()
    for word in set(LETTERS.findall(text.lower())):
        if len(word) >= STEMS.start:
            found.add(word + "$")
            found.update(word[:n] for n in STEMS if n < len(word))
    return sorted(found)


def _kin(text):
    """Keys that near copies of a text tend to share: its two least long words by checksum,
    and a checksum of the whole."""
    long = sorted({w for w in LETTERS.findall(text.lower()) if len(w) >= 8}, key=lambda w: (crc32(w.encode()), w))
    return [*long[:2], *[None] * (2 - len(long[:2])), f"#{crc32(text.encode())}"]


def _featured(batches):
    for batch in batches:
        for piece in pieces(batch):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            yield pa.record_batch(
                [piece.column("toxic"), pa.array([_kin(t) for t in texts], pa.list_(pa.string())), pa.array([features(t) for t in texts], pa.list_(pa.string()))],
                ["toxic", "kin", "features"],
            )


def choose_lexicon(rows, against, floor):
    """Entries that mark toxic rows, most telling first.

    `rows` holds the entries of each toxic row, `against` how often an entry is found in
    clean ones. Each step takes the entry that covers most rows not yet covered `COVER`
    times, less `CLEAN_COST` for each clean row; among equals the longest, so a whole word
    wins over its stems. Entries that extend a chosen one, or are a stem of it, go too."""
    holders = {}
    for row, found in enumerate(rows):
        for entry in found:
            holders.setdefault(entry, set()).add(row)
    covered = np.zeros(len(rows), int)
    lexicon = []
    while holders:
        gain = {e: sum(covered[r] < COVER for r in held) - CLEAN_COST * against.get(e, 0) for e, held in holders.items()}
        best = max(gain, key=lambda e: (gain[e], len(e), e))
        if gain[best] < floor:
            break
        lexicon.append(best)
        covered[list(holders[best])] += 1
        bare = best.rstrip("$")
        holders = {e: h for e, h in holders.items() if not e.startswith(bare) and not bare.startswith(e.rstrip("$"))}
    return lexicon


def fit_weights(counts, toxic, steps=60, ridge=0.05):
    """Weights and bias of a logistic fit over clause kinds, by Newton's method."""
    x = np.c_[_evidence(counts), np.ones(len(toxic))]
    y, w = np.asarray(toxic, float), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), slope)
        if np.abs(slope).max() < 1e-9:
            break
    return w[:-1], w[-1]


def _counted(batches, lexicon):
    grammar = Grammar(lexicon)
    for batch in batches:
        counts = [grammar.counts(t or "") for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("toxic"), pa.array(counts, pa.list_(pa.int64()))], ["toxic", "counts"])


def learnable():
    """Rows whose label may be learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def train(docs, labels, toxic=SAMPLE_TOXIC, clean=SAMPLE_CLEAN):
    """A model from at most `toxic` + `clean` labelled documents, the first by hash of doc_id.

    Rows without label or doc_id are not used; a document labelled both ways counts as
    toxic. Without any usable row the model finds nothing toxic."""
    known = labels.where(learnable() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.select(F.col("doc_id").alias("known_id"), "toxic", F.xxhash64("doc_id").alias("order"))
    ids = None
    for value, size in ((1, toxic), (0, clean)):
        part = known.where(F.col("toxic") == value).orderBy("order", "known_id").limit(size)
        ids = part if ids is None else ids.union(part)
    # at most `toxic + clean` narrow rows
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("known_id")).select("doc_id", "text", "toxic"))
    rows = cut(sample.mapInArrow(_featured, "toxic int, kin array<string>, features array<string>"))
    marked = rows.where("toxic = 1").withColumn("row", F.xxhash64("kin", F.size("features")))
    entries = marked.select("row", "kin", F.explode("features").alias("entry"))
    # support counts families of near copies once, told by a word other than the entry
    bare = F.regexp_replace("entry", r"\$$", "")
    other = F.filter("kin", lambda word: word.isNotNull() & ~F.startswith(word, bare))
    total, drawn = ({r.toxic: r["count"] for r in x.groupBy("toxic").count().collect()} for x in (known, rows))
    if not drawn.get(1) or not drawn.get(0):
        return Model()
    # an entry met only by chance in toxic rows alone should not reach the floor
    chance = np.log(ENTRIES_TRIED) / np.log((total[0] + total[1]) / total[1])
    floor = max(MIN_SUPPORT, int(np.ceil(chance)) if chance < drawn[1] else MIN_SUPPORT, int(drawn[1] * MIN_SHARE))
    # clean rows stand for as many more as the sample holds fewer of them than of toxic ones
    scale = float(total[0] / drawn[0] / (total[1] / drawn[1]))
    supported = entries.groupBy("entry").agg(F.countDistinct(F.get(other, 0)).alias("support"), F.count("*").alias("pos")).where(F.col("support") >= floor)
    against = rows.where("toxic = 0").select(F.explode("features").alias("entry")).groupBy("entry").agg(F.count("*").alias("neg"))
    telling = (
        supported.join(against, "entry", "left")
        .withColumn("neg", scale * F.coalesce("neg", F.lit(0)))
        .where(F.col("pos") >= MIN_PRECISION * (F.col("pos") + F.col("neg")))
        .orderBy(F.desc("support"), "entry")
        .limit(MAX_CANDIDATES)
    )
    telling = cut(telling)
    against = {r.entry: r.neg for r in telling.collect()}
    held = (
        entries.join(F.broadcast(telling.select("entry")), "entry")
        .groupBy("row").agg(F.collect_set("entry").alias("entries"))
        .collect()
    )
    lexicon = choose_lexicon([r.entries for r in sorted(held, key=lambda r: r.row)], against, floor)
    seen = sample.mapInArrow(lambda batches: _counted(batches, lexicon), "toxic int, counts array<bigint>").collect()
    return Model(lexicon, *fit_weights([r.counts for r in seen], [r.toxic for r in seen]))


def _scored(batches, model):
    grammar = Grammar(model.lexicon)
    for batch in batches:
        for piece in pieces(batch):
            counts = [grammar.counts(t or "") for t in piece.column("text").to_pylist()]
            yield pa.record_batch([*piece.columns, pa.array(model.scores(counts), pa.float64())], [*piece.schema.names, "score"])


def score(docs, model):
    """Every column and row of `docs`, and `score` from 0 to 1 (in place of one so named).

    Null and empty texts hold no clause and get the lowest score the model gives."""
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(lambda batches: _scored(batches, model), schema)


def toxicity(docs, labels):
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    `held_out` rows (crc32 of doc_id as text, modulo 3, is 1) are never learned from; a
    null doc_id is not held out and not learned from either."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(~learnable(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
