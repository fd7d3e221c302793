"""Short licence notices in texts, with a bounded number of character edits.

A notice that may be edited `k` times is cut into `k + 1` pieces: one of them must stand
in the text unchanged, so the pieces are exact seeds. All seeds of all notices are looked
up in one pass of an automaton over the text's words, joined by single blanks. Around a
seed, runs of whole words are matched against the notice by the `regex` library with at
most `k` errors, which gives the edits and the span. The words that name the licence must
stand unedited.
"""

from collections import namedtuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from quadrangle.llm.textscan import pieces

CHARS_PER_EDIT = 10
MOST_EDITS = 4

Notice = namedtuple("Notice", "label text core")

# The phrases whose exact places count, with their labels.
PHRASES = (
    Notice("mit", "under the mit license", "mit"),
    Notice("apache-2", "apache license version 2", "apache 2"),
    Notice("cc-by-nc", "cc by nc", "cc by nc"),
)

# Notices the search adds; the words of `core` must stand as they are, in this order.
NOTICES = (
    Notice("mit", "released under the mit license", "mit"),
    Notice("mit", "licensed under the terms of the mit license", "mit"),
    Notice("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    Notice("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", "noncommercial"),
    Notice("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Notice("cc-by-sa", "creative commons attribution sharealike", "sharealike"),
    Notice("gpl-2", "gnu general public license version 2", "gnu general 2"),
    Notice("gpl-3", "gnu general public license version 3", "gnu general 3"),
    Notice("lgpl-3", "gnu lesser general public license version 3", "lesser 3"),
    Notice("agpl-3", "gnu affero general public license version 3", "affero 3"),
    Notice("mpl-2", "mozilla public license version 2 0", "mozilla 2"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
)

# byte -> byte: A-Z in lower case, other ASCII but a-z and 0-9 as blanks, the rest as it is
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

SPANS = "array<struct<label:string, start:bigint, n_words:bigint, edits:int, text:string>>"
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32()), ("text", pa.string())]))
SCHEMA = f"doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans {SPANS}"


def words_of(text):
    """The text's words: runs of a-z (A-Z lower-cased), 0-9 and all that is not ASCII."""
    return text.encode().translate(_WORDS).split()


def _holds(text, core):
    """The words of `core` stand in `text`, in their order."""
    words = iter(text.split())
    return all(word in words for word in core)


class Searcher:
    """Finds notices in normalised texts, words joined by single blanks."""

    def __init__(self, phrases=PHRASES, notices=NOTICES, chars_per_edit=CHARS_PER_EDIT):
        self.notices = [*phrases, *notices]
        self.n_phrases = len(phrases)
        self.edits = [min(MOST_EDITS, len(n.text) // chars_per_edit) for n in self.notices]
        seeds = {}
        for number, (notice, k) in enumerate(zip(self.notices, self.edits, strict=True)):
            size = len(notice.text)
            cuts = [size * i // (k + 1) for i in range(k + 2)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(notice.text[lo:hi], []).append((number, lo))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?:{regex.escape(n.text, special_only=True, literal_spaces=True)}){{e<={k}}}", regex.BESTMATCH)
            for n, k in zip(self.notices, self.edits, strict=True)
        ]
        self.cores = [n.core.split() for n in self.notices]

    def _exact(self, text, number, start):
        wanted = self.notices[number].text
        end = start + len(wanted)
        return (
            start >= 0 and text.startswith(wanted, start)
            and (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")
        )

    def _edited(self, text, number, start):
        """Span and edits of the best run of whole words around `start`, or None."""
        k, size = self.edits[number], len(self.notices[number].text)
        lo, hi = max(0, start - k), min(len(text), start + size + k)
        if not _holds(text[max(0, lo - size) : hi + size], self.cores[number]):
            return None
        # blanks a run may begin after and end before
        edges = [-1] if lo == 0 else []
        edges += [at for at in range(max(0, lo - 1), hi) if text[at] == " "]
        edges += [len(text)] if hi == len(text) else [hi] if text[hi] == " " else []
        best = None
        for left in edges:
            for right in edges:
                if not size - k <= right - left - 1 <= size + k:
                    continue
                run = text[left + 1 : right]
                if not _holds(run, self.cores[number]):
                    continue
                match = self.patterns[number].fullmatch(run)
                if match and (best is None or sum(match.fuzzy_counts) < best[2]):
                    best = left + 1, right, sum(match.fuzzy_counts)
        return best

    def find(self, text):
        """Exact places (phrase number, start) of the phrases, and the best spans (number,
        start, end, edits) of all notices, overlaps of one notice settled."""
        places, spans, tried = [], {}, set()
        for last, (size, owners) in self.automaton.iter(text):
            for number, offset in owners:
                start = last - size + 1 - offset
                if (number, start) in tried:
                    continue
                tried.add((number, start))
                if self._exact(text, number, start):
                    end = start + len(self.notices[number].text)
                    if number < self.n_phrases:
                        places.append((number, start))
                    spans[number, start, end] = 0
                elif self.edits[number]:
                    found = self._edited(text, number, start)
                    if found:
                        spans[number, found[0], found[1]] = found[2]
        best = sorted(spans.items(), key=lambda s: (s[0][0], s[1], s[0][1]))
        return places, _settled([(*span, edits) for span, edits in best])


def _settled(spans):
    """Spans of one notice that overlap a better one go; spans come best first per notice."""
    kept, ends = [], {}
    for number, start, end, edits in spans:
        taken = ends.setdefault(number, {})
        # ends of kept spans by coarse position, so that many spans stay cheap
        size = 256
        near = [s for cell in range(start // size - 1, end // size + 2) for s in taken.get(cell, ())]
        if any(start < e and s < end for s, e in near):
            continue
        taken.setdefault(start // size, []).append((start, end))
        kept.append((number, start, end, edits))
    return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


def _word_numbers(text, starts):
    """Number of the word each (ascending) start lies at."""
    out, at, number = {}, 0, 0
    for start in starts:
        number += text.count(" ", at, start)
        at = start
        out[start] = number
    return out


def scan_text(searcher, text):
    """One result row, without doc_id, for a text (None: empty)."""
    words = words_of(text or "")
    joined = b" ".join(words).decode()
    places, spans = searcher.find(joined)
    number = _word_numbers(joined, sorted({s for _, s in places} | {s for _, s, _, _ in spans}))
    starts = [number[s] for _, s in places]
    labels = {searcher.notices[n].label for n, _ in places}
    every = labels | {searcher.notices[n].label for n, *_ in spans}
    score = max((1 - edits / len(searcher.notices[n].text) for n, _, _, edits in spans), default=0.0)
    found = [
        {"label": searcher.notices[n].label, "start": number[s], "n_words": joined.count(" ", s, e) + 1, "edits": edits, "text": joined[s:e]}
        for n, s, e, edits in spans
    ]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(labels)), ",".join(sorted(every)), score, found,
    )


def _scanned(batches, make):
    searcher = make()
    names = [f.split()[0] for f in SCHEMA.split(f", spans {SPANS}")[0].split(", ")] + ["spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
    for batch in batches:
        for piece in pieces(batch):
            rows = [scan_text(searcher, t) for t in piece.column("text").to_pylist()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.record_batch([piece.column("doc_id").cast(pa.int64()), *columns], names)


def find_licenses(docs, phrases=PHRASES, notices=NOTICES, chars_per_edit=CHARS_PER_EDIT):
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    One row per row of `docs`, in place. Words are runs of ASCII letters (A-Z lower-cased),
    digits and anything that is not ASCII. `n_base` counts the places where a phrase's
    words stand consecutively, `first_word` and `last_word` are the smallest and largest
    start among them (words from 0), null where there is none. `spans` are notices found
    with at most one edit per `chars_per_edit` characters and `MOST_EDITS` in all, their core
    words unedited;
    overlapping spans of one notice give way to the one with fewest edits, then the first.
    `labels` joins both kinds, `score` is the best share of unedited characters, 0 without
    a span. A null or empty text has no words. Repeated rows and rows without doc_id are
    scanned each for itself; further columns are not read; texts are scanned whole,
    whatever their length. An empty table gives an empty one."""
    make = lambda: Searcher(phrases, notices, chars_per_edit)
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scanned(batches, make), SCHEMA)


def license_digests(docs, **more):
    """`find_licenses` without the spans."""
    return find_licenses(docs, **more).select(*[F.col(c) for c in "doc_id n_words n_base first_word last_word base_labels labels score".split()])
