"""Language of a text, from a byte-level recurrent network that labels every position."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quadrangle.llm import gru
from quadrangle.llm.textscan import buffers, pieces
from quadrangle.session import cut

DOCS_PER_LANGUAGE = 800
WINDOWS_PER_DOC = 4
WINDOW_BYTES = 64
UNKNOWN = "und"


def learnable():
    """Rows whose language may be learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def _windows(batches):
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        out, labels, order = [], [], []
        for row, lang in enumerate(langs):
            text = data[offsets[row] : offsets[row + 1]]
            room = max(0, len(text) - WINDOW_BYTES)
            for k in range(WINDOWS_PER_DOC):
                at = room * k // max(1, WINDOWS_PER_DOC - 1)
                if len(text) and not (k and not room):
                    out.append(text[at : at + WINDOW_BYTES].tobytes())
                    labels.append(lang)
                    order.append(batch.column("order")[row].as_py())
        yield pa.record_batch([pa.array(labels, pa.string()), pa.array(order, pa.int64()), pa.array(out, pa.binary())], ["lang", "order", "window"])


def train(docs, per_language=DOCS_PER_LANGUAGE, **more):
    """(languages, parameters) from at most `per_language` documents of each language.

    From each such document, the first by hash of doc_id, `WINDOWS_PER_DOC` spans of
    `WINDOW_BYTES` bytes spread over the whole text are learned. Rows without lang,
    doc_id or text are not used."""
    known = docs.where(learnable() & F.col("lang").isNotNull() & (F.length("text") > 0))
    narrow = known.select("doc_id", "lang").groupBy("doc_id").agg(F.min("lang").alias("lang"))
    narrow = cut(narrow.select(F.col("doc_id").alias("known_id"), "lang", F.xxhash64("doc_id").alias("order")))
    languages = [r.lang for r in narrow.select("lang").distinct().orderBy("lang").collect()]
    ids = None
    for lang in languages:
        part = narrow.where(F.col("lang") == lang).orderBy("order", "known_id").limit(per_language)
        ids = part if ids is None else ids.union(part)
    if not languages:
        return [], None
    # at most `per_language` narrow rows for each language
    sample = known.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("known_id")).select("text", "lang", "order")
    rows = sample.mapInArrow(_windows, "lang string, order long, window binary").collect()
    rows.sort(key=lambda r: (r.order, r.lang, r.window))
    number = {lang: i for i, lang in enumerate(languages)}
    return languages, gru.fit([bytes(r.window) for r in rows], [number[r.lang] for r in rows], len(languages), **more)


def _has_letter(text):
    return any(c.isalpha() for c in text)


def _predicted(batches, languages, parameters):
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = buffers(piece.column("text"))
            if parameters is None:
                lang, score = [UNKNOWN] * piece.num_rows, [0.0] * piece.num_rows
            else:
                share, count = gru.pooled(parameters, data, offsets)
                best = share.argmax(axis=1)
                ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
                plain = np.r_[0, np.cumsum(ascii_letter)]
                lettered = plain[offsets[1:]] > plain[offsets[:-1]]
                for row in np.flatnonzero(~lettered & (count > 0)):
                    lettered[row] = _has_letter(data[offsets[row] : offsets[row + 1]].tobytes().decode())
                lang = [languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                score = np.where(lettered, np.clip(share.max(axis=1), 0, 1), 0.0)
            yield pa.record_batch([piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])


def identify(docs, **more):
    """(doc_id, held_out, lang_pred, score) for every row of `docs`.

    `score` is the mean probability of the predicted language over the letters of the
    whole text. Null texts and texts without a letter are `und` with score 0, and so is
    everything if no row can be learned from. `held_out` rows (crc32 of doc_id as text,
    modulo 5, is 0) are never learned from; a null doc_id is neither held out nor learned
    from. Of languages with equal shares the first by name is taken. Repeated rows are each
    predicted by themselves, texts are read whole whatever their length, an empty table
    gives an empty one. Other columns are ignored.
    """
    languages, parameters = train(docs, **more)
    out = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _predicted(batches, languages, parameters), "doc_id long, lang_pred string, score double"
    )
    return out.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "lang_pred", "score")
