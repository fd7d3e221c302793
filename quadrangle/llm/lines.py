"""Removal of lines repeated across documents, over levelled sorted runs of line hashes.

A run holds, per line key, the number of documents seen with it and the largest doc_id
among them, sorted by key. Batches of documents arrive from the largest doc_ids down. Each
batch merge-anti-joins the runs: keys a run already settles (enough documents, and a
larger doc_id to keep the line) need no more counting, and what is left becomes the
batch's own run. When a level holds `FANOUT` runs they are merged into one run of the
next level, so a key is rewritten once per level. Built-in functions only.
"""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from quadrangle.session import cut, scratch_path

FANOUT = 3
BATCHES = 4
MIN_CHARS = 20
MIN_DOCS = 3
BLANKS = " \t\n\x0b\f\r"
KEY = ["k1", "k2"]


class LineRuns:
    """Sorted runs of (k1, k2, n_docs, last_doc), in levels."""

    def __init__(self, spark, min_docs=MIN_DOCS, fanout=FANOUT):
        self.spark, self.min_docs, self.fanout, self.levels = spark, min_docs, fanout, []

    def runs(self):
        return [run for level in self.levels for run in level]

    def _write(self, rows):
        return cut(rows.sortWithinPartitions(*KEY))

    def _merge(self, runs):
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, lines):
        """Take in one batch of (doc_id, k1, k2); no doc_id may come in two batches."""
        own = lines.select("doc_id", *KEY).distinct().groupBy(*KEY).agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        for run in self.runs():
            settled = run.where(F.col("n_docs") >= self.min_docs).select(*KEY, F.col("last_doc").alias("holder"))
            same = [own[k] == settled[k] for k in KEY] + [own.last_doc < settled.holder]
            own = own.join(settled.hint("merge"), same, "left_anti")
        self._keep(self._write(own), 0)

    def _keep(self, run, level):
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self._merge(self.levels[level]), []
            self._keep(self._write(merged), level + 1)

    def repeated(self):
        """(k1, k2, last_doc) of keys found in enough documents."""
        return self._merge(self.runs()).where(F.col("n_docs") >= self.min_docs).drop("n_docs")


def line_key(line):
    """The line without blanks at its ends, A-Z in lower case; other letters as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, ascii_uppercase, ascii_lowercase))


def drop_repeated_lines(docs, min_chars=MIN_CHARS, min_docs=MIN_DOCS, batches=BATCHES):
    """Every column and row of `docs`, and n_lines, n_dropped, kept_text.

    Texts are split at \\n; a line's key is `line_key`. Keys of at least `min_chars` code
    points found in at least `min_docs` documents lose all their lines except in the
    largest doc_id holding them. A null or empty text is one empty line and stays so, as
    the empty text. Rows that share a doc_id count as one document, and keep or lose a
    line together. Rows without doc_id take no part and lose nothing. Columns of `docs`
    named like one of the results are replaced.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key")).where("doc_id IS NOT NULL")
    long_lines = named.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("at", "line")).where(
        F.char_length("line") >= min_chars
    )
    keyed = long_lines.select("doc_id", "text_key", "at", line_key(F.col("line")).alias("key")).where(
        F.char_length("key") >= min_chars
    )
    cuts = named.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("cuts")).first().cuts
    batch = F.lit(0)
    for bound in cuts or []:
        batch = batch + F.when(F.col("doc_id") <= bound, 1).otherwise(0)
    hashed = keyed.select(
        "doc_id", "text_key", "at", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("line"), "key").alias("k2"), batch.alias("batch")
    )
    path = scratch_path(spark, "lines")
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)

    runs = LineRuns(spark, min_docs)
    for number in range(batches):
        runs.add(lines.where(F.col("batch") == number))
    gone = (
        lines.join(runs.repeated(), KEY)
        .where("doc_id <> last_doc")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("at").alias("gone"))
        .select(F.col("doc_id").alias("gone_doc"), F.col("text_key").alias("gone_key"), "gone")
    )
    results = ["n_lines", "n_dropped", "kept_text"]
    own = [c for c in docs.columns if c.lower() not in results]
    # the row's columns go into one struct, so that none can clash with a working column
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    marked = whole.join(gone, (F.col("row.doc_id") == F.col("gone_doc")) & (F.col("text_key") == F.col("gone_key")), "left")
    pieces = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(pieces, i)), "\n")
    )
    return marked.select(
        "row.*",
        F.size(pieces).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )


def line_dedup_digests(docs, **more):
    """(doc_id, n_lines, n_dropped, kept_sha256)."""
    out = drop_repeated_lines(docs.select("doc_id", "text"), **more)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed
  WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.line, k.pos, r.key IS NOT NULL AND k.doc_id <> r.last_doc AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
