"""Cleaning of a document table in stages, each reading what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of `documents`. Null and empty texts pass every stage, tables may be empty,
and rows that share a doc_id are kept or dropped together by the stage on near
duplicates, and judged by their own text everywhere else.
"""

import functools
import gc

from pyspark.sql import functions as F

from quadrangle.llm.decontaminate import contained_items
from quadrangle.llm.lines import drop_repeated_lines
from quadrangle.llm.minhash import near_duplicates
from quadrangle.llm.sentencepieces import encode
from quadrangle.llm.toxicity import THRESHOLD, score, train
from quadrangle.session import scratch_path


def alone(stage):
    """The stage, begun when what earlier ones left in the driver has been let go.

    Broadcasts and shuffle files are dropped once the objects that own them are collected,
    which a driver with room to spare puts off; a session runs several stages."""

    @functools.wraps(stage)
    def run_alone(spark, docs, sf_dir):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        return stage(spark, docs, sf_dir)

    return run_alone


@alone
def drop_toxic(spark, docs, sf_dir):
    """Documents the clause grammar does not find toxic; labels are learned from as in op3."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).where(F.col("score") < THRESHOLD).select(*docs.columns)


@alone
def drop_lines(spark, docs, sf_dir):
    """Texts without the lines found in several documents, but for the last document's."""
    kept = drop_repeated_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


@alone
def drop_near_duplicates(spark, docs, sf_dir):
    """The document with the smallest doc_id of each group of near duplicates."""
    dropped = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


@alone
def drop_contaminated(spark, docs, sf_dir):
    """Documents that contain no benchmark item."""
    found = contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("items") == 0).select(*docs.columns)


@alone
def to_pieces(spark, docs, sf_dir):
    """(doc_id, ids, n_pieces, round_trip): every kept text as pieces, read back and compared."""
    return encode(docs).select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", to_pieces),
]
ORACLE_SQL = None  # learned scores and merges have no SQL; tests/llm hold brute-force versions


def run(spark, sf_dir):
    """Apply the stages to `documents`, writing each result as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
