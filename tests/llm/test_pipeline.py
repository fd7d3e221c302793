import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from quadrangle.llm import toxicity
from quadrangle.llm.sentencepieces import MODEL
from llm.test_decontaminate import brute as contained
from llm.test_lines import brute as deduplicated
from llm.test_minhash import brute as linked


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_against_brute_force(spark, sf_dir):
    """Every stage on what the one before kept, compared row by row."""
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "minhash_near_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    kept = stages["toxicity"](spark, docs, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    grammar = toxicity.Grammar(model.lexicon)
    wanted = {d for d, t in rows_of(docs) if model.scores([grammar.counts(t)])[0] < toxicity.THRESHOLD}
    assert {d for d, _ in rows_of(kept)} == wanted and kept.columns == docs.columns

    lines = stages["line_dedup"](spark, kept, sf_dir).cache()
    assert {d: t for d, t in rows_of(lines)} == {d: v[2] for d, v in deduplicated(rows_of(kept)).items()}
    assert lines.columns == docs.columns and lines.where("n_chars <> length(text)").isEmpty()

    near = stages["minhash_near_dedup"](spark, lines, sf_dir)
    assert {d for d, _ in rows_of(near)} == {d for d, v in linked(rows_of(lines), 5, 80).items() if v[2]}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, near, sf_dir)
    assert {d for d, _ in rows_of(clean)} == {d for d, v in contained(rows_of(near), items).items() if not v}

    encoder = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = stages["sentencepiece"](spark, clean, sf_dir)
    assert {r.doc_id: r.ids for r in pieces.collect()} == {d: encoder.encode(t) for d, t in rows_of(clean)}

    whole = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r.doc_id, r.n_pieces)
    assert sorted(map(key, whole.collect())) == sorted(map(key, pieces.collect()))


def test_empty_table_nulls_and_more_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("gone", F.lit(1)).withColumn("score", F.lit("x"))
    odd = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    for start in (docs.limit(0), odd.union(docs.limit(30)).union(docs.limit(2))):
        left = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, left, sf_dir)
            assert name == "sentencepiece" or out.columns == docs.columns
            left = out
        assert left.where("NOT round_trip").isEmpty()
        assert left.where("doc_id IS NULL").count() == start.where("doc_id IS NULL").count()
