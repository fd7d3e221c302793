"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from quadrangle.llm.decontaminate import CONTAMINATION_SQL, contamination
from quadrangle.llm.interactions import INTERACTIONS_SQL, filter_interactions
from quadrangle.llm.language import identify
from quadrangle.llm.licenses import license_digests
from quadrangle.llm.lines import LINE_DEDUP_SQL, line_dedup_digests
from quadrangle.llm.minhash import near_duplicates
from quadrangle.llm.neighbours import nearest
from quadrangle.llm.sentencepieces import document_pieces
from quadrangle.llm.sharding import SHARDS_SQL, document_shards
from quadrangle.llm.spelling import spelling_variants
from quadrangle.llm.substrings import drop_repeated_substrings
from quadrangle.llm.tokencount import document_edits
from quadrangle.llm.toxicity import toxicity


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    return document_shards(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    return document_edits(table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op7_substring_dedup(spark, sf_dir):
    return drop_repeated_substrings(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_sentencepiece(spark, sf_dir):
    return document_pieces(table(spark, sf_dir, "documents"))


def op9_nearest_vectors(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op10_line_dedup(spark, sf_dir):
    return line_dedup_digests(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_license_scans(spark, sf_dir):
    return license_digests(table(spark, sf_dir, "documents"))


def op13_filter_interactions(spark, sf_dir):
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_nearest_vectors": op9_nearest_vectors,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_license_scans": op12_license_scans,
    "op13_filter_interactions": op13_filter_interactions,
}

ORACLES = {
    "op1_sharding": SHARDS_SQL,
    "op2_decontamination": CONTAMINATION_SQL,
    "op10_line_dedup": LINE_DEDUP_SQL,
    "op13_filter_interactions": INTERACTIONS_SQL,
}
