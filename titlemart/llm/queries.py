"""Queries of the operators in this package and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemart.llm import decontaminate, exact_dedup, hard_negatives, html_text, language, lexical, minhash, mixing, quality, secrets, suffix_dedup, toxicity, window_dedup
from titlemart.llm.tables import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain at least half of a benchmark item's words in tiles of five or more."""
    found = decontaminate.contaminated(read_table(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage", "n_tiles")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir), k=4, percent=80)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir))
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of_kind(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text("base"), 256).alias("base_sha256"), secrets.span_text("spans").alias("spans"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_text.extract_text(read_table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    trees = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), trees)
    return scored.select(F.col("row.doc_id").alias("doc_id"), quality.held_out("row.doc_id").alias("held_out"), "score", "predicted")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_strings(read_table(spark, sf_dir), span=400).drop("kept")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir).select("doc_id", "lang", "text")
    models = language.fit_languages(docs.where(~quality.held_out("doc_id", 4, 2)))
    found = language.predict_languages(docs, models)
    return found.select("doc_id", quality.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeated_windows(read_table(spark, sf_dir), span=50).drop("kept_text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are made noisy as the contract says: every seventh id has the next label."""
    vectors = read_table(spark, sf_dir, "embeddings")
    noisy = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(noisy, F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(read_table(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    lexicon = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), lexicon)
    return scored.select(F.col("row.doc_id").alias("doc_id"), quality.held_out("row.doc_id").alias("held_out"), "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_minhash, op3_secrets, op4_html_text, op5_source_mix, op6_quality,
        op7_suffix_dedup, op8_exact_dedup, op9_language, op10_window_dedup, op11_hard_negatives, op12_lexical_search, op13_toxicity, pipeline,
    )
}

# DuckDB; the regular expressions hold the same character classes as the operators
EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

ORACLES = {"op5_source_mix": mixing.TAKEN_SQL, "op8_exact_dedup": EXACT_SQL, "op11_hard_negatives": hard_negatives.NEGATIVES_SQL, "op12_lexical_search": lexical.RANKED_SQL}
