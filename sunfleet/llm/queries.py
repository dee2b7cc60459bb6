"""The registered queries of the subpackage, with production parameters, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunfleet.llm import (
    conversation_repair, cotraining, decontaminate, html_extract, language_id, license_scan, mixing, ngram_join, oracles, quality_divergence, source_audit, suffix_dedup,
    token_counts, toxicity,
)
from sunfleet.llm.frames import bounded_batches

#: Vocabulary of a public tokenizer; read by Spark.
VOCABULARY = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.selectExpr(
        "doc_id", "array_join(licences, '|') as licences", "cast(size(sentence_ids) as bigint) as n_sentences", "array_join(sentence_ids, '|') as sentence_ids",
    )


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and divergence verdict of every document."""
    found = quality_divergence.quality(_table(spark, sf_dir, "documents"))
    return found.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "round(class_distance, 6) as class_distance", "round(word_distance, 6) as word_distance",
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat an earlier string of 100 bytes."""
    return suffix_dedup.digests(_table(spark, sf_dir, "documents"), length=100)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", "item_id", "round(similarity, 6) as similarity", "cast(start as bigint) as start", "cast(n_words as bigint) as n_words")


def op5_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return cotraining.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of its title, table and body lines."""
    counted = token_counts.section_tokens(_table(spark, sf_dir, "documents"), VOCABULARY)
    parts = [f"cast(coalesce(try_element_at(sections, '{s}'), 0) as bigint) as {s}_tokens" for s in ("title", "table", "body")]
    return counted.selectExpr("doc_id", "n_tokens", "n_crossing", *parts)


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    taken = mixing.copies(_table(spark, sf_dir, "documents"))
    return taken.selectExpr("doc_id", "size", "source_size", "target", "copies * size as taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are 90 % alike."""
    found = ngram_join.similarity_components(_table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms a source overuses."""
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    given = _table(spark, sf_dir, "conversations")
    return conversation_repair.report(given, conversation_repair.damaged(given))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language_id.predictions(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_distribution_divergence, op3_suffix_array_dedup, op4_benchmark_decontamination, op5_cotraining_quality,
    op6_section_token_counts, op7_systematic_mix, op8_toxicity, op9_ngram_jaccard_join, op10_html_main_text,
    op11_source_divergence, op12_conversation_repair, op13_language_id,
)}

ORACLES = {
    "op2_distribution_divergence": oracles.OP2, "op3_suffix_array_dedup": oracles.OP3, "op4_benchmark_decontamination": oracles.OP4,
    "op7_systematic_mix": oracles.OP7, "op9_ngram_jaccard_join": oracles.OP9, "op11_source_divergence": oracles.OP11, "op12_conversation_repair": oracles.OP12,
}
