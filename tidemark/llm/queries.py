"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, decontaminate, divergence, hard_negatives, html_text, line_dedup, lm_scoring, mixing, near_dup, quality
from tidemark.llm import oracles, suffix_dedup, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document under a 400-byte string that also starts elsewhere."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document, by pivotal rounding."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the site style tree."""
    return html_text.extract_main_text(_table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the place of the leak."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the 32k piece model."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op8_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at 0.85 over five-word shingles."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), per_cent=85).drop("thash")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, and what remains without near-duplicates of earlier lines."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    kept = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.length(kept).cast("long").alias("n_chars_kept"),
                      F.sha2(kept, 256).alias("kept_sha256"))


#: A conversation of control strings, whose turns must come back as they are.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its prefix-target examples."""
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
                                    "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.prefix_targets(chats.unionByName(control)))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of every source of a language, and the terms it overuses."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector's positives."""
    vectors = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label"),
        F.col("embedding").alias("vec"))
    return hard_negatives.hard_negatives(vectors, F.expr("id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_main_text": op3_main_text,
    "op5_toxicity": op5_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_counts": op7_token_counts,
    "op10_line_dedup": op10_line_dedup,
    "op9_lm_scores": op9_lm_scores,
    "op8_minhash_near_dup": op8_minhash_near_dup,
    "op11_chat_format": op11_chat_format,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op11_chat_format": oracles.OP11,
    "op12_source_divergence": oracles.OP12,
    "op13_hard_negatives": oracles.OP13,
}
