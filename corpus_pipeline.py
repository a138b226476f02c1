"""Corpus cleaning pipeline over ``documents``: filter, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller may
write it as Parquet and read it back as the next stage's docs.  All stages but
the last return the columns of their docs.  The stages keep their operators'
rules for nulls, empty texts, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import columns_named, join_small, materialise
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.quality import quality_rules

#: Rows of removed documents that may be broadcast (two numbers each).
REMOVED_ROWS = 1_000_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).where("kept").select(*columns_named(docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near-duplicates of earlier lines; n_chars follows the text.

    A document that loses all of its lines stays, with an empty text.
    """
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns_named(docs.columns))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Rows equal in doc_id and text are one document; groups whose rows all lack
    an id keep their rows.
    """
    groups = materialise(near_duplicates(docs, per_cent=80), "pipeline-groups")
    gone = groups.where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("thash").alias("gone_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_hash"))
    out = join_small(docs, gone, same, "left_anti", REMOVED_ROWS)
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id", "thash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        plain = out.join(repeated.select("doc_id").distinct(), "doc_id", "left_anti")
        out = plain.unionByName(out.join(repeated.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return out.select(*columns_named(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, benchmark).where("leaks IS NULL OR size(leaks) = 0").select(*columns_named(docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with the words and copies that it takes of each."""
    carry = tuple(c for c in docs.columns if c.lower() not in ("doc_id", "size", "source_size", "target", "taken", "copies"))
    return mix_sources(docs, carry=carry).where("taken > 0")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

#: No stage but the first has a SQL form; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{k}")
    return docs
