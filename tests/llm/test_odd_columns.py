from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.quality import quality_rules

SF = "/root/testdata/sf0.001"


def odd(spark):
    """Documents with columns whose names and fields no DDL text takes as they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs.withColumns({"meta": F.struct(F.lit(1).alias("a b"), F.lit("x").alias("c`d")), "e`f": F.lit(2), "g.h": F.array(F.lit(3))})


def test_stages_carry_columns_of_any_name(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        r = out.first()
        assert set(docs.columns) <= set(out.columns), name
        assert r.meta == Row(**{"a b": 1, "c`d": "x"}) and r["e`f"] == 2 and r["g.h"] == [3], name
    assert quality_rules(docs).first()["e`f"] == 2


def test_text_by_any_case(spark):
    docs = spark.createDataFrame([(1, "one line that is long\none line that is long")], "doc_id long, TEXT string")
    r = dedup_lines(docs).first()
    assert r.TEXT == "one line that is long" and r.n_removed == 1


def test_many_equal_rows_share_no_bucket(spark):
    docs = spark.range(20000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    other = spark.range(100).select((F.col("id") + 100).alias("doc_id"), F.lit("w " * 5).alias("text"), F.lit("t").alias("source"))
    out = mix_sources(docs.unionByName(other))
    rows = out.groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("taken").alias("most")).collect()
    for r in rows:
        assert abs(r.taken - r.target) <= 1
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mix_sources(docs.unionByName(other)).collect()))
