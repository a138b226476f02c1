"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each registered query is timed from building the plan to the end of a full
execution (``noop`` sink: every row computed, nothing collected).  One
untimed pass over the headline queries comes first, so that JIT and class
loading of the JVM do not land on whichever query happens to run first.  The
``plain_*`` entries time the reference's own forms next to the scalable ones
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.clean import boolean_flags  # noqa: E402
from tidemark.operators.number import row_number_global, row_number_ranged  # noqa: E402
from tidemark.plans.queries import QUERIES, _orders_ym  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sinks.table import upsert_table, write_partitioned  # noqa: E402
from tidemark.sources.tables import read_table  # noqa: E402

HEADLINE = ["flagship_sync", "full_sync", "stream_sync", "incremental_extract", "bool_detect", "bool_encode",
            "null_token_scrub", "cast_all_string_lineitem", "upsert_composite", "upsert_single_key",
            "row_number_desc", "batch_slices", "qa_compare", "dedupe_source_keys", "control_log_row",
            "stage_overwrite", "compact_table"]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


# ---------------------------------------------------------------- plain forms

def plain_row_number(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    run(row_number_global(orders, ["o_orderkey"]))


def ranged_row_number(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    run(row_number_ranged(orders, ["o_orderkey"]))


def _wide_text(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    return li.select([F.col(c).cast("string").alias(c) for c in li.columns]).withColumn(
        "flag", F.when(F.col("l_returnflag") == "R", "true").otherwise("false"))


def plain_bool_detect(spark, d):
    """A job of its own for each column: does it hold anything but boolean text?"""
    df = _wide_text(spark, d)
    return [c for c in df.columns if df.groupBy(c).count().where(~F.col(c).isin("true", "false", "")).isEmpty()]


def one_pass_bool_detect(spark, d):
    boolean_flags(_wide_text(spark, d)).collect()


def _recent_change(spark, d):
    """A realistic increment: the last 90 days of orders, changed."""
    target = _orders_ym(spark, d)
    top = target.agg(F.max("o_orderdate")).first()[0]
    src = (target.where(F.col("o_orderdate") > F.lit(top) - F.expr("INTERVAL 90 DAYS"))
                 .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return target, src


def plain_upsert_full_rewrite(spark, d):
    """Union + keep-last over the whole table, whole table rewritten."""
    target, src = _recent_change(spark, d)
    path = scratch_path(spark, "bench-full")
    write_partitioned(target, path, "o_yearmonth", dynamic=False)
    t = read_table(spark, path, target.schema)
    u = (t.withColumn("__f", F.lit(0)).unionByName(src.withColumn("__f", F.lit(1))))
    w = Window.partitionBy("o_orderkey", "o_yearmonth").orderBy(F.col("__f").desc())
    merged = u.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__f")
    out = scratch_path(spark, "bench-full-out")
    t0 = time.perf_counter()
    write_partitioned(merged, out, "o_yearmonth", dynamic=False)
    return time.perf_counter() - t0


def touched_upsert(spark, d):
    target, src = _recent_change(spark, d)
    path = scratch_path(spark, "bench-touched")
    write_partitioned(target, path, "o_yearmonth", dynamic=False)
    rows = src.count()
    t0 = time.perf_counter()
    upsert_table(src, path, ["o_orderkey"], "o_yearmonth", source_rows=rows)
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # Warm-up pass (not timed): JVM JIT, class loading, codegen caches.
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))

    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = timed(lambda n=name: run(QUERIES[n](spark, sf_dir)))

    extra = {
        "plain_row_number_global_window": timed(lambda: plain_row_number(spark, sf_dir)),
        "scalable_row_number_ranged": timed(lambda: ranged_row_number(spark, sf_dir)),
        "plain_bool_detect_per_column": timed(lambda: plain_bool_detect(spark, sf_dir)),
        "scalable_bool_detect_one_pass": timed(lambda: one_pass_bool_detect(spark, sf_dir)),
        "plain_upsert_full_rewrite_write": round(plain_upsert_full_rewrite(spark, sf_dir), 3),
        "scalable_upsert_touched_partitions": round(touched_upsert(spark, sf_dir), 3),
    }
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": {**times, **extra}, "sf": sf}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
