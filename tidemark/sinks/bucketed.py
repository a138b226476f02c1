"""Main table in buckets of the record key: a large change set joins without moving the table.

The table is partitioned (say, by month) and, inside each partition, bucketed
and sorted by the record key.  An upsert shuffles the change set into the same
number of buckets and merges it bucket by bucket: the target's side of the
join is its scan, with no exchange above it, whatever the size of either side.
Every task holds one bucket and writes it back as one file a partition, so the
layout holds from run to run.  Only partitions that the change set names are
read and, by dynamic overwrite, replaced.

Record keys must not be null (a bucket join compares plainly); a null key in
the change set is an error.  ``upsert_table`` takes such data.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.operators.upsert import assert_unique_keys, check_same_columns
from tidemark.sinks.table import one_null, partition_filter

#: Settings under which a bucketed scan counts as dealt by its buckets.
JOIN_CONF = {
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # The buckets are by the record key alone, the join also compares the partition.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A coalesced or split bucket would no longer be one file.
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def create_bucketed(df: DataFrame, table: str, path: str, keys: list[str], partition_col: str, buckets: int) -> None:
    """Write ``df`` as the bucketed table; one file for each partition and bucket."""
    df = one_null(df, partition_col)
    (df.repartition(buckets, *[col(k) for k in keys]).sortWithinPartitions(partition_col, *keys).write.mode("overwrite").format("parquet")
     .partitionBy(partition_col).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))


def merged_buckets(spark: SparkSession, source: DataFrame, table: str, keys: list[str], partition_col: str, buckets: int,
                   partitions: list) -> DataFrame:
    """The named partitions of ``table`` after the merge; no exchange above the target's scan."""
    target = spark.table(table).where(partition_filter(partition_col, partitions))
    check_same_columns(target, source)
    order = target.columns
    dealt = source.select([col(c) for c in order]).repartition(buckets, *[col(k) for k in keys])
    new = dealt.select(*[col(c).alias(f"__new_{i}") for i, c in enumerate(order)], F.lit(True).alias("__here"))
    name = {c: f"__new_{i}" for i, c in enumerate(order)}
    on = [col(k) == F.col(name[k]) for k in keys] + [col(partition_col).eqNullSafe(F.col(name[partition_col]))]
    both = target.hint("merge").join(new, on, "full")
    return both.select([F.when(F.col("__here"), F.col(name[c])).otherwise(col(c)).alias(c) for c in order])


def upsert_bucketed(source: DataFrame, table: str, keys: list[str], partition_col: str, buckets: int,
                    partitions: list | None = None, keys_checked: bool = False) -> list:
    """MERGE on keys and partition into the bucketed table; returns the partitions rewritten."""
    spark = source.sparkSession
    source = one_null(source, partition_col)
    if not keys_checked:
        assert_unique_keys(source, [*keys, partition_col])
    if not source.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).isEmpty():
        raise ValueError(f"null among the keys {keys}")
    if partitions is None:
        partitions = [r[0] for r in source.select(col(partition_col)).distinct().collect()]
    with _settings(spark, JOIN_CONF):
        merged = merged_buckets(spark, source, table, keys, partition_col, buckets, partitions)
        # Rows of a task are of one bucket already; the writer sorts them by partition and key.
        merged.write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    return partitions
