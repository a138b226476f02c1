"""Key-to-partition index of a partitioned table.

A single-key upsert must find the partitions that hold an old version of a
key.  This side table answers that without a scan of the key column: for each
partition it holds the range of every key column and a blocked Bloom filter
over the keys.

* A filter is rows ``(folder, class, block, m0..m3)``: 256 bits each, in
  ``2^class`` blocks of the partition.  A key sets eight bits of one block, so
  a probe is one equi join on (class, block) and a bit test in the JVM.
* ``signatures`` remembers which files a partition's entry was built from.  A
  partition whose files are others now, or that has no entry, always counts as
  one that may hold any key: changes made past the index cost time, never a
  match.
* ``refresh`` rebuilds the entries of the partitions that an upsert rewrote,
  from their key columns alone.

Bloom filters have no false negatives and ranges are those of the stored keys,
so the partitions given are a superset of the ones a full probe would find.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import col
from tidemark.sources.files import folder_of, folder_signatures
from tidemark.sources.tables import read_table, table_exists

BLOCK_BITS = 256
WORDS = 4
#: Bits that a key sets in each of a block's words.
PER_WORD = 2
MAX_CLASS = 30
#: Filter blocks that a probe may broadcast against.
BROADCAST_KEYS = 2_000_000


def _block_and_masks(keys: list[Column], cls: Column) -> list[Column]:
    """(block, mask of each word) of a key in a filter of ``2^cls`` blocks."""
    h = F.xxhash64(*keys)
    block = h.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), cls) - 1)
    bits = F.xxhash64(h)
    masks = []
    for w in range(WORDS):
        each = [F.call_function("shiftleft", F.lit(1).cast("long"),
                                F.shiftrightunsigned(bits, 6 * (PER_WORD * w + k)).bitwiseAND(F.lit(63)).cast("int"))
                for k in range(PER_WORD)]
        masks.append(reduce(Column.bitwiseOR, each))
    return [block, *masks]


@dataclass
class KeyIndex:
    """Index at ``path`` over the table at ``table_path``."""

    path: str
    table_path: str
    keys: list[str]
    partition_col: str
    bits_per_key: int = 24

    @property
    def _parts(self) -> tuple[str, str]:
        return f"{self.path}/ranges", f"{self.path}/filters"

    def exists(self, spark: SparkSession) -> bool:
        return table_exists(spark, self._parts[0])

    def refresh(self, target: DataFrame, folders: list[str] | None = None) -> None:
        """Rebuild the entries of ``folders`` (all, if None) from ``target``'s key columns.

        ``target`` is the table as stored.  Entries of folders without rows go.
        """
        spark = target.sparkSession
        ranges_at, filters_at = self._parts
        rows = target.select(self._folder().alias("folder"), *[col(k) for k in self.keys])
        marks = folder_signatures(spark, self.table_path)
        if folders is not None:
            rows, marks = rows.where(F.col("folder").isin(folders)), marks.where(F.col("folder").isin(folders))
        bounds = [f(col(k)).alias(f"{n}_{i}") for i, k in enumerate(self.keys) for n, f in (("lo", F.min), ("hi", F.max))]
        nulls = [F.bool_or(col(k).isNull()).alias(f"null_{i}") for i, k in enumerate(self.keys)]
        blocks = F.greatest(F.lit(1.0), F.ceil(F.col("n") * self.bits_per_key / BLOCK_BITS).cast("double"))
        ranges = (rows.groupBy("folder").agg(F.count(F.lit(1)).alias("n"), *bounds, *nulls)
                  .withColumn("class", F.least(F.lit(MAX_CLASS), F.ceil(F.log2(blocks))).cast("int"))
                  .join(marks, "folder"))
        self._write(ranges, ranges_at, folders)
        classes = spark.read.parquet(ranges_at).select("folder", "class")
        if folders is not None:
            classes = classes.where(F.col("folder").isin(folders))
        # One row a partition, far below any broadcast bound: partition lists reach the driver as well.
        keyed = rows.join(F.broadcast(classes), "folder")
        block, *masks = _block_and_masks([col(k) for k in self.keys], F.col("class"))
        filters = (keyed.select("folder", "class", block.alias("block"), *[m.alias(f"m{w}") for w, m in enumerate(masks)])
                   .groupBy("folder", "class", "block").agg(*[F.bit_or(f"m{w}").alias(f"m{w}") for w in range(WORDS)]))
        self._write(filters, filters_at, folders)

    def _folder(self) -> Column:
        """Name of the folder that holds a row (the metadata column has it as part of a URI)."""
        return folder_of(F.col("_metadata.file_path"))

    @staticmethod
    def _write(df: DataFrame, path: str, folders: list[str] | None) -> None:
        # ``entry`` repeats the folder's name, whose own "=" and "%" would be escaped in a folder name anyway.
        out = df.withColumn("entry", F.sha2("folder", 256))
        (out.hint("rebalance", "entry").write.mode("overwrite").partitionBy("entry")
         .option("partitionOverwriteMode", "static" if folders is None else "dynamic").parquet(path))

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        fields = [f for f in spark.read.parquet(path).schema.fields if f.name != "entry"]
        return read_table(spark, path, StructType(fields).add("entry", "string")).drop("entry")

    def candidates(self, source: DataFrame) -> DataFrame:
        """folder, of every partition that may hold a key of ``source``.

        A folder without a valid entry is one of them.
        """
        spark = source.sparkSession
        ranges_at, filters_at = self._parts
        now = folder_signatures(spark, self.table_path)
        ranges = self._read(spark, ranges_at)
        checked = now.withColumnRenamed("signature", "now").join(ranges, "folder", "left").withColumn(
            "valid", F.col("signature").eqNullSafe(F.col("now")))
        unknown = checked.where("NOT valid").select("folder")
        names = [f"__k{i}" for i in range(len(self.keys))]
        asked = source.select(*[col(k).alias(n) for k, n in zip(self.keys, names)]).distinct()
        known = checked.where("valid").drop("now", "valid", "signature", "n")
        # A few classes (at most MAX_CLASS): each key has one block in each.
        classes = [r[0] for r in known.select("class").distinct().collect()]
        if not classes:
            return unknown
        asked = asked.withColumn("class", F.explode(F.array(*[F.lit(c).cast("int") for c in sorted(classes)])))
        block, *masks = _block_and_masks([F.col(n) for n in names], F.col("class"))
        asked = asked.select(*names, "class", block.alias("block"), *[m.alias(f"q{w}") for w, m in enumerate(masks)])
        size = asked.count()
        filters = self._read(spark, filters_at).join(F.broadcast(known.drop("class")), "folder")
        hit = filters.join(F.broadcast(asked) if size <= BROADCAST_KEYS else asked, ["class", "block"])
        for w in range(WORDS):
            hit = hit.where(F.col(f"m{w}").bitwiseAND(F.col(f"q{w}")) == F.col(f"q{w}"))
        for i, n in enumerate(names):
            inside = (F.col(n) >= F.col(f"lo_{i}")) & (F.col(n) <= F.col(f"hi_{i}"))
            hit = hit.where(F.coalesce(inside, F.lit(False)) | (F.col(n).isNull() & F.col(f"null_{i}")))
        return hit.select("folder").distinct().unionByName(unknown)

    def same_types(self, source: DataFrame, target: DataFrame) -> bool:
        """Hashes agree only for values of one type."""
        return all(source.schema[k].dataType == target.schema[k].dataType for k in self.keys)
