"""Data files of a partitioned table, as a frame.

Spark lists the folders (in parallel jobs past a few) and the metadata columns
of its binary file source are read without the files' content, so the listing
is rows in tasks, not a loop on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def plain_path(uri: Column) -> Column:
    """A path as the file system has it, from the URI of ``_metadata.file_path``."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def folder_of(uri: Column) -> Column:
    return F.element_at(F.split(plain_path(uri), "/"), -2)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """folder, file, length, modified of every data file below ``path``.

    ``folder`` is the name of the file's own folder (``column=value``).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(path).select("path", "length", "modificationTime"))
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"), F.col("path").alias("file_path"),
                        F.col("length"), F.col("modificationTime").alias("modified"))


def folder_signatures(spark: SparkSession, path: str) -> DataFrame:
    """folder, signature: changes whenever a folder's files do."""
    one = F.xxhash64("file", "length", "modified").cast("decimal(38,0)")
    return data_files(spark, path).groupBy("folder").agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.sum(one).cast("string")).alias("signature"))
