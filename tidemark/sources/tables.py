"""Plain table scans and typed read-back of partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_all(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """``select * from tbl``: a catalog table by name, else a path."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    return spark.read.format(fmt).load(name_or_path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds a table: a folder with a visible entry.

    Asks the file system directly (no schema inference job).
    """
    try:
        jvm = spark.sparkContext._jvm  # Hadoop FileSystem handle
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return False
        return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. Spark Connect): try a read
        try:
            spark.read.format("parquet").load(path).schema  # noqa: B018 - forces listing
            return True
        except Exception:  # noqa: BLE001 - AnalysisException on a missing/empty path
            return False


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a partitioned table back with its own schema.

    Without a schema, partition values such as ``202401`` are inferred as int
    from the folder names; with it they keep their stored type.
    """
    reader = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_partitioned(spark: SparkSession, path: str, partition_col: str,
                     partition_type: str = "string", fmt: str = "parquet") -> DataFrame:
    """Read a table whose schema is not at hand, keeping the partition type.

    The data columns come from the files; the partition column gets
    ``partition_type`` instead of the type guessed from folder names.
    """
    from pyspark.sql.types import StructField, _parse_datatype_string

    inferred = spark.read.format(fmt).load(path).schema
    ptype = _parse_datatype_string(partition_type)
    fields = [StructField(f.name, ptype if f.name == partition_col else f.dataType, True)
              for f in inferred.fields]
    return read_table(spark, path, StructType(fields), fmt)
