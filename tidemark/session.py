"""Session settings and the shared scratch location.

Scratch tables and checkpoints live below the folder the cluster names in
``spark.checkpoint.dir``.  A private folder is set only when a local session
has none (tests); on a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on: UTC wall clock (watermarks are compared as
# timestamps, never as zoned text), case-insensitive names, adaptive execution.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (UI off, UTC, AQE)."""
    b = SparkSession.builder.master(master).appName(app)
    b = b.config("spark.ui.enabled", "false")
    # Local mode runs everything in the driver JVM; 1 GiB (the default) makes
    # wide rows thrash the collector.  Only applies when this call starts the JVM.
    b = b.config("spark.driver.memory", (extra or {}).get("spark.driver.memory", "8g"))
    # Checkpoint files of the row numbering are removed once unreferenced.
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def _configured_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - conf lookups can raise on some builds
        d = None
    if d:
        return d.rstrip("/")
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        d = None
    return d.rstrip("/") if d else None


def ensure_checkpoint_dir(spark: SparkSession, master: str | None = None) -> str:
    """Return the checkpoint folder; set a private one only where unset and local."""
    d = _configured_dir(spark)
    sc = spark.sparkContext
    if d is None:
        master = sc.master if master is None else master
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; "
                               f"master {master!r} cannot use a folder of the driver's machine")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def checkpoint_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder, one per call."""
    return f"{checkpoint_root(spark)}/tidemark-scratch/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that its owner no longer reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # Hadoop FileSystem handle
    if f"{checkpoint_root(spark)}/tidemark-scratch/" not in f"{path}/":
        raise ValueError(f"not a scratch folder: {path}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
