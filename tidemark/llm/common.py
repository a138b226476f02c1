"""Helpers shared by the training-data operators.

A *word* is a maximal run of characters outside space and ``\\t``..``\\r``;
``bytes.split()`` cuts at exactly those six characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import drop_scratch, scratch_path

WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Broadcast bound in rows for small side tables whose row count was taken first.
BROADCAST_ROWS = 100_000


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Cut lineage: write to the shared scratch folder and read back; also the folder.

    The folder is below ``spark.checkpoint.dir``; a lost executor costs the
    rerun of single tasks, never of the steps before the written table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by a written table."""
    return written(df, label)[0]


def drop_written(spark: SparkSession, *paths: str) -> None:
    """Delete written tables of which nothing is read any more: all that was made of them is written too."""
    for path in paths:
        drop_scratch(spark, path)


def columns_named(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever characters the names hold."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def widened(fields: Iterable[StructField], more: str) -> StructType:
    """Schema of given fields, whatever their names and types, and further ones as DDL."""
    return StructType([StructField(f.name, f.dataType, True) for f in fields] + StructType.fromDDL(more).fields)


def map_arrow(df: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``mapInArrow`` that also takes columns whose names Spark would parse (back-ticks, dots)."""
    odd = {n: f"__odd_{k}" for k, n in enumerate(df.columns) if "`" in n or "." in n}
    if not odd:
        return df.mapInArrow(run, schema)
    back = {v: k for k, v in odd.items()}

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(b.rename_columns([back.get(n, n) for n in b.schema.names]) for b in batches):
            yield out.rename_columns([odd.get(n, n) for n in out.schema.names])

    plain = StructType([StructField(odd.get(f.name, f.name), f.dataType, True) for f in schema])
    return df.toDF(*[odd.get(n, n) for n in df.columns]).mapInArrow(renamed, plain).toDF(*schema.names)


def give_back() -> None:
    """Return freed memory to the system: allocators keep what a task's arrays took, and the worker lives on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, whose worker keeps no freed memory once the task has ended."""
    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return ended


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the value as text, modulo m (null counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % m


def join_small(df: DataFrame, small: DataFrame, cond: Column, how: str = "left", limit: int = BROADCAST_ROWS,
               weight: Column | None = None) -> DataFrame:
    """Join that broadcasts ``small`` only after counting its rows.

    ``weight`` counts something else per row, such as the elements of an
    array: what is bounded must be all that is sent.

    Past ``limit`` Spark plans a shuffle join, whose skewed
    partitions adaptive execution splits.
    """
    n = small.limit(limit + 1).count() if weight is None else small.agg(F.sum(weight)).first()[0] or 0
    return df.join(F.broadcast(small) if n <= limit else small, cond, how)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(b: bytes) -> bytes:
    """Lower-case A-Z only (``bytes.lower`` leaves every other byte alone)."""
    return b.lower()


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, null as empty."""
    for v in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield v.as_py() or b""


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants, fixed values)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + _MIX * np.uint64(2 * seed + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


# --- words and shingles as 64-bit hashes, vectorised over a text's bytes ---

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix64(np.arange(256, dtype=np.uint64), 7)
_POWERS: dict[str, np.ndarray] = {}
#: Longest piece of a text that is hashed at once; a text is cut at white space.
PIECE = 1 << 22


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i mod 2^64 for i < n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                f = np.full(size, np.uint64(base), np.uint64)
                f[0] = 1
                _POWERS[name] = np.cumprod(f, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte value * base^i (mod 2^64), with a leading 0."""
    return prefix_sums(_BYTE[data])


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * base^i (mod 2^64), with a leading 0."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_sum(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent sum of each span, to be mixed."""
    _, down = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return (prefix[end] - prefix[start]) * down[start]


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of the bytes of each span."""
    with np.errstate(over="ignore"):
        return mix64(span_sum(prefix, start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every word of a text, in order."""
    if len(text) > PIECE:
        cut = next((p for p in range(PIECE, len(text)) if IS_SPACE[text[p]]), len(text))
        parts = []
        while text:
            parts.append(word_hashes(text[:cut]) if cut <= PIECE else _hash_words(text[:cut]))
            text = text[cut:]
            cut = next((p for p in range(min(PIECE, len(text)), len(text)) if IS_SPACE[text[p]]), len(text))
        return np.concatenate(parts)
    return _hash_words(text)


def _hash_words(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    word = ~IS_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    return span_hash(prefix_hash(data), edge[::2], edge[1::2])


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of every k-word shingle; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    width = min(k, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            h = h * np.uint64(0xC2B2AE3D27D4EB4F) + words[i:len(words) - width + 1 + i]
    return mix64(h, width)
