"""Repeated byte strings by suffix order and longest-previous-factor arrays.

A byte is removed if a string of ``length`` bytes that covers it starts
somewhere else too (``keep='none'``), or starts at an earlier place
(``keep='first'``: later copies go, the first stays).  Places are ordered by
doc_id (null last), text and offset.

The suffixes are sorted in independent buckets.  The key of a suffix is the
smallest hash of the ``GRAM``-byte substrings of its first ``length`` bytes.
Suffixes that share ``length`` bytes share the key, so a bucket holds every
match of its suffixes.  Neighbouring suffixes with one key travel as one
*segment*, and equal segments are merged before the shuffle, so thousands of
copies are one row with a count.

Inside a bucket the suffix array to depth ``length``, the common prefixes of
neighbours, and the longest-previous-factor array are built: the previous and
the next smaller position in suffix order give the longest earlier match, and
with positions mirrored the longest later match.

A bucket with more than ``BUCKET`` suffixes is too large for one task.  Its
segments are cut again by the minima of longer substrings (``longer_gram``),
which parts it into smaller buckets of the same kind, until each fits.  The
last such substring is as long as the strings, so that all suffixes of a bucket
are equal; their number and first place say all, and are aggregated before the
shuffle, so no group is gathered, however hot.  A substring of g bytes leaves
``length`` - g + 1 suffixes to each place of it; that number falls by a factor
of four a step, so what the steps hand on falls too.

Defined cases: null text is empty; texts below ``length`` bytes keep all;
matches never cross documents; equal rows are places of their own; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, materialise, mix64, prefix_hash, span_hash, text_bytes

GRAM = 64
MAX_RUN = 1024
BUCKET = 150_000
#: Requests or ranges (a few numbers each) that may be broadcast.
BROADCAST_ITEMS = 1_000_000


def longer_gram(gram: int, length: int) -> int:
    """The substring length by which a bucket too large is parted: double, but three quarters of the rest at most."""
    return min(2 * gram, gram + max(1, -(-3 * (length - gram) // 4)), length)


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(h)
    x = np.concatenate([h, np.full(-n % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    forward = np.minimum.accumulate(x, axis=1).ravel()
    backward = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def segments(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first suffix, number of suffixes, key, hash of the bytes, key stands twice)."""
    data = np.frombuffer(text, np.uint8)
    width = length - gram + 1
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    h = span_hash(prefix, at, at + gram)
    key = window_minima(h, width)
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    run = np.diff(np.append(start, len(key)))
    if run.max(initial=0) > MAX_RUN:
        pieces = -(-run // MAX_RUN)
        first = np.repeat(start, pieces)
        offset = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * MAX_RUN
        end = np.repeat(start + run, pieces)
        start = first + offset
        run = np.minimum(MAX_RUN, end - start)
    keys = key[start]
    twice = np.array([np.count_nonzero(h[a:a + r + width - 1] == k) > 1 for a, r, k in zip(start, run, keys, strict=True)], bool)
    return start, run, keys, span_hash(prefix, start, start + run - 1 + length), twice


def _segments(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, cols = [], [[], [], [], [], []]
            for row, text in enumerate(text_bytes(batch.column("text"))):
                if len(text) >= length:
                    parts = segments(text, length, gram)
                    of.append(np.full(len(parts[0]), row))
                    for c, p in zip(cols, parts, strict=True):
                        c.append(p)
            if not of:
                continue
            row = np.concatenate(of)
            start, n, key, seg, twice = (np.concatenate(c) for c in cols)
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(row)), batch.column("dk").take(pa.array(row)), pa.array(start.astype(np.int64)),
                 pa.array(n.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(twice)],
                names=["doc_id", "dk", "start", "run", "key", "seg", "twice"])
    return run


def lcp_of(sorted_windows: list[bytes]) -> np.ndarray:
    """Common prefix of each window with the one before it (0 for the first)."""
    n = len(sorted_windows)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    step = max(1, (1 << 22) // len(sorted_windows[0]))
    for lo in range(0, n - 1, step):
        hi = min(n - 1, lo + step)
        m = np.frombuffer(b"".join(sorted_windows[lo:hi + 1]), np.uint8).reshape(hi - lo + 1, -1)
        differ = m[1:] != m[:-1]
        out[lo + 1:hi + 1] = np.where(differ.any(axis=1), differ.argmax(axis=1), m.shape[1])
    return out


def longest_previous_factor(position: list[int], lcp: list[int]) -> list[int]:
    """LPF of each suffix, in suffix order.

    A stack keeps the positions that still wait for a smaller one to their
    right; with the smaller one to their left already below them, the larger
    of the two common prefixes is the longest earlier match.
    """
    n = len(position)
    out = [0] * n
    stack: list[tuple[int, int]] = []  # (index in suffix order, common prefix with the previous smaller position)
    for i in range(n + 1):
        shared = lcp[i] if 0 < i < n else 0
        here = position[i] if i < n else -1
        while stack and position[stack[-1][0]] > here:
            k, left = stack.pop()
            out[k] = max(left, shared)
            shared = min(shared, left)
        if i < n:
            stack.append((i, shared))
    return out


def bucket_matches(segs: list[tuple], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each segment (order key, bytes, suffixes): which suffixes have an
    equal ``length`` bytes earlier, and which earlier or later, in the bucket.

    Segments must come in the order of their places.
    """
    windows, place = [], []
    base = 0
    for _, b, run in segs:
        windows += [b[k:k + length] for k in range(run)]
        place += range(base, base + run)
        base += run
    order = sorted(range(len(windows)), key=windows.__getitem__)
    lcp = lcp_of([windows[i] for i in order])
    earlier, later = np.zeros(base, bool), np.zeros(base, bool)
    # A match of full length lies inside a run of neighbours that share it.
    full = np.flatnonzero(np.diff(np.concatenate(([False], lcp >= length, [False])).astype(np.int8)))
    for lo, hi in zip(full[::2] - 1, full[1::2], strict=True):
        run_order = order[lo:hi]
        shared = [0, *lcp[lo + 1:hi].tolist()]
        position = [place[i] for i in run_order]
        for i, v in zip(run_order, longest_previous_factor(position, shared), strict=True):
            earlier[i] = v >= length
        for i, v in zip(run_order, longest_previous_factor([base - p for p in position], shared), strict=True):
            later[i] = v >= length
    out, at = [], 0
    for _, _, run in segs:
        out.append((earlier[at:at + run], (earlier | later)[at:at + run]))
        at += run
    return out


def _ranges(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_RANGES = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _solve_buckets(length: int, first_only: bool):
    """Rows come sorted by key; each key's rows are one bucket."""
    def solve(key: int, rows: dict[int, tuple]) -> list[tuple]:
        # Null doc_ids last, then by id, text hash and offset.
        segs = sorted(((r[0] is None, r[0] or 0, r[1], r[2]), r[3], r[4], s) for s, r in rows.items())
        found = bucket_matches([x[:3] for x in segs], length)
        return [(key, x[3], _ranges(f[0] if first_only else f[1])) for x, f in zip(segs, found, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, {}, []

        def emit() -> pa.RecordBatch:
            hit = [o for o in out if o[2]]
            out.clear()
            return pa.record_batch([pa.array([o[0] for o in hit], pa.int64()), pa.array([o[1] for o in hit], pa.int64()),
                                    pa.array([o[2] for o in hit], _RANGES)], names=["key", "seg", "ranges"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "seg", "doc_id", "dk", "start", "bytes", "run")]
            for key, seg, *rest in zip(*cols, strict=True):
                if key != now:
                    if rows:
                        out.extend(solve(now, rows))
                    now, rows = key, {}
                rows[seg] = tuple(rest)
            yield emit()
        if rows:
            out.extend(solve(now, rows))
        yield emit()
    return run


def _cut_bytes(length: int):
    """The bytes of each requested segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            # Text of a document (its places start at 0), or bytes of a segment.
            whole = "base" not in batch.schema.names
            bases = [0] * batch.num_rows if whole else batch.column("base").to_pylist()
            texts = text_bytes(batch.column("text")) if whole else batch.column("text").to_pylist()
            for doc, dk, text, wanted, base in zip(batch.column("doc_id").to_pylist(), batch.column("dk").to_pylist(), texts,
                                                   batch.column("wanted").to_pylist(), bases, strict=True):
                rows += [(w["key"], w["seg"], doc, dk, base + w["start"], text[w["start"]:w["start"] + w["run"] - 1 + length], w["run"], w["hot"])
                         for w in wanted]
            cols = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), batch.column("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_()]
            names = ["key", "seg", "doc_id", "dk", "start", "bytes", "run", "hot"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
    return run


def _subsegments(length: int, gram: int):
    """Segments of a segment, by the minima of ``gram``-byte substrings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, cols = [], [[], [], [], [], []]
            for row, b in enumerate(batch.column("bytes")):
                parts = segments(b.as_py(), length, gram)
                of.append(np.full(len(parts[0]), row))
                for c, p in zip(cols, parts, strict=True):
                    c.append(p)
            if not of:
                continue
            row = np.concatenate(of)
            start, n, key, seg, twice = (np.concatenate(c) for c in cols)
            take = pa.array(row)
            key = mix64(batch.column("key").to_numpy().view(np.uint64)[row] ^ mix64(key, gram), 5)
            yield pa.record_batch(
                [*(batch.column(c).take(take) for c in ("key", "seg", "doc_id", "dk")),
                 pa.array(batch.column("start").to_numpy()[row] + start), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(twice)],
                names=["pkey", "pseg", "doc_id", "dk", "start", "offset", "run", "key", "seg", "twice"])
    return run


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of each segment as maximal ones."""
    for batch in batches:
        out = []
        for ranges in batch.column("ranges").to_pylist():
            merged: list[dict] = []
            for r in sorted(ranges, key=lambda r: r["lo"]):
                if merged and r["lo"] <= merged[-1]["hi"]:
                    merged[-1]["hi"] = max(merged[-1]["hi"], r["hi"])
                else:
                    merged.append(dict(r))
            out.append(merged)
        yield pa.record_batch([batch.column("key"), batch.column("seg"), pa.array(out, _RANGES)], names=["key", "seg", "ranges"])


def _deeper(rows: DataFrame, length: int, first_only: bool, gram: int) -> DataFrame:
    """(key, seg, ranges) of the segments of buckets too large for one task, parted by ``gram``-byte minima."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    sub = materialise(rows.mapInArrow(_subsegments(length, gram), f"pkey long, pseg long, doc_id {id_type}, dk long, start long, offset int, "
                                                                   "run int, key long, seg long, twice boolean"), "suffix-sub")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dk", "start")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dk", "start", "pkey", "pseg", "offset")
    distinct = sub.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.first("run").alias("run"),
                                             F.max("twice").alias("twice"))
    whole = F.struct(F.col("offset").alias("lo"), (F.col("offset") + F.col("run")).alias("hi"))
    if gram == length:
        same = (distinct.groupBy("key").agg(F.sum(F.col("n") * F.col("run")).alias("n"), F.min("first").alias("first")).where("n > 1")
                .select("key", F.struct("first.none", "first.doc_id", "first.dk", "first.start").alias("head")))
        hit = sub.join(same, "key")
        if first_only:  # the very first stays
            lo = F.col("offset") + F.when(place.eqNullSafe(F.col("head")), 1).otherwise(0)
            whole = F.struct(lo.alias("lo"), (F.col("offset") + F.col("run")).alias("hi"))
        hit = hit.select("pkey", "pseg", whole.alias("r")).where("r.lo < r.hi")
    else:
        distinct = materialise(distinct, "suffix-sub-distinct")
        bucket = (distinct.groupBy("key").agg(F.count(F.lit(1)).alias("segs"), F.sum("run").alias("suffixes"), F.max("twice").alias("inner"))
                  .where("segs > 1 OR inner").select("key", (F.col("suffixes") > BUCKET).alias("hot")))
        wanted = distinct.join(bucket, "key").select(
            F.col("first.pkey").alias("pkey"), F.col("first.pseg").alias("pseg"),
            F.struct("key", "seg", F.col("first.offset").alias("start"), "run", "hot").alias("w"))
        wanted = wanted.groupBy("pkey", "pseg").agg(F.collect_list("w").alias("wanted"))
        parent = rows.select(F.col("key").alias("pkey"), F.col("seg").alias("pseg"), "doc_id", "dk", F.col("start").alias("base"),
                             F.col("bytes").alias("text"))
        cut = materialise(parent.join(wanted, ["pkey", "pseg"]).mapInArrow(
            _cut_bytes(length), f"key long, seg long, doc_id {id_type}, dk long, start long, bytes binary, run int, hot boolean"), "suffix-sub-bytes")
        solved = _solve(cut, length, first_only, longer_gram(gram, length)).withColumnsRenamed({"key": "k2", "seg": "s2"})
        marked = (distinct.join(solved, (F.col("key") == F.col("k2")) & (F.col("seg") == F.col("s2")), "left")
                  .where("n > 1 OR ranges IS NOT NULL").select("key", "seg", "n", "first", "ranges"))
        of = sub.join(marked, ["key", "seg"])
        all_of = F.array(F.struct(F.lit(0).alias("lo"), F.col("run").alias("hi")))
        copy = (F.col("n") > 1) & (~at.eqNullSafe(F.col("first")) if first_only else F.lit(True))
        of = of.select("pkey", "pseg", "offset", F.explode(F.when(copy, all_of).otherwise(F.col("ranges"))).alias("r"))
        hit = of.select("pkey", "pseg", F.struct((F.col("offset") + F.col("r.lo")).alias("lo"), (F.col("offset") + F.col("r.hi")).alias("hi")).alias("r"))
    # A segment has at most MAX_RUN suffixes, so its list is bounded.
    lists = hit.groupBy(F.col("pkey").alias("key"), F.col("pseg").alias("seg")).agg(F.collect_set("r").alias("ranges"))
    return lists.mapInArrow(_merge_ranges, "key long, seg long, ranges array<struct<lo:int,hi:int>>")


def _solve(cut: DataFrame, length: int, first_only: bool, gram: int) -> DataFrame:
    """(key, seg, ranges) of cut segments; the hot buckets by minima of ``gram`` bytes."""
    solved = (cut.where("NOT hot").drop("hot").repartition("key").sortWithinPartitions("key")
              .mapInArrow(_solve_buckets(length, first_only), "key long, seg long, ranges array<struct<lo:int,hi:int>>"))
    if cut.where("hot").isEmpty():
        return solved
    return solved.unionByName(_deeper(cut.where("hot").drop("hot").dropDuplicates(["key", "seg"]), length, first_only, gram))


def repeated_ranges(docs: DataFrame, length: int = 400, keep: str = "none") -> DataFrame:
    """(dk, lo, hi): suffixes lo <= p < hi of row ``dk`` start a removed string."""
    gram = min(GRAM, max(1, length // 4))
    first_only = keep == "first"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("dk"))
    seg = materialise(rows.mapInArrow(
        _segments(length, gram), f"doc_id {id_type}, dk long, start long, run int, key long, seg long, twice boolean"), "suffix-segments")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dk", "start")
    distinct = materialise(seg.groupBy("key", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.first("run").alias("run"), F.max("twice").alias("twice")), "suffix-distinct")
    bucket = (distinct.groupBy("key").agg(F.count(F.lit(1)).alias("segs"), F.sum("run").alias("suffixes"), F.max("twice").alias("inner"))
              .where("segs > 1 OR inner").select("key", (F.col("suffixes") > BUCKET).alias("hot")))
    wanted = distinct.join(bucket, "key").select(
        F.col("first.dk").alias("of"), F.struct("key", "seg", F.col("first.start").alias("start"), "run", "hot").alias("w"))
    wanted = materialise(wanted.groupBy("of").agg(F.collect_list("w").alias("wanted")), "suffix-wanted")
    cut = join_small(rows, wanted, F.col("dk") == F.col("of"), "inner", BROADCAST_ITEMS, F.size("wanted")).mapInArrow(
        _cut_bytes(length), f"key long, seg long, doc_id {id_type}, dk long, start long, bytes binary, run int, hot boolean")
    cut = materialise(cut, "suffix-bytes")
    solved = _solve(cut, length, first_only, longer_gram(gram, length))
    solved = solved.withColumnsRenamed({"key": "k2", "seg": "s2"})
    marked = (distinct.join(solved, (F.col("key") == F.col("k2")) & (F.col("seg") == F.col("s2")), "left")
              .where("n > 1 OR ranges IS NOT NULL").select("key", "seg", "n", F.col("first").alias("head"), "run", "ranges"))
    marked = materialise(marked, "suffix-marked")
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("run").alias("hi")))
    found = seg.select("doc_id", "dk", "start", "key", "seg").join(marked, ["key", "seg"])
    if first_only:
        later = (F.col("n") > 1) & ~place.eqNullSafe(F.col("head"))
        of = F.when(later, whole).otherwise(F.col("ranges"))
    else:
        of = F.when(F.col("n") > 1, whole).otherwise(F.col("ranges"))
    return (found.select("dk", "start", F.explode(of).alias("r"))
            .select("dk", (F.col("start") + F.col("r.lo")).alias("lo"), (F.col("start") + F.col("r.hi")).alias("hi")))


def _removed_spans(ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings that start in the ranges."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] + length - 1) for r in ranges or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 400, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and kept (bytes)."""
    spans = repeated_ranges(docs, length, keep).distinct()
    per_doc = materialise(spans.groupBy("dk").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "suffix-spans")
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    joined = join_small(rows, per_doc, F.col("row") == F.col("dk"), "left", BROADCAST_ITEMS, F.size("ranges")).select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(text_bytes(batch.column("text")), batch.column("ranges").to_pylist(), strict=True):
                cut = _removed_spans(ranges, length)
                at, left = 0, []
                for a, b in cut:
                    left.append(text[at:a])
                    at = b
                kept = b"".join([*left, text[at:]])
                out.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                            [{"lo": a, "hi": b} for a, b in cut], kept))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary()]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                  "spans array<struct<lo:bigint,hi:bigint>>, kept binary")
