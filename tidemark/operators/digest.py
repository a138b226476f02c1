"""Diff of two copies of a table by a digest tree.

Both copies are cut into nested ranges of a key.  A range's digest is an
order-free sum of its rows' hashes, with their number, so it is aggregated in
the scan and only one row a range and task is shuffled.  The search descends
into the ranges that differ, until they are small; their rows alone go through
the keyed diff.  Copies that agree cost one pass and no row shuffle.

For a single whole-number key the ranges are intervals of the key, so each
descent is a filter that reaches the scan and skips row groups.  Other keys
are cut by ranges of their hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.functions.columns import col
from tidemark.operators.qa import qa_diff

#: Ranges that a range is cut into, and differing ranges that a filter may name.
FANOUT = 256
MAX_RANGES = 2048


@dataclass
class DigestTrace:
    """Per level: ranges compared, ranges that differ, rows below those on both sides."""

    levels: list = field(default_factory=list)


#: A hash is summed in parts of so many bits, as longs: exact up to 2**41 rows a range.
PART_BITS = 22
DIGEST = ["n", *[f"{h}{k}" for h in ("s", "t") for k in range(3)]]


def _digest(df: DataFrame, columns: list[str]) -> list[Column]:
    """Number and order-free sums of the rows' hashes; two independent hashes make a collision remote."""
    row = F.struct(*[col(c) for c in columns])
    # A hash passes over nulls, so their pattern is hashed as well.
    nulls = F.concat(*[F.when(col(c).isNull(), "1").otherwise("0") for c in columns])
    one, two = F.xxhash64(row, nulls), F.xxhash64(F.lit(17), nulls, row)
    parts = [F.sum(F.shiftrightunsigned(h, k * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1))) for h in (one, two) for k in range(3)]
    return [c.alias(name) for c, name in zip([F.count(F.lit(1)), *parts], DIGEST)]


def _hash_keys(keys: list[str]) -> Column:
    return F.xxhash64(*[col(k) for k in keys])


def _span(a: DataFrame, b: DataFrame, key: str) -> tuple[int, int] | None:
    ends = [d.agg(F.min(col(key)).alias("lo"), F.max(col(key)).alias("hi")).first() for d in (a, b)]
    ends = [e for e in ends if e.lo is not None]
    return (min(e.lo for e in ends), max(e.hi for e in ends)) if ends else None


def qa_diff_tree(a: DataFrame, b: DataFrame, keys: list[str], leaf_rows: int = 100_000, fanout: int = FANOUT,
                 max_ranges: int = MAX_RANGES, max_depth: int = 8, trace: DigestTrace | None = None) -> DataFrame:
    """The rows of :func:`qa_diff`, found by descending into differing ranges.

    ``leaf_rows``: a range with at most so many rows on both sides is diffed as it is.
    """
    columns = sorted(a.columns, key=str.lower)
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError("the two frames have different columns")
    whole = len(keys) == 1 and all(isinstance(d.schema[keys[0]].dataType, IntegralType) for d in (a, b))
    place = col(keys[0]).cast("long") if whole else _hash_keys(keys)
    lo, hi = ((_span(a, b, keys[0]) or (0, 0)) if whole else (-(2**63), 2**63 - 1))
    # Ranges [lo, hi] of the place; None stands for a null key.
    open_ranges: list[tuple[int, int] | None] = [(lo, hi), *([None] if whole else [])]
    leaves: list[tuple[int, int] | None] = []

    def within(ranges: list) -> Column:
        """Condition that a row's place lies in one of the ranges; neighbours are one interval."""
        joined: list[list[int]] = []
        for x, y in sorted(r for r in ranges if r is not None):
            if joined and x <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], y)
            else:
                joined.append([x, y])
        at = col(keys[0]) if whole else place  # the bare column: its comparisons reach the scan
        conds = [at.between(F.lit(x), F.lit(y)) for x, y in joined]
        if None in ranges:
            conds.append(place.isNull())
        return reduce(Column.__or__, conds) if conds else F.lit(False)

    for depth in range(max_depth):
        if not open_ranges:
            break
        steps = [(r[0], max(1, -(-(r[1] - r[0] + 1) // fanout))) for r in open_ranges if r is not None]
        if steps:
            # Ranges of one level have one width, but for the first.
            width = max(s for _, s in steps)
            low = min(x for x, _ in steps)
            if hi - lo < 2**63:
                number = F.call_function("div", place - F.lit(low), F.lit(width))
            else:  # the distance of two longs may not fit one
                number = F.floor((place.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        else:
            width, low, number = 1, 0, F.lit(None)
        number = number.cast("long" if hi - lo < 2**63 else "decimal(20,0)")
        sides = [d.where(within(open_ranges)).groupBy(number.alias("r")).agg(*_digest(d, columns)) for d in (a, b)]
        tagged = sides[0].withColumn("side", F.lit(0)).unionByName(sides[1].withColumn("side", F.lit(1)))
        per = tagged.groupBy("r").agg(*[F.sum(F.when(F.col("side") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in DIGEST])
        # One row a range, at most ``fanout`` times ``max_ranges``: kept, so that the copies are read once a level.
        per = per.persist()
        same = reduce(Column.__and__, [F.col(f"{c}0").eqNullSafe(F.col(f"{c}1")) for c in DIGEST])
        summary = per.agg(F.count(F.lit(1)).alias("ranges"), F.count_if(~same).alias("differ")).first()
        if trace is not None:
            trace.levels.append((summary.ranges, summary.differ))
        if summary.differ > max_ranges:
            leaves += open_ranges  # too scattered to name: the ranges above are diffed as they are
            per.unpersist()
            break
        rows = F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))
        found = [(None if r.r is None else int(r.r), r.n) for r in per.where(~same).select("r", rows.alias("n")).collect()]
        per.unpersist()
        open_ranges = []
        for r, n in found:
            here = None if r is None else (low + r * width, min(low + (r + 1) * width - 1, hi))
            if here is None or n <= leaf_rows or width == 1 or depth == max_depth - 1:
                leaves.append(here)
            else:
                open_ranges.append(here)
    return qa_diff(a.where(within(leaves)), b.where(within(leaves)), keys)
