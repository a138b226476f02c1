"""Mixing sources to target weights by pivotal dependent rounding.

Every document owes ``ratio = target / source_size`` copies.  The whole part
is taken as it is; the fractional parts are rounded together by the pivotal
method.  Two documents meet, words move from one to the other in a random
direction until one of them is taken wholly or not at all, and the other
carries the sum on.  A step never changes the words of the pair, so a source
keeps its total exactly, and each document's expected words stay its share.

The steps run as a reduction tree: random groups of ``FAN_IN`` documents of a
source leave one undecided document each, these meet in groups again, and so
on until one is left per source.  That one takes its remaining words as part
of a copy, so the source's total misses its target by a rounding of words.

Only DataFrame and SQL functions are used.

Defined cases: null text counts 0 words; the null source is a source of its
own, ranked last; documents of size 0 take 0 words; a table without words has
targets of 0; rows with equal doc_id are documents of their own; columns
other than doc_id, text and source are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_RE, columns_named, join_small, materialise

FAN_IN = 64
MAX_COPIES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """Target words per source: shares by weight, at most ``max_copies`` sizes.

    Capping and resharing until none is above is water filling.  With sources
    in the order of cap / weight, the level is the largest of
    ``(total - caps before) / (weights from here)``.  The table holds one row
    per source, so its window runs over the distinct sources only.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((rank - 1) % len(weights) + 1).cast("int"))
    t = by_source.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    order = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    t = t.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(here_on))
    t = t.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return t.select("source", "source_size", target.alias("target"))


# One pivotal step between the carried document c and the next document d.
# give: words c can take from d; lose: words c can hand to d.  The draw depends
# only on the two documents' own numbers, so a rerun draws alike.
_STEP = """
aggregate(
  slice(units, 2, size(units)),
  named_struct('cur', units[0], 'done', cast(array() as array<struct<h:bigint,k:bigint,s:bigint,x:double>>)),
  (acc, d) -> transform(array(named_struct(
      'c', acc.cur, 'done', acc.done,
      'give', least(acc.cur.s - acc.cur.x, d.x),
      'lose', least(acc.cur.x, d.s - d.x),
      'u', pmod(xxhash64(acc.cur.h, d.h, {seed}), 9007199254740992) / 9007199254740992D)),
    z -> if(z.u * (z.give + z.lose) < z.lose OR z.give + z.lose = 0,
      if(z.c.s - z.c.x <= d.x,
        named_struct('cur', named_struct('h', d.h, 'k', d.k, 's', d.s, 'x', d.x - (z.c.s - z.c.x)),
          'done', concat(z.done, array(named_struct('h', z.c.h, 'k', z.c.k, 's', z.c.s, 'x', cast(z.c.s as double))))),
        named_struct('cur', named_struct('h', z.c.h, 'k', z.c.k, 's', z.c.s, 'x', z.c.x + d.x),
          'done', concat(z.done, array(named_struct('h', d.h, 'k', d.k, 's', d.s, 'x', 0D))))),
      if(z.c.x <= d.s - d.x,
        named_struct('cur', named_struct('h', d.h, 'k', d.k, 's', d.s, 'x', d.x + z.c.x),
          'done', concat(z.done, array(named_struct('h', z.c.h, 'k', z.c.k, 's', z.c.s, 'x', 0D)))),
        named_struct('cur', named_struct('h', z.c.h, 'k', z.c.k, 's', z.c.s, 'x', z.c.x - (d.s - d.x)),
          'done', concat(z.done, array(named_struct('h', d.h, 'k', d.k, 's', d.s, 'x', cast(d.s as double))))))))[0])
"""


def pivotal_round(units: DataFrame, seed: int) -> DataFrame:
    """(group, h, k, s, x): words x of s still open -> (k, x) decided.

    Each level deals a group's units over ``ceil(n / FAN_IN)`` random buckets,
    so a hot source is many buckets; a bucket holds about FAN_IN units.
    """
    decided, level = None, 0
    while True:
        sizes = units.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.agg(F.max("n")).first()[0]
        if largest is None or (largest == 1 and level):
            break
        dealt = join_small(units, sizes.withColumnRenamed("group", "g"), F.col("group") == F.col("g"), "inner")
        bucket = F.pmod(F.xxhash64("h", F.lit(seed + 101 * level)), F.ceil(F.col("n") / FAN_IN).cast("long"))
        grouped = (dealt.groupBy("group", bucket.alias("bucket"))
                   .agg(F.sort_array(F.collect_list(F.struct("h", "k", "s", "x"))).alias("units")))
        done = materialise(grouped.select("group", F.expr(_STEP.format(seed=seed + level)).alias("r")), "pivotal")
        out = done.select(F.explode("r.done").alias("u")).select("u.k", "u.x")
        decided = out if decided is None else decided.unionByName(out)
        units = done.select("group", "r.cur.h", "r.cur.k", "r.cur.s", "r.cur.x")
        level += 1
    last = units.select("k", "x")
    return last if decided is None else decided.unionByName(last)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                max_copies: int = MAX_COPIES, seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    The columns named in ``carry`` go along behind doc_id.

    ``copies`` counts whole copies; ``taken`` also holds the part of a copy
    that the last document of a source takes.
    """
    carried = [c.alias(f"__{n}") for c, n in zip(columns_named(carry), carry, strict=True)]
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carried)
    sized = materialise(sized.withColumn("k", F.monotonically_increasing_id()), "mix-sizes")
    targets = materialise(source_targets(sized.select("source", "size"), weights, max_copies), "mix-targets").withColumnRenamed("source", "src")
    owed = join_small(sized, targets, F.col("source").eqNullSafe(F.col("src")), "left").drop("src")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    owed = owed.withColumn("whole", F.floor(ratio).cast("long")).withColumn("x", (ratio - F.col("whole")) * F.col("size"))
    # Documents without an id are told apart by their row, all others by id and size.
    h = F.when(F.col("doc_id").isNull(), F.xxhash64("k", "size")).otherwise(F.xxhash64("doc_id", "size"))
    units = (owed.where("x > 0").withColumn("h", h)
             .select(F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).alias("group"),
                     "h", "k", F.col("size").alias("s"), "x"))
    # Rows equal in id and size draw alike; where many are, their rows tell them apart, so that they share no bucket.
    many = units.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FAN_IN).select(F.col("h").alias("many"))
    units = join_small(units, many, F.col("h") == F.col("many"))
    units = units.withColumn("h", F.when(F.col("many").isNotNull(), F.xxhash64("h", "k")).otherwise(F.col("h"))).drop("many")
    decided = pivotal_round(units, seed)
    j = owed.join(decided.select("k", F.col("x").alias("extra")), "k", "left")
    extra = F.coalesce(F.round("extra").cast("long"), F.lit(0).cast("long"))
    taken = F.col("whole") * F.col("size") + extra
    copies = F.when(F.col("size") > 0, F.floor(taken / F.col("size"))).otherwise(F.lit(0)).cast("long")
    return j.select("doc_id", *[c.alias(n) for c, n in zip(columns_named(f"__{n}" for n in carry), carry, strict=True)], "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"))
