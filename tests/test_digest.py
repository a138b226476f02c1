import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.digest import DigestTrace, qa_diff_tree
from tidemark.operators.qa import qa_diff

SCHEMA = "id long, name string, x double"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sides(seed, n=2000, changes=12):
    rng = random.Random(seed)
    a = [(k * 3 - 500, rng.choice(["p", "q", None]), rng.random()) for k in range(n)] + [(None, "null key", 1.0)]
    b = list(a)
    for _ in range(changes):
        k = rng.randrange(len(b))
        kind = rng.randrange(5)
        if kind == 0:
            b[k] = (b[k][0], "changed", b[k][2])
        elif kind == 1:
            b.pop(k)
        elif kind == 2:
            b.append((10**7 + k, "new", 0.0))
        elif kind == 3:
            b.append(b[k])
        else:
            b[k] = (b[k][0], None if b[k][1] else "p", b[k][2])
    rng.shuffle(b)
    return a, b


@pytest.mark.parametrize("seed,leaf,fanout,most", [(1, 50, 4, 100), (2, 1, 16, 100), (3, 50, 4, 2), (4, 10**6, 256, 100)])
def test_equal_to_the_keyed_diff(spark, seed, leaf, fanout, most):
    a, b = (spark.createDataFrame(r, SCHEMA) for r in sides(seed))
    for keys in (["id"], ["name", "id"]):
        assert got(qa_diff_tree(a, b, keys, leaf_rows=leaf, fanout=fanout, max_ranges=most)) == got(qa_diff(a, b, keys))


def test_descends_only_where_copies_differ(spark):
    a = spark.createDataFrame([(k, "v", k / 7) for k in range(40000)], SCHEMA)
    b = a.withColumn("x", F.when(F.col("id") == 12345, F.lit(-1.0)).otherwise(F.col("x")))
    trace = DigestTrace()
    out = got(qa_diff_tree(a, b, ["id"], leaf_rows=100, fanout=16, trace=trace))
    assert out == [(12345, "changed", "x")]
    assert [d for _, d in trace.levels] == [1] * len(trace.levels) and len(trace.levels) >= 3
    assert got(qa_diff_tree(a, a, ["id"])) == []


def test_extremes_and_empty(spark):
    ends = [(-(2**63), "a", 1.0), (2**63 - 1, "b", 2.0), (0, None, None)]
    a, b, none = (spark.createDataFrame(r, SCHEMA) for r in (ends, ends[:2] + [(0, "", None)], []))
    for leaf in (1, 100):
        assert got(qa_diff_tree(a, b, ["id"], leaf_rows=leaf)) == [(0, "changed", "name")]
    assert got(qa_diff_tree(none, none, ["id"])) == []
    assert got(qa_diff_tree(a, none, ["id"], leaf_rows=1)) == sorted([(r[0], "only_a", None) for r in ends], key=str)


def test_a_level_reads_each_copy_once(spark):
    """Rows pass the digest once a level, besides the key span before and the keyed diff after."""
    n = 3000
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    a = spark.range(n).selectExpr("id", "cast(id as string) as name", "id / 7 as x")
    b = a.withColumn("x", F.when(F.col("id") == 1234, -1.0).otherwise(F.col("x")))
    trace = DigestTrace()
    out = qa_diff_tree(a.mapInArrow(count, a.schema), b.mapInArrow(count, b.schema), ["id"], leaf_rows=1, fanout=16, trace=trace)
    assert seen.value == 2 * n * (1 + len(trace.levels))  # a Python scan takes no filter: whole copies each time
    assert got(out) == [(1234, "changed", "x")]


def test_repeated_and_null_rows_are_told_apart(spark):
    """Sums of hash parts see how often a row occurs, and where its nulls are."""
    a = spark.createDataFrame([(1, "p", 1.0)] * 4 + [(2, None, 2.0)], SCHEMA)
    cases = [([(1, "p", 1.0)] * 6 + [(2, None, 2.0)], (1, "duplicate_key", None)),
             ([(1, "p", 1.0)] * 4 + [(2, "p", None)], (2, "changed", "name,x"))]
    for other, expected in cases:
        trace = DigestTrace()
        b = spark.createDataFrame(other, SCHEMA)
        assert got(qa_diff_tree(a, b, ["id"], leaf_rows=1, fanout=2, trace=trace)) == [expected]
        assert trace.levels[0] == (2, 1)
