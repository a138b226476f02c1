import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators.upsert import (
    assert_unique_keys,
    dedupe_latest,
    duplicate_keys,
    fits_broadcast,
    merge_counts,
    size_checked_broadcast,
    upsert_frames,
    with_missing_columns,
    without_older,
)

SCHEMA = "id int, part string, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_in_source_overwrites_target(spark):
    tgt = spark.createDataFrame([(1, "a", "old"), (2, "a", "keep")], SCHEMA)
    src = spark.createDataFrame([(1, "a", None)], SCHEMA)
    assert rows(upsert_frames(tgt, src, ["id"])) == [(1, "a", None), (2, "a", "keep")]


def test_null_key_part_matches_null_safe(spark):
    tgt = spark.createDataFrame([(1, None, "old")], SCHEMA)
    src = spark.createDataFrame([(1, None, "new")], SCHEMA)
    assert rows(upsert_frames(tgt, src, ["id", "part"])) == [(1, None, "new")]


def test_composite_key_inserts_row_of_other_partition(spark):
    tgt = spark.createDataFrame([(1, "a", "old")], SCHEMA)
    src = spark.createDataFrame([(1, "b", "new")], SCHEMA)
    assert rows(upsert_frames(tgt, src, ["id", "part"])) == [(1, "a", "old"), (1, "b", "new")]
    assert rows(upsert_frames(tgt, src, ["id"])) == [(1, "b", "new")]


def test_empty_source_keeps_target(spark):
    tgt = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    src = spark.createDataFrame([], SCHEMA)
    assert rows(upsert_frames(tgt, src, ["id"])) == [(1, "a", "x")]


def test_column_order_follows_target_and_sets_must_agree(spark):
    tgt = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    src = spark.createDataFrame([("y", 2, "a")], "v string, id int, part string")
    assert upsert_frames(tgt, src, ["id"]).columns == ["id", "part", "v"]
    with pytest.raises(ValueError):
        upsert_frames(tgt, src.drop("v"), ["id"])


def test_duplicate_source_keys_raise_or_dedupe(spark):
    src = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (2, "a", "z", 1)],
                                "id int, part string, v string, ts int")
    assert [tuple(r) for r in duplicate_keys(src, ["id"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        assert_unique_keys(src, ["id"])
    out = dedupe_latest(src, ["id"], "ts")
    assert rows(out) == [(1, "a", "y", 2), (2, "a", "z", 1)]


def test_dedupe_hot_key_is_partially_aggregated(spark):
    big = spark.range(0, 30000).selectExpr("cast(id % 3 = 0 as int) * 0 + cast(id as int) % 2 as k",
                                           "cast(id as int) as ts")
    plan = dedupe_latest(big, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    # a group limit runs before the exchange: one row per key and task is shuffled
    before_exchange = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in before_exchange
    assert rows(dedupe_latest(big, ["k"], "ts")) == [(0, 29998), (1, 29999)]


def test_broadcast_only_with_known_small_size(spark):
    df = spark.createDataFrame([(1,)], "id int")
    hinted = size_checked_broadcast(df, 10)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    plain = size_checked_broadcast(df, None)
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in size_checked_broadcast(df, 10**12)._jdf.queryExecution().analyzed().toString().lower()


def test_merge_counts(spark):
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "a", "x")], SCHEMA)
    src = spark.createDataFrame([(2, "a", "y"), (3, "a", "y")], SCHEMA)
    assert merge_counts(tgt, src, ["id"]) == {"source_rows": 2, "updated": 1, "inserted": 1}


keys_st = st.lists(st.integers(0, 12), max_size=12, unique=True)


@settings(max_examples=15, deadline=None)
@given(keys_st, keys_st)
def test_upsert_properties(spark, tk, sk):
    tgt = spark.createDataFrame([(k, "a", "t") for k in tk], SCHEMA)
    src = spark.createDataFrame([(k, "a", "s") for k in sk], SCHEMA)
    once = upsert_frames(tgt, src, ["id"])
    twice = upsert_frames(once, src, ["id"])
    got = rows(once)
    assert got == rows(twice)                                   # idempotent
    assert sorted(r[0] for r in got) == sorted(set(tk) | set(sk))  # |target ∪ source| keys
    assert all(v == "s" for k, _, v in got if k in set(sk))      # source wins


def test_known_small_source_broadcasts_keys_and_never_shuffles_target(spark, tmp_root):
    tgt_path = f"{tmp_root}/tgt"
    spark.range(0, 5000).selectExpr("cast(id as int) as id", "'a' as part", "'t' as v").write.parquet(tgt_path)
    tgt = spark.read.parquet(tgt_path)
    src = spark.createDataFrame([(1, "a", "s")], SCHEMA)
    plan = upsert_frames(tgt, src, ["id"], source_rows=1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "Exchange hashpartitioning" not in plan      # the target side is not shuffled


def test_broadcast_bound_counts_what_a_hashed_row_takes(spark):
    df = spark.createDataFrame([(1, "199501")], "id long, part string")
    assert fits_broadcast(df, 100_000)
    # A million such rows take about 145 MB on the driver and on every executor.
    assert not fits_broadcast(df, 1_000_000)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("limit", [0, 10**6])
def test_missing_columns_and_age_by_either_join(spark, limit):
    tgt = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, None, "z"), (4, "a", "w")], SCHEMA)
    src = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id int, part string")
    full = with_missing_columns(tgt, src, ["id", "part"], source_rows=3, broadcast_limit=limit)
    assert sorted(map(tuple, full.collect()), key=str) == [(1, "a", "x"), (1, "a", "y"), (2, None, "z"), (3, "a", None)]
    old = spark.createDataFrame([(1, 5), (1, 9), (2, None), (None, 7)], "id int, t int")
    new = spark.createDataFrame([(1, 8), (2, 1), (None, 7), (3, 0)], "id int, t int")
    left = without_older(old, new, ["id"], "t", source_rows=4, broadcast_limit=limit)
    assert sorted(map(tuple, left.collect()), key=str) == [(2, 1), (3, 0), (None, 7)]
    # Keys too many to broadcast: the target is joined once, not narrowed by a shuffled join first.
    for df in (full, left):
        assert ("LeftSemi" in plan_of(df)) == (limit > 0)
        assert ("strategy=broadcast" in plan_of(df)) == (limit > 0)


def test_known_large_frames_are_not_broadcast_by_guess(spark):
    """A plan-size guess far below the planner's own bound does not broadcast rows known to be many."""
    tgt = spark.createDataFrame([(1, 5), (2, 9)], "id int, t int")
    src = spark.createDataFrame([(1, 8), (2, 1)], "id int, t int")
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0
    for df in (without_older(tgt, src, ["id"], "t", source_rows=1_000_000), upsert_frames(tgt, src, ["id"], source_rows=1_000_000)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [tuple(r) for r in without_older(tgt, src, ["id"], "t", source_rows=1_000_000).collect()] == [(1, 8)]


def test_many_source_keys_are_not_broadcast(spark, tmp_root):
    """Known sizes far beyond the bound: the upsert's joins stay shuffle joins."""
    spark.range(0, 500).selectExpr("cast(id as int) as id", "'a' as part", "'t' as v").write.parquet(f"{tmp_root}/tgt")
    tgt = spark.read.parquet(f"{tmp_root}/tgt")
    src = spark.createDataFrame([(1, "a", "s"), (501, "b", "s")], SCHEMA)
    for rows_known in (1_000_000, 10_000_000):
        out = upsert_frames(tgt, src, ["id", "part"], source_rows=rows_known)
        assert "strategy=broadcast" not in plan_of(out)
        assert out.count() == 501 and {r.id for r in out.where("v = 's'").collect()} == {1, 501}
