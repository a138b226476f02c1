from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.audit import control_row, watermark_row
from tidemark.operators.qa import qa_diff, qa_union

SCHEMA = "id int, a string, b int"


def test_qa_diff_statuses(spark):
    x = spark.createDataFrame([(1, "p", 1), (2, "q", 2), (3, None, 3), (5, "d", 1), (5, "d", 2)], SCHEMA)
    y = spark.createDataFrame([(1, "p", 1), (2, "Q", 2), (3, None, 4), (4, "n", 0), (5, "d", 1)], SCHEMA)
    got = {r.id: (r.status, r.changed_columns) for r in qa_diff(x, y, ["id"]).collect()}
    assert got == {2: ("changed", "a"), 3: ("changed", "b"), 4: ("only_b", None), 5: ("duplicate_key", None)}
    same = qa_diff(x, y, ["id"], include_same=True).where("status = 'same'").count()
    assert same == 1


def test_qa_union_with_id_list(spark):
    # the reference's list had a stray "--" inside the first quoted id: only the second matches
    x = spark.createDataFrame([("a1", "p", 1), ("a2", "q", 2)], "id string, a string, b int")
    y = spark.createDataFrame([("a2", "q", 2)], "id string, a string, b int")
    out = qa_union(x, y, ("DEV", "PROD"), key="id", ids=["--a1", "a2"])
    assert sorted((r.instance, r.id) for r in out.collect()) == [("DEV", "a2"), ("PROD", "a2")]


def test_watermark_row_casts_before_max(spark):
    # as text the +0300 value sorts last; as a time it is earlier
    main = spark.createDataFrame([("2024-01-01T01:00:00.000+0300",), ("2024-01-01T00:00:00.000Z",)], "m string")
    row = watermark_row(main, "T", "m").first()
    assert row.table_name == "T"
    assert row.last_modified == datetime(2024, 1, 1, 0, 0)
    assert row.run_time is not None
    prev = F.lit("2025-01-01 00:00:00").cast("timestamp")
    assert watermark_row(main, "T", "m", previous=prev).first().last_modified == datetime(2025, 1, 1)


def test_control_row_counts(spark):
    stage = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-02-01 00:00:00",)], "m string")
    r = control_row(stage, "T", "m", inserted=1, updated=1).first()
    assert (r.merge_count, r.source_success_rows, r.inserted_rows, r.updated_rows) == (2, 2, 1, 1)
    assert r.max_date_check == datetime(2024, 2, 1)


def test_qa_union_long_id_list_uses_semi_join(spark):
    x = spark.range(0, 3000).selectExpr("id", "cast(id as string) as a", "1 as b")
    out = qa_union(x, x, key="id", ids=list(range(0, 3000, 2)))
    assert out.count() == 3000
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString() or \
        "broadcast" in out._jdf.queryExecution().optimizedPlan().toString().lower()
