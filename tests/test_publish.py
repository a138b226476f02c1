import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import switch as sw
from tidemark.sinks.bucketed import JOIN_CONF, _settings, create_bucketed, merged_buckets, upsert_bucketed
from tidemark.sinks.catalog import create_table
from tidemark.sinks.generated import merge_overwrite_sql, run_generated

SCHEMA = "id long, v string, part string"


@pytest.fixture()
def name(spark):
    n = f"t_{uuid.uuid4().hex[:10]}"
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def data():
    return [(k, f"r{k}", f"2024{k % 3:02d}") for k in range(60)]


def change():
    return [(k, f"s{k}", f"2024{k % 3:02d}") for k in range(0, 60, 3)] + [(100, "new", "202400"), (101, None, "202407")]


def merged(old, new):
    have = {(r[0], r[2]): r for r in old}
    have.update({(r[0], r[2]): r for r in new})
    return sorted(have.values(), key=str)


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select("id", "v", "part").collect()), key=str)


def test_bucketed_upsert_moves_no_target_row(spark, name, tmp_root):
    create_bucketed(spark.createDataFrame(data(), SCHEMA), name, f"{tmp_root}/t", ["id"], "part", 4)
    source = spark.createDataFrame(change(), SCHEMA)
    with _settings(spark, JOIN_CONF):
        plan = merged_buckets(spark, source, name, ["id"], "part", 4, ["202400"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(k for k, x in enumerate(lines) if "FileScan" in x)
    depth = lines[scan].index("FileScan")
    above = [x for x in lines[:scan] if 0 <= x.find("Exchange") < depth]
    assert not above and "SortMergeJoin" in plan and "SelectedBucketsCount" in lines[scan]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    assert sorted(upsert_bucketed(source, name, ["id"], "part", 4)) == ["202400", "202407"]
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    assert rows(spark, name) == merged(data(), change())
    # Again, onto the rewritten buckets: the layout has held.
    upsert_bucketed(source.withColumn("v", F.lit("again")), name, ["id"], "part", 4)
    assert rows(spark, name) == merged(merged(data(), change()), [(i, "again", p) for i, _, p in change()])
    files = spark.table(name).where("part = '202400'").select("_metadata.file_name").distinct().count()
    assert files <= 4


def test_bucketed_refuses_null_and_double_keys(spark, name, tmp_root):
    create_bucketed(spark.createDataFrame(data(), SCHEMA), name, f"{tmp_root}/t", ["id"], "part", 2)
    with pytest.raises(ValueError, match="null"):
        upsert_bucketed(spark.createDataFrame([(None, "x", "202400")], SCHEMA), name, ["id"], "part", 2)
    with pytest.raises(ValueError, match="duplicate"):
        upsert_bucketed(spark.createDataFrame([(1, "x", "202400")] * 2, SCHEMA), name, ["id"], "part", 2)


def test_a_stopped_run_leaves_readers_on_the_old_rows(spark, name, tmp_root):
    path = f"{tmp_root}/t"
    old = spark.createDataFrame(data() + [(900, "none", None)], SCHEMA)
    create_table(spark, name, old.schema, "part", path)
    sw.publish_overwrite(old, name, path, "part")
    want = sorted(data() + [(900, "none", None)], key=str)
    assert rows(spark, name) == want and sw.unused_versions(spark, name, path, "part") == []
    source = spark.createDataFrame(change() + [(900, "upd", None)], SCHEMA)

    def lost():
        raise RuntimeError("lost before the switch")

    for publish in (lambda: sw.publish_upsert(source, name, path, ["id"], "part", before_switch=lost),
                    lambda: sw.publish_overwrite(source, name, path, "part", before_switch=lost)):
        with pytest.raises(RuntimeError, match="lost"):
            publish()
        assert rows(spark, name) == want
    assert len(sw.unused_versions(spark, name, path, "part")) == 2
    seen = sw.locations(spark, name, "part")
    sw.publish_upsert(source, name, path, ["id"], "part")
    assert rows(spark, name) == merged(want, change() + [(900, "upd", None)])
    now = sw.locations(spark, name, "part")
    assert now["202401"] == seen["202401"] and now["202400"] != seen["202400"]  # an untouched partition keeps its files
    sw.publish_overwrite(spark.createDataFrame([(1, "only", "202402")], SCHEMA), name, path, "part")
    assert rows(spark, name) == [(1, "only", "202402")] and set(sw.locations(spark, name, "part")) == {"202402"}


def test_generated_statement_runs(spark, name, tmp_root):
    spark.createDataFrame(data() + [(None, "nk", "202400"), (5, "np", None)], SCHEMA).write.partitionBy("part").option(
        "path", f"{tmp_root}/t").saveAsTable(name)
    src = change() + [(None, "nk2", "202400"), (5, "np2", None)]
    spark.createDataFrame(src, SCHEMA).createOrReplaceTempView("generated_src")
    sql = merge_overwrite_sql(name, "generated_src", ["id", "v", "part"], ["id"], "part")
    run_generated(spark, sql)
    assert rows(spark, name) == merged(data() + [(None, "nk", "202400"), (5, "np", None)], src)
    run_generated(spark, sql)  # once more changes nothing
    assert rows(spark, name) == merged(data() + [(None, "nk", "202400"), (5, "np", None)], src)
    with pytest.raises(ValueError, match="not among"):
        merge_overwrite_sql("t", "s", ["a"], ["b"], "a")


def test_publish_upsert_of_many_keys_broadcasts_none(spark, name, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    create_table(spark, name, spark.createDataFrame([], SCHEMA).schema, "part", path)
    sw.publish_overwrite(spark.createDataFrame(data(), SCHEMA), name, path, "part")
    seen, write = [], sw.write_version
    monkeypatch.setattr(sw, "write_version", lambda df, *a: seen.append(df) or write(df, *a))
    sw.publish_upsert(spark.createDataFrame(change(), SCHEMA), name, path, ["id"], "part", source_rows=1_000_000)
    assert "strategy=broadcast" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert rows(spark, name) == merged(data(), change())
