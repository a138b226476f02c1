import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources.connector import Page, PagesReader, connector_scan, write_pages

SCHEMA = "id long, modified timestamp_ntz, name string, is_deleted string"
T0 = dt.datetime(2024, 1, 1)


def data(n=120):
    return [(k, T0 + dt.timedelta(minutes=k) if k % 11 else None, None if k % 7 == 0 else f"n{k % 5}", "true" if k % 4 == 0 else "false")
            for k in range(n)]


@pytest.fixture()
def root(spark, tmp_root):
    write_pages(spark.createDataFrame(data(), SCHEMA).repartition(3), tmp_root, "Account", "39.0", "id", 10)
    return tmp_root


def scan(spark, root, **kw):
    return connector_scan(spark, root, "Account", "39.0", **kw)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_page_is_a_partition_and_all_rows_come(spark, root):
    df = scan(spark, root, query_all=True)
    assert df.rdd.getNumPartitions() >= 12
    assert got(df) == sorted(data(), key=str)


def test_query_all_and_columns(spark, root):
    assert got(scan(spark, root, columns=["name", "id"])) == sorted(((r[2], r[0]) for r in data() if r[3] == "false"), key=str)
    with pytest.raises(Exception, match="no columns"):
        scan(spark, root, columns=["nothing"]).collect()


@pytest.mark.parametrize("cond", [
    "modified > timestamp_ntz'2024-01-01 01:30:00'", "modified >= timestamp_ntz'2024-01-01 01:30:00' AND id < 100", "id <= 7", "id = 55",
    "id IN (3, 4, 500)", "name IS NULL", "name = 'n3' AND id > 50", "name LIKE 'n%' AND id % 2 = 0", "NOT (id > 60)", "id > 10000"])
def test_filters_give_the_rows_of_a_plain_filter(spark, root, cond):
    plain = spark.createDataFrame(data(), SCHEMA).where(cond)
    assert got(scan(spark, root, query_all=True).where(cond)) == got(plain)


def test_the_watermark_reaches_the_reader(spark, root):
    df = scan(spark, root, query_all=True).where(F.col("modified") > F.lit(T0 + dt.timedelta(minutes=100)))
    plan = df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    assert "BatchScan" in plan and "Filter" not in plan  # the reader has taken it; Spark has none left to apply
    assert df.count() == sum(1 for r in data() if r[1] and r[1] > T0 + dt.timedelta(minutes=100))


def test_pages_outside_of_a_filter_are_not_read(spark, root):
    from pyspark.sql.datasource import GreaterThan

    reader = PagesReader(f"{root}/Account/v39.0", spark.createDataFrame([], SCHEMA).schema, True)
    assert list(reader.pushFilters([GreaterThan(("id",), 99), GreaterThan(("a", "b"), 1)])) == [GreaterThan(("a", "b"), 1)]
    pages = reader.partitions()
    assert len(pages) >= 12 and all(isinstance(p, Page) for p in pages)
    rows = [sum(b.num_rows for b in reader.read(p)) for p in pages]
    assert sum(rows) == 20 and sum(1 for r in rows if r) <= 3


def test_missing_options_and_empty_object(spark, root, tmp_root):
    with pytest.raises(Exception, match="missing"):
        spark.read.format("tidemark_pages").option("path", root).load().collect()
    write_pages(spark.createDataFrame([], SCHEMA), tmp_root, "Empty", "1", "id", 5)
    assert connector_scan(spark, tmp_root, "Empty", "1", query_all=True, schema=spark.createDataFrame([], SCHEMA).schema).count() == 0
