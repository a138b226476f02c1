import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small fixtures: a handful of shuffle partitions is plenty."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def make_docs(spark):
    """documents-like rows with an extra column of a clashing name."""
    def make(rows, extra="k"):
        full = [(i, t, "en", s, None if t is None else len(t), 7) for i, t, s in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, `{extra}` int")
    return make
