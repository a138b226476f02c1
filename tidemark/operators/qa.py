"""QA between two copies of a table (e.g. two environments).

``qa_union``: both copies labelled and stacked, optionally for a list of ids.
``qa_diff``: per key, which copy lacks it and which columns differ.  It is a
union + grouped aggregate, not a full outer join, so a key repeated many
times costs one partial aggregate per task instead of all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col

BROADCAST_IDS = 1_000_000  # longer id lists are joined without the broadcast hint


def qa_union(a: DataFrame, b: DataFrame, labels: tuple[str, str] = ("A", "B"),
             label_col: str = "instance", key: str | None = None,
             ids: list | None = None) -> DataFrame:
    """``select 'A' as instance, * from a where key in ids union all …``.

    The ids become a frame typed as each side's key, whatever their number, and
    filter it by a semi join.  NULL ids, and ids that are no value of that
    type, match nothing.
    """
    id_list = None if ids is None else [str(i) for i in ids if i is not None]

    def side(df: DataFrame, label: str) -> DataFrame:
        out = df
        if key is not None and id_list is not None:
            wanted = (df.sparkSession.createDataFrame([(i,) for i in id_list], "__id string")
                      .select(F.col("__id").try_cast(df.schema[key].dataType).alias("__id")))
            wanted = F.broadcast(wanted) if len(id_list) <= BROADCAST_IDS else wanted
            out = out.join(wanted, col(key) == F.col("__id"), "left_semi")
        return out.select(F.lit(label).alias(label_col), *[col(c) for c in df.columns])
    return side(a, labels[0]).unionByName(side(b, labels[1]))


def qa_diff(a: DataFrame, b: DataFrame, keys: list[str], include_same: bool = False) -> DataFrame:
    """Rows ``(keys…, status, changed_columns)`` for every key that differs.

    status: ``only_a``, ``only_b``, ``duplicate_key`` (a key twice on a side),
    ``changed`` (``changed_columns`` lists the columns, null-safe compare) or,
    with ``include_same``, ``same``.
    """
    values = [c for c in a.columns if c not in keys]
    if sorted(values) != sorted(c for c in b.columns if c not in keys):
        raise ValueError("the two frames have different columns")

    def tag(df: DataFrame, side: int) -> DataFrame:
        return df.select(*[col(k) for k in keys],
                         F.struct(*[col(c) for c in values]).alias("__row"),
                         F.lit(side).alias("__side"))

    both = tag(a, 0).unionByName(tag(b, 1))
    is_a = F.col("__side") == 0
    g = both.groupBy(*[col(k) for k in keys]).agg(
        F.sum(F.when(is_a, 1).otherwise(0)).alias("__na"),
        F.sum(F.when(is_a, 0).otherwise(1)).alias("__nb"),
        F.first(F.when(is_a, F.col("__row")), ignorenulls=True).alias("__ra"),
        F.first(F.when(~is_a, F.col("__row")), ignorenulls=True).alias("__rb"))
    changed = F.concat_ws(",", *[
        F.when(~F.col("__ra").getField(c).eqNullSafe(F.col("__rb").getField(c)), F.lit(c))
        for c in values])
    status = (F.when(F.col("__na") == 0, "only_b")
               .when(F.col("__nb") == 0, "only_a")
               .when((F.col("__na") > 1) | (F.col("__nb") > 1), "duplicate_key")
               .when(changed != "", "changed")
               .otherwise("same"))
    out = g.select(*[col(k) for k in keys], status.alias("status"),
                   F.when(status == "changed", changed).alias("changed_columns"))
    return out if include_same else out.where(F.col("status") != "same")
