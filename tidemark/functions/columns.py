"""Scalar column expressions used by the operators.

All of them are compositions of ``pyspark.sql.functions``; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType


def col(name: str) -> Column:
    """Column by exact name; dots and spaces are not read as struct paths."""
    return F.col("`" + name.replace("`", "``") + "`")


def scrub(c: Column, token: str = "null", whole_value: bool = False) -> Column:
    """Null-token scrub.

    Parity form: every occurrence of ``token`` is removed, case-sensitive, no
    anchors (``"nullify"`` -> ``"ify"``).  ``whole_value=True`` only blanks a
    value that is exactly the token.  NULL stays NULL; every type becomes text.
    """
    s = c.cast("string")
    if whole_value:
        return F.when(s == F.lit(token), F.lit("")).otherwise(s)
    return F.replace(s, F.lit(token), F.lit(""))


def bool_encode(c: Column, null_as: int | None = 1) -> Column:
    """Boolean text to int: ``"false"`` and ``""`` -> 0, NULL -> ``null_as``,
    anything else -> 1 (the reference's rule, NULL included)."""
    s = c.cast("string")
    expr = F.when(s == "false", F.lit(0)).when(s == "", F.lit(0))
    if null_as != 1:
        expr = expr.when(s.isNull(), F.lit(null_as).cast("int"))
    return expr.otherwise(F.lit(1))


def year_month(c: Column, source_type: DataType | None = None) -> Column:
    """``yyyyMM`` text of the date *as written*.

    Text with an offset (``2017-03-31T23:30:00-0700``) keeps its written month:
    the value is cast to DATE, never through a UTC timestamp.  Empty or bad
    text gives NULL instead of an ANSI error.
    """
    d = c.try_cast("date") if isinstance(source_type, StringType) or source_type is None else c.cast("date")
    return F.date_format(d, "yyyyMM")


def to_timestamp_safe(c: Column, ntz: bool = False) -> Column:
    """Text to timestamp; ``''`` and bad text give NULL (ANSI-safe)."""
    return c.try_cast("timestamp_ntz" if ntz else "timestamp")


def utc_to_zone(c: Column, zone: str, source_type: DataType | None = None) -> Column:
    """Shift a UTC wall clock to ``zone`` (DST aware), e.g. MST7MDT.

    TIMESTAMP_NTZ input stays NTZ and does not depend on the session zone.
    """
    if isinstance(source_type, TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)
    return F.from_utc_timestamp(c, zone)


def watermark_text(c: Column) -> Column:
    """Watermark as ``yyyy-MM-ddTHH:mm:ssZ`` (cut to whole seconds)."""
    return F.date_format(F.date_trunc("second", c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
