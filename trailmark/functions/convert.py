"""Conversions that turn what they cannot read into null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(c: Column) -> Column:
    """Double; unreadable text, NaN and null give null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def as_key(c: Column, kind: str = "") -> Column:
    """Long by way of double, so that '7.0' is 7; fractions and unreadable text give null.  ``kind`` is the column's type, if known: whole numbers are keys as they are."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")
    exact, x = c.try_cast("bigint"), c.try_cast("double")
    return F.coalesce(F.when(c.try_cast("string").rlike(r"^\s*[+-]?\d+\s*$"), exact), F.when(x == F.floor(x), x.try_cast("bigint")))


def as_time(c: Column, kind: str) -> Column:
    """Timestamp without zone; unreadable text gives null.  ``kind`` is the column's type."""
    if kind in ("timestamp_ntz", "date"):
        return c.cast("timestamp_ntz")
    if kind == "timestamp":
        return c.cast("timestamp_ntz")
    return c.try_cast("string").try_cast("timestamp_ntz")
