"""Casts that give null instead of an error, and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: formats of keys and of dates in payloads
KEY_DATE_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss][XXX][XX][X]"


def safe_int(value: Column) -> Column:
    """Text or number as bigint; null when it is not a whole number."""
    return value.try_cast("bigint")


def safe_timestamp(text: Column) -> Column:
    """ISO text with minutes, optional seconds and an offset, as a timestamp."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(MINUTE_FORMAT)), text.try_cast("timestamp"))


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def part(text: Column, separator: str, position: int) -> Column:
    """A piece of split text, null when there are fewer pieces."""
    return F.get(F.split(text, separator), F.lit(position))


def with_default_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add a column only where it is missing."""
    return df if name in df.columns else df.withColumn(name, default)


def existing(df: DataFrame, *names: str) -> list[str]:
    """Those of the names that are columns, compared exactly."""
    return [n for n in names if n in df.columns]


def excluding(df: DataFrame, *, prefix: str = "", suffix: str = "") -> DataFrame:
    """Drop the columns that start with the prefix or end with the suffix."""
    out = [
        c
        for c in df.columns
        if (prefix and c.startswith(prefix)) or (suffix and c.endswith(suffix))
    ]
    return df.drop(*out)
