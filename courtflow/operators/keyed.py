"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Where rows carry it, when the document they come from was stored.
DOCUMENT_TIME = "document_timestamp"


def carried(df: DataFrame) -> list[str]:
    """The document's time, if the rows have it, to be kept by a select."""
    return [DOCUMENT_TIME] if DOCUMENT_TIME in df.columns else []


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, each with the time of its newest document if they carry one."""
    if DOCUMENT_TIME not in df.columns:
        return df.distinct()
    others = [c for c in df.columns if c != DOCUMENT_TIME]
    return df.groupBy(*others).agg(F.max(DOCUMENT_TIME).alias(DOCUMENT_TIME))


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key.

    Without an order, the row of the newest document is kept if rows carry its time,
    then that with the smallest non-null values of the other columns, so reruns agree.
    ``row_number() = 1`` lets Spark drop all but
    one row per key and map task before the shuffle, so a key that holds a third
    of the rows stays cheap.
    """
    if order is None:
        newest = [F.col(c).desc_nulls_last() for c in carried(df)]
        order = newest + [
            F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, DOCUMENT_TIME)
        ]
    if not order:
        return df.select(*keys).distinct()
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def absent_from(
    df: DataFrame, other: DataFrame, keys: Sequence[str], few: bool = False
) -> DataFrame:
    """Rows whose key the other frame lacks.

    Keys of the other frame are made distinct before the shuffle, so none of them can
    be hot. ``few`` says that ``df`` is a batch and the other frame far larger: it is
    then cut to the keys of the batch first, which Spark does without shuffling it as
    long as the batch's keys are small enough to broadcast.
    """
    known = other.select(*keys)
    if few:
        known = known.join(df.select(*keys), list(keys), "left_semi")
    return df.join(known.distinct(), list(keys), "left_anti")
