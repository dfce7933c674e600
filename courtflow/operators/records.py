"""Record completion: keys as text, and whether a document can still change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.functions.seasons import season_of
from courtflow.functions.values import KEY_DATE_FORMAT, safe_int, safe_timestamp
from courtflow.schemas import RecordType


def document_key(raw_key: Column, record_type: RecordType) -> Column:
    """Raw key as text."""
    if record_type.has_date_key:
        return F.date_format(raw_key, KEY_DATE_FORMAT)
    return raw_key.cast("string")


def raw_key(key: Column, record_type: RecordType) -> Column:
    """Text key as a date or a whole number, null when it is neither."""
    if record_type.has_date_key:
        return F.try_to_date(key, KEY_DATE_FORMAT)
    return safe_int(key)


def of_type(records: DataFrame, record_type: RecordType) -> DataFrame:
    return records.filter(F.col("record_type") == record_type.value)


def unknown_records(records: DataFrame) -> DataFrame:
    """Records whose label is none of the four types."""
    known = F.col("record_type").isin(RecordType.labels())
    return records.filter(~F.coalesce(known, F.lit(False)))


def _game_date(payload: Column) -> Column:
    """Date of the first competition, as written in its own offset."""
    parsed = F.from_json(
        payload, "header STRUCT<competitions: ARRAY<STRUCT<date: STRING>>>"
    )
    text = F.get(parsed["header"]["competitions"], F.lit(0))["date"]
    return F.when(safe_timestamp(text).isNotNull(), F.try_to_date(F.left(text, F.lit(10))))


def up_to_date(as_of: Column | dt.date) -> Column:
    """Whether the document is final: its season, day or game has passed.

    A game without a date counts as final, and so does every player.
    """
    as_of = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    kind, key = F.col("record_type"), F.col("document_key")
    season = raw_key(key, RecordType.STANDINGS)
    day = raw_key(key, RecordType.SCHEDULE)
    return (
        F.when(kind == RecordType.STANDINGS.value, season < season_of(as_of))
        .when(kind == RecordType.SCHEDULE.value, day < as_of)
        .when(
            kind == RecordType.GAME.value,
            F.coalesce(_game_date(F.col("payload")) < as_of, F.lit(True)),
        )
        .when(kind == RecordType.PLAYER.value, F.lit(True))
    )


def complete_records(records: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Records of known types with ``up_to_date``."""
    known = records.filter(F.col("record_type").isin(RecordType.labels()))
    return known.withColumn("up_to_date", up_to_date(as_of))
