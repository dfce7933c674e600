"""Sort orders of plays. Nulls come first in both directions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.operators.numbering import places, positions

READING = ("period", "clock_minutes", "clock_seconds")


def order_columns(by: Iterable[tuple[str | Column, bool]]) -> list[Column]:
    """(column, descending) pairs as sort columns, nulls first either way."""
    columns = [(F.col(c) if isinstance(c, str) else c, desc) for c, desc in by]
    return [
        c.desc_nulls_first() if desc else c.asc_nulls_first() for c, desc in columns
    ]


def sort_by(df: DataFrame, by: Iterable[tuple[str | Column, bool]]) -> DataFrame:
    return df.orderBy(*order_columns(by))


def reading_order(prefix: str = "") -> list[Column]:
    """Game time: periods go up, the clock goes down."""
    return order_columns((f"{prefix}{c}", c != "period") for c in READING)


def within_reading_order() -> list[Column]:
    """Order of plays that share one clock reading."""
    return order_columns(
        [("home_score", False), ("away_score", False), ("sequence_id", False)]
    )


def play_order() -> list[Column]:
    """Order of the plays of one game."""
    return reading_order() + within_reading_order()


def _global_order(with_datetime: bool) -> list[Column]:
    lead = [(c, False) for c in (["datetime"] if with_datetime else []) + ["game_id"]]
    return order_columns(lead) + play_order()


def sort_plays(plays: DataFrame, with_datetime: bool = False) -> DataFrame:
    """Globally sorted plays; windows use ``play_order`` and need no global sort."""
    return plays.orderBy(*_global_order(with_datetime))


def sorted_positions(plays: DataFrame, with_datetime: bool = False) -> DataFrame:
    """Plays with ``position``, their place in that order, from 1; no row is moved to the driver."""
    found = positions(plays, _global_order(with_datetime), "position")
    return found.withColumn("position", F.col("position") + 1)


def number_plays(plays: DataFrame) -> DataFrame:
    """Plays with ``place``, their position in the order of their game, from 1.

    A game of any size, or one clock reading of it, spreads over many tasks.
    """
    found = places(plays, ["game_id"], play_order(), "place")
    return found.withColumn("place", F.col("place") + 1)
