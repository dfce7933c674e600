"""Season numbers and calendars. ``as_of`` stands for today, so results repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.functions.values import safe_timestamp

# fixed values: first season with data, last month of a season, first day of one,
# and every how many days a schedule page is taken, starting from which position
MIN_SEASON = 2003
LAST_MONTH = 7
START_MONTH, START_DAY = 11, 1
PAGE_DAYS, PAGE_OFFSET = 3, 1

Date = Column | dt.date


def _date(value: Date) -> Column:
    return F.lit(value) if isinstance(value, dt.date) else value


def season_of(date: Date) -> Column:
    """A season bears the year it ends in; it starts after July."""
    date = _date(date)
    return F.year(date) + (F.month(date) > LAST_MONTH).cast("int")


def is_valid_season(season: Column, as_of: Date) -> Column:
    return season.between(F.lit(MIN_SEASON), season_of(as_of))


def season_start(season: Column) -> Column:
    """The first of November of the year before."""
    return F.make_date((season - 1).cast("int"), F.lit(START_MONTH), F.lit(START_DAY))


def season_range(start: Column, end: Column | None, as_of: Date) -> Column:
    """Array of seasons between two ends.

    An end out of range gives way to its bound; reversed ends are swapped.
    """
    newest = season_of(as_of)
    start = F.when(is_valid_season(start, as_of), start).otherwise(F.lit(MIN_SEASON))
    end = newest if end is None else F.when(is_valid_season(end, as_of), end).otherwise(newest)
    return F.sequence(
        F.least(start, end).cast("int"), F.greatest(start, end).cast("int")
    )


def representative_dates(start: Date, end: Date) -> Column:
    """Array of the days whose schedule pages cover all days from start to end.

    A page holds the day before and the day after too, so every third day is taken,
    from the second on, and always the last.
    """
    start, end = _date(start), _date(end)
    start = F.greatest(start, season_start(F.year(start)))
    days = F.when(start <= end, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )
    last = F.datediff(end, start)
    return F.filter(
        days, lambda _, i: (i % PAGE_DAYS == PAGE_OFFSET) | (i == last)
    )


def season_page_dates(first_pages: DataFrame) -> DataFrame:
    """Representative dates of each season, from its first schedule page.

    Reads ``page.content.season`` of parsed schedule payloads; one row per date.
    """
    season = F.col("parsed.page.content.season")
    ends = [
        F.to_date(safe_timestamp(season[field])) for field in ("startDate", "endDate")
    ]
    return first_pages.select(
        "document_key", F.explode(representative_dates(*ends)).alias("rep_date")
    )
