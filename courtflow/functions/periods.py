"""How long a period lasts, and how much time lies between two clock readings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PeriodRule:
    """Regulation periods of one length, then overtime periods of another."""

    regulation_periods: int = 2
    regulation_minutes: int = 20
    overtime_minutes: int = 5

    def minutes(self, period: Column) -> Column:
        """Length of a period; an unknown period counts as overtime."""
        return F.when(
            period <= self.regulation_periods, F.lit(self.regulation_minutes)
        ).otherwise(F.lit(self.overtime_minutes))

    def minutes_of_each(self, periods: Column) -> Column:
        """Length of every period of an array."""
        return F.transform(periods, self.minutes)

    def minutes_between(self, last: Column, current: Column) -> Column:
        """Summed length of the periods last + 1 ... current, in closed form."""
        return self._minutes_through(current) - self._minutes_through(last)

    def _minutes_through(self, period: Column) -> Column:
        regulation = self.regulation_periods * self.regulation_minutes
        overtimes = period - self.regulation_periods
        return F.when(
            period <= self.regulation_periods, period * self.regulation_minutes
        ).otherwise(regulation + overtimes * self.overtime_minutes)


class CustomPeriodRule(PeriodRule):
    """Any Column function from period to minutes."""

    def __init__(self, minutes: Callable[[Column], Column]):
        super().__init__()
        object.__setattr__(self, "_minutes", minutes)

    def minutes(self, period: Column) -> Column:
        return self._minutes(period)

    def minutes_between(self, last: Column, current: Column) -> Column:
        # sequence() counts down when its ends are reversed, hence the guard
        passed = F.when(
            last < current, F.sequence(last + 1, current)
        ).otherwise(F.array().cast("array<bigint>"))
        total = F.aggregate(
            self.minutes_of_each(passed), F.lit(0).cast("bigint"), lambda a, m: a + m
        )
        return F.when(last.isNotNull() & current.isNotNull(), total)


MENS_RULE = PeriodRule(regulation_periods=2, regulation_minutes=20, overtime_minutes=5)


def period_to_min(period: Column, rule: PeriodRule = MENS_RULE) -> Column:
    return rule.minutes(period)


def period_list_to_min(periods: Column, rule: PeriodRule = MENS_RULE) -> Column:
    return rule.minutes_of_each(periods)


def minutes_since(
    last: tuple[Column, Column, Column],
    now: tuple[Column, Column, Column],
    rule: PeriodRule = MENS_RULE,
) -> Column:
    """Minutes from one (period, minutes, seconds) reading to a later one.

    The clock counts down, so its parts are subtracted the other way round.
    """
    last_period, last_minutes, last_seconds = last
    period, minutes, seconds = now
    return (
        rule.minutes_between(last_period, period)
        + (last_minutes - minutes)
        + (last_seconds - seconds) / F.lit(60.0)
    )
