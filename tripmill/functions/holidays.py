"""Holidays by rule, for any year, as column expressions over a day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.functions.scalars import as_column

SUNDAY, MONDAY, THURSDAY, FRIDAY, SATURDAY = 1, 2, 5, 6, 7  # as dayofweek counts


class FixedDay(NamedTuple):
    """A day of a month. On a Saturday it is observed the day before, on a Sunday the day after."""

    month: int
    day: int


class NthWeekday(NamedTuple):
    """The nth given weekday of a month; the last one for n = -1."""

    month: int
    weekday: int
    n: int


# The federal holidays of the United States.
US_FEDERAL: Sequence[FixedDay | NthWeekday] = [
    FixedDay(1, 1),
    NthWeekday(1, MONDAY, 3),
    NthWeekday(2, MONDAY, 3),
    NthWeekday(5, MONDAY, -1),
    FixedDay(6, 19),
    FixedDay(7, 4),
    NthWeekday(9, MONDAY, 1),
    NthWeekday(10, MONDAY, 2),
    FixedDay(11, 11),
    NthWeekday(11, THURSDAY, 4),
    FixedDay(12, 25),
]


def _on(day: Column, rule: FixedDay) -> Column:
    return (F.month(day) == rule.month) & (F.dayofmonth(day) == rule.day)


def _is(day: Column, rule: FixedDay | NthWeekday, observed: bool) -> Column:
    weekday = F.dayofweek(day)
    if isinstance(rule, FixedDay):
        if not observed:
            return _on(day, rule)
        before = (weekday == FRIDAY) & _on(F.date_add(day, 1), rule)
        after = (weekday == MONDAY) & _on(F.date_sub(day, 1), rule)
        return (_on(day, rule) & ~weekday.isin(SATURDAY, SUNDAY)) | before | after
    place = F.month(day) == rule.month
    if rule.n < 0:
        return place & (weekday == rule.weekday) & (F.month(F.date_add(day, 7)) != rule.month)
    return place & (weekday == rule.weekday) & (F.ceil(F.dayofmonth(day) / 7) == rule.n)


def is_holiday(day: Column | str, rules: Iterable[FixedDay | NthWeekday] = US_FEDERAL, observed: bool = True) -> Column:
    """Whether a day is a holiday; with ``observed`` holidays on a weekend move to the weekday beside it.

    The rules look at the days around, so a New Year's Day on a Saturday falls on the
    last day of the year before.
    """
    return reduce(or_, [_is(as_column(day), rule, observed) for rule in rules], F.lit(False))
