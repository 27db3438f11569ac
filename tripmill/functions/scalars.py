"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key (public key-macro convention).
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(code: Column | str, names: Mapping, default: str) -> Column:
    """Code to name; NULL and unlisted codes get ``default``."""
    code = as_column(code)
    chain = None
    for value, name in names.items():
        step = F.when if chain is None else chain.when
        chain = step(code == F.lit(value), F.lit(name))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def matches_any(columns: Iterable[Column | str], patterns: Iterable[str]) -> Column:
    """True if any column matches any LIKE pattern; never NULL."""
    patterns = list(patterns)
    tests = [as_column(c).like(p) for c in columns for p in patterns]
    return F.coalesce(reduce(or_, tests), F.lit(False))


def differs(a: Column | str, b: Column | str) -> Column:
    """True if both sides are known and unequal; never NULL."""
    return F.coalesce(as_column(a) != as_column(b), F.lit(False))


def surrogate_key(columns: Iterable[str], casts: Mapping[str, str] | None = None) -> Column:
    """MD5 of the columns as text, joined by ``-``, with a token in place of NULL.

    ``casts`` gives a column another type before it becomes text, for example a
    decimal for doubles whose text form would differ between engines.
    """
    casts = casts or {}
    parts = []
    for name in columns:
        value = F.col(name).cast(casts[name]) if name in casts else F.col(name)
        parts.append(F.coalesce(value.cast("string"), F.lit(NULL_KEY_TOKEN)))
    return F.md5(F.concat_ws("-", *parts))


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an int, by arithmetic rather than by formatting text."""
    day = as_column(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(ts: Column | str) -> Column:
    """``yyyy-MM`` text."""
    return F.date_format(as_column(ts), "yyyy-MM")


def is_weekend(ts: Column | str) -> Column:
    """Saturday or Sunday; ``dayofweek`` counts from 1 = Sunday."""
    return F.dayofweek(as_column(ts)).isin(1, 7)


def whole_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds between two timestamps, each cut to the second first."""
    return F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))


def minutes_of(seconds: Column) -> Column:
    """Whole seconds as minutes with two digits.

    Hundredths of a minute are thirds of five seconds, so they never fall on a
    half and plain rounding to an integer gives the decimal result.
    """
    return F.rint(seconds * 5 / 3) / 100


def guarded_ratio(numerator: Column, denominator: Column, digits: int, factor: float | None = None) -> Column:
    """Rounded quotient, NULL unless the denominator is positive."""
    quotient = numerator / denominator
    if factor is not None:
        quotient = quotient * F.lit(factor)
    return F.when(denominator > 0, F.round(quotient, digits))


def guarded_speed(distance: Column, minutes: Column, digits: int = 2) -> Column:
    """Distance per hour, NULL unless the duration is positive."""
    return F.when(minutes > 0, F.round(distance / (minutes / 60), digits))


def sum_of(columns: Iterable[str], digits: int) -> Column:
    """Rounded sum of components; NULL if any component is NULL."""
    total = None
    for name in columns:
        total = F.col(name) if total is None else total + F.col(name)
    return F.round(total, digits)


def pct_change(current: Column | str, prior: Column | str, digits: int = 1) -> Column:
    """Percent change; NULL without a prior value or with a zero one."""
    current, prior = as_column(current), as_column(prior)
    return F.round(F.lit(100.0) * (current - prior) / F.nullif(prior, F.lit(0)), digits)
