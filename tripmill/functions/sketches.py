"""Mergeable distinct counts: states that add up over days, unlike exact counts.

An HLL sketch of a day takes a few kilobytes however many values it has seen, and the
union of two is the sketch of both. With ``lg_size`` 12 the relative standard error is
about 1.6 %; ``BOUND`` is three of them, which one estimate in several hundred misses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill.functions.scalars import as_column

LG_SIZE = 12
BOUND = 3 * 1.04 / (1 << LG_SIZE) ** 0.5


def distinct_state(value: Column | str, lg_size: int = LG_SIZE) -> Column:
    """The sketch of a group's known values; numbers and dates count by their text."""
    return F.hll_sketch_agg(as_column(value).cast("string"), lg_size)


def merged_state(state: Column | str) -> Column:
    """The sketch of all values behind a group of sketches."""
    return F.hll_union_agg(as_column(state))


def estimate(state: Column | str) -> Column:
    """How many different values a sketch has seen, about; 0 for no sketch."""
    return F.coalesce(F.hll_sketch_estimate(as_column(state)), F.lit(0))


def within_bound(estimated: Column, exact: Column, bound: float = BOUND) -> Column:
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), exact * F.lit(bound))
