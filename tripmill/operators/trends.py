"""Window operators over aggregated tables.

All of these partition by a handful of segment values. They belong after a
group-by: their input has one row per segment and period, whose number grows
with the calendar and not with the trips.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.metrics import running_exact
from tripmill.functions.scalars import pct_change


def day_number(day: str) -> Column:
    return F.unix_date(F.col(day))


def month_number(day: str) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day)


def prior_period(
    df: DataFrame,
    segment: Sequence[str],
    position: Column | str,
    values: Mapping[str, str],
    steps: int,
    mode: str = "rows",
) -> DataFrame:
    """Adds each value as it stood ``steps`` earlier (value column to new name).

    ``rows`` counts back rows, so a missing period shifts the comparison;
    ``calendar`` looks at exactly ``position - steps`` and gives NULL if that
    period is missing. ``position`` must be an integer expression in the
    calendar mode. Each prior value is projected once and reused by callers.
    """
    position = F.col(position) if isinstance(position, str) else position
    window = Window.partitionBy(*segment).orderBy(position)
    if mode == "rows":
        earlier = {new: F.lag(F.col(old), steps).over(window) for old, new in values.items()}
    elif mode == "calendar":
        exact = window.rangeBetween(-steps, -steps)
        earlier = {new: F.first(F.col(old)).over(exact) for old, new in values.items()}
    else:
        raise ValueError(f"mode is 'rows' or 'calendar', not {mode!r}")
    return df.withColumns(earlier)


def period_over_period(
    df: DataFrame,
    segment: Sequence[str],
    position: Column | str,
    changes: Mapping[str, str],
    steps: int,
    mode: str = "rows",
    keep_prior: Mapping[str, str] | None = None,
    digits: int = 1,
) -> DataFrame:
    """Percent change per value column (value column to name of the change)."""
    keep_prior = keep_prior or {}
    prior = {value: keep_prior.get(value, f"_prior_{value}") for value in changes}
    out = prior_period(df, segment, position, prior, steps, mode)
    out = out.withColumns({name: pct_change(value, prior[value], digits) for value, name in changes.items()})
    return out.drop(*[name for value, name in prior.items() if value not in keep_prior])


def running_total(
    df: DataFrame,
    segment: Sequence[str],
    order: str,
    counts: Mapping[str, str] | None = None,
    amounts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Totals from the start of the segment up to each row."""
    window = Window.partitionBy(*segment).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {new: F.sum(old).over(window) for old, new in (counts or {}).items()}
    added |= {new: running_exact(old, window) for old, new in (amounts or {}).items()}
    return df.withColumns(added)


def rank_within(df: DataFrame, segment: Sequence[str], ranks: Mapping[str, str]) -> DataFrame:
    """Rank by each value, largest first; equal values share a rank and leave a gap."""
    return df.withColumns(
        {
            name: F.rank().over(Window.partitionBy(*segment).orderBy(F.col(value).desc_nulls_last()))
            for value, name in ranks.items()
        }
    )


def share_of(df: DataFrame, segment: Sequence[str], value: str, name: str, digits: int = 1) -> DataFrame:
    """Percent of the segment's total that each row holds."""
    whole = F.sum(value).over(Window.partitionBy(*segment))
    return df.withColumn(name, F.round(F.lit(100.0) * F.col(value) / F.nullif(whole, F.lit(0)), digits))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows; give an order without ties, so that the cut is defined."""
    return df.orderBy(*order).limit(k)
