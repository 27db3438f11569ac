"""Aggregate expressions and the named metric registry.

Sums are exact: a double counts as its shortest decimal text, to twelve digits after
the point. Addition then does not depend on the order in which tasks finish or are
retried. Values of up to four digits after the point, which is nearly all money, are
added as two longs, which stay on the fast path of hash aggregation; others as wide
decimals. A sum past 10^25 raises under ANSI mode; it never wraps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from tripmill.functions.scalars import as_column

UNIT = 10_000  # the fast path counts ten-thousandths
CARRY_BITS = 20  # and splits the count, so that neither half can overflow a long
FAST_BELOW = 9e10
WIDE = "decimal(37, 12)"


def exact_sum(value: Column | str, window: WindowSpec | None = None) -> Column:
    """The sum as a decimal with twelve digits after the point; NULL without known values.

    NaN and the infinities are no known values: they are neither summed nor counted.
    """
    value = as_column(value)
    plain = value.cast("double")
    units = F.rint(plain * F.lit(float(UNIT)))
    fast = (F.abs(plain) < F.lit(FAST_BELOW)) & (units / F.lit(float(UNIT)) == plain)
    count = F.when(fast, units.cast("bigint"))

    def summed(part: Column) -> Column:
        return F.sum(part) if window is None else F.sum(part).over(window)

    high = summed(F.shiftright(count, CARRY_BITS))
    low = summed(count.bitwiseAND(F.lit((1 << CARRY_BITS) - 1)))
    rest = summed(F.when((F.abs(plain) < F.lit(float("inf"))) & ~fast, value.cast(WIDE)))
    whole = high.cast("decimal(20, 0)") * F.lit(1 << CARRY_BITS).cast("decimal(7, 0)") + low.cast("decimal(20, 0)")
    narrow = (whole * F.lit("0.0001").cast("decimal(5, 4)")).cast(WIDE)
    zero = F.lit(0).cast(WIDE)
    both = F.coalesce(narrow, zero) + F.coalesce(rest.cast(WIDE), zero)
    return F.when(high.isNotNull() | rest.isNotNull(), both)


def _units(total: Column) -> Column:
    """A sum in ten-thousandths as a double: for money a whole number, so that one division after it is exact."""
    return (total * F.lit(UNIT)).cast("double")


def rows() -> Column:
    return F.count(F.lit(1))


def total(value: Column | str, digits: int = 2) -> Column:
    return F.round(exact_sum(value), digits).cast("double")


def known_count(value: Column | str) -> Column:
    """How many values a sum holds: all but NULL, NaN and the infinities, which count as unknown."""
    return F.count_if(F.abs(as_column(value).cast("double")) < F.lit(float("inf")))


def mean_from(total: Column, known: Column, digits: int) -> Column:
    return F.round(_units(total) / (F.nullif(known, F.lit(0)) * F.lit(float(UNIT))), digits)


def mean(value: Column | str, digits: int) -> Column:
    """Mean over known values; NULL for a group without any."""
    return mean_from(exact_sum(value), known_count(value), digits)


def whole_total(value: Column | str) -> Column:
    return F.sum(as_column(value))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def distinct_count(value: Column | str) -> Column:
    return F.count_distinct(as_column(value))


def ratio_from(top: Column, bottom: Column, digits: int = 2) -> Column:
    return F.round(_units(top) / F.nullif(_units(bottom), F.lit(0.0)), digits)


def ratio_of_totals(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    """Quotient of two sums; NULL when the lower sum is zero."""
    return ratio_from(exact_sum(top), exact_sum(bottom), digits)


def running_exact(value: Column | str, window: WindowSpec, digits: int = 2) -> Column:
    return F.round(exact_sum(value, window), digits).cast("double")


def band_counts(value: Column | str, edges: Sequence[float], names: Sequence[str]) -> list[Column]:
    """Counts per band: the first edge itself, then (edge, next edge], then above the last.

    Values below the first edge and NULLs fall into no band.
    """
    if len(names) != len(edges) + 1:
        raise ValueError("give one name per edge and one for the open band above")
    value = as_column(value)
    tests = [value == F.lit(edges[0])]
    tests += [(value > F.lit(low)) & (value <= F.lit(high)) for low, high in zip(edges, edges[1:])]
    tests.append(value > F.lit(edges[-1]))
    return [count_where(test).alias(name) for test, name in zip(tests, names)]


# --- named trip metrics -------------------------------------------------------
# Each entry builds its expression for a column prefix such as "t.".
# ``mean_cost`` is the mean of total_cost, which tables publish as "average fare".

REGISTRY: Mapping[str, Callable[[str], Column]] = {
    "trips": lambda p: rows(),
    "passengers": lambda p: whole_total(f"{p}passenger_count"),
    "revenue": lambda p: total(f"{p}total_cost"),
    "mean_cost": lambda p: mean(f"{p}total_cost", 2),
    "tips": lambda p: total(f"{p}tip_amount"),
    "mean_tip_pct": lambda p: mean(f"{p}tip_pct", 1),
    "mean_distance": lambda p: mean(f"{p}trip_distance", 2),
    "mean_duration": lambda p: mean(f"{p}trip_duration_min", 1),
    "mean_speed": lambda p: mean(f"{p}avg_speed_mph", 1),
    "revenue_per_mile": lambda p: ratio_of_totals(f"{p}total_cost", f"{p}trip_distance"),
    "card_trips": lambda p: count_where(F.col(f"{p}payment_type_label") == "credit_card"),
    "cash_trips": lambda p: count_where(F.col(f"{p}payment_type_label") == "cash"),
    "airport_trips": lambda p: count_where(F.col(f"{p}is_airport_trip")),
    "cross_borough_trips": lambda p: count_where(F.col(f"{p}is_cross_borough")),
    "pickup_zones": lambda p: distinct_count(f"{p}pickup_location_id"),
}


def measures(names: Mapping[str, str] | Iterable[str], prefix: str = "") -> list[Column]:
    """Registry expressions, published under the names a table wants."""
    named = names if isinstance(names, Mapping) else {n: n for n in names}
    return [REGISTRY[metric](prefix).alias(alias) for metric, alias in named.items()]


# The column names that the tables and the two bundles publish.
REVENUE_BUNDLE = {
    "revenue": "total_revenue",
    "mean_cost": "avg_fare_per_trip",
    "tips": "total_tips",
    "mean_tip_pct": "avg_tip_pct",
    "revenue_per_mile": "revenue_per_mile",
}
VOLUME_BUNDLE = {
    "trips": "total_trips",
    "passengers": "total_passengers",
    "mean_distance": "avg_distance_mi",
    "mean_duration": "avg_duration_min",
    "mean_speed": "avg_speed_mph",
}


def revenue_metrics(prefix: str = "") -> list[Column]:
    return measures(REVENUE_BUNDLE, prefix)


def trip_volume_metrics(prefix: str = "") -> list[Column]:
    return measures(VOLUME_BUNDLE, prefix)
