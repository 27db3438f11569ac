"""Mergeable partial states of the trip metrics.

A state row holds, for one cell of the finest grain that the Gold tables share, what
adds up: counts, exact sums and the number of known values behind each sum. States of
different trips merge by addition, so any coarser table, and any question about it, comes
from the states alone and equals what a scan of the trips would give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import metrics as M

#: The grain that every Gold aggregate and consumer question can be read from.
STATE_GRAIN = [
    "pickup_year_month",
    "pickup_date",
    "pickup_month",
    "pickup_hour",
    "is_weekend",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
    "payment_type_label",
    "is_airport_trip",
]
MEASURED = ["total_cost", "tip_amount", "tip_pct", "trip_distance", "trip_duration_min", "avg_speed_mph"]


def partial_states(trips: DataFrame, band_of: str, edges: Sequence[float], bands: Sequence[str]) -> DataFrame:
    """One row a cell of the grain: the states of its trips."""
    parts = [M.rows().alias("trips"), M.whole_total("passenger_count").alias("passengers")]
    parts.append(M.count_where(F.col("is_cross_borough")).alias("cross_borough_trips"))
    for name in MEASURED:
        parts += [M.exact_sum(name).alias(f"sum_{name}"), M.known_count(name).alias(f"known_{name}")]
    return trips.groupBy(*STATE_GRAIN).agg(*parts, *M.band_counts(band_of, edges, bands))


def merged(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States of a coarser grain."""
    values = [c for c in states.columns if c not in STATE_GRAIN]
    return states.groupBy(*by).agg(*[F.sum(c).alias(c) for c in values])


def total_of(name: str, digits: int = 2) -> Column:
    return F.round(F.sum(f"sum_{name}"), digits).cast("double")


def mean_of(name: str, digits: int) -> Column:
    return M.mean_from(F.sum(f"sum_{name}"), F.sum(f"known_{name}"), digits)


def _trips_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("trips")).otherwise(0))


STATE_REGISTRY: Mapping[str, Callable[[], Column]] = {
    "trips": lambda: F.sum("trips"),
    "passengers": lambda: F.sum("passengers"),
    "revenue": lambda: total_of("total_cost"),
    "mean_cost": lambda: mean_of("total_cost", 2),
    "tips": lambda: total_of("tip_amount"),
    "mean_tip_pct": lambda: mean_of("tip_pct", 1),
    "mean_distance": lambda: mean_of("trip_distance", 2),
    "mean_duration": lambda: mean_of("trip_duration_min", 1),
    "mean_speed": lambda: mean_of("avg_speed_mph", 1),
    "revenue_per_mile": lambda: M.ratio_from(F.sum("sum_total_cost"), F.sum("sum_trip_distance")),
    "card_trips": lambda: _trips_where(F.col("payment_type_label") == "credit_card"),
    "cash_trips": lambda: _trips_where(F.col("payment_type_label") == "cash"),
    "airport_trips": lambda: _trips_where(F.col("is_airport_trip")),
    "cross_borough_trips": lambda: F.sum("cross_borough_trips"),
    "pickup_zones": lambda: M.distinct_count("pickup_location_id"),
}


def state_measures(names: Mapping[str, str] | Iterable[str]) -> list[Column]:
    """The registry's metrics, computed from states."""
    named = names if isinstance(names, Mapping) else {n: n for n in names}
    return [STATE_REGISTRY[metric]().alias(alias) for metric, alias in named.items()]


def state_bands(names: Sequence[str]) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]
