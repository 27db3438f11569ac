"""The declared checks of the Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.checks import (
    Check,
    accepted_values,
    assertion,
    failing_rows,
    not_null,
    relationship,
    unique,
)
from tripmill.plans.silver import PAYMENT_NAMES, UNKNOWN_PAYMENT

# The boroughs a zone may name, and the assertion reasons.
BOROUGHS = ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown"]
NEGATIVE_FARE = "negative fare in fact_trips"
WRONG_ORDER = "causality violation: pickup >= dropoff"

PAYMENTS = [*PAYMENT_NAMES.values(), UNKNOWN_PAYMENT]


def negative_fare():
    return F.col("fare_amount") < 0


def wrong_order():
    return (F.col("pickup_datetime") >= F.col("dropoff_datetime")) | (F.col("trip_duration_min") <= 0)


def negative_fares(fact: DataFrame) -> DataFrame:
    return failing_rows(
        fact, negative_fare(), ["trip_id", "fare_amount", "pickup_datetime", "pickup_borough"], NEGATIVE_FARE
    )


def pickups_not_before_dropoffs(fact: DataFrame) -> DataFrame:
    columns = ["trip_id", "pickup_datetime", "dropoff_datetime", "trip_duration_min", "pickup_borough"]
    return failing_rows(fact, wrong_order(), columns, WRONG_ORDER)


def silver_checks() -> list[Check]:
    return not_null(
        "silver_trips", "pickup_datetime", "dropoff_datetime", "fare_amount", "PULocationID", "DOLocationID"
    )


def gold_checks(dropoff_too: bool = True) -> list[Check]:
    """``dropoff_too`` adds the foreign key of the other end of the trip."""
    checks = [
        *unique("dim_date", "date_key", "calendar_date"),
        *not_null("dim_date", "date_key", "calendar_date", "is_weekend"),
        *accepted_values("dim_date", "is_weekend", [True, False]),
        *unique("dim_zone", "location_id"),
        *not_null("dim_zone", "location_id", "borough"),
        *accepted_values("dim_zone", "borough", BOROUGHS),
        *unique("fact_trips", "trip_id"),
        *not_null(
            "fact_trips",
            "trip_id",
            "date_key",
            "pickup_location_id",
            "fare_amount",
            "total_cost",
            "trip_duration_min",
        ),
        *relationship("fact_trips", "date_key", "dim_date", "date_key"),
        *relationship("fact_trips", "pickup_location_id", "dim_zone", "location_id"),
        *accepted_values("fact_trips", "payment_type_label", PAYMENTS),
        *assertion("fact_trips", "no_negative_fares", negative_fare()),
        *assertion("fact_trips", "pickup_before_dropoff", wrong_order()),
        *not_null(
            "agg_hourly_zone", "pickup_date", "pickup_hour", "pickup_location_id", "total_trips", "total_revenue"
        ),
        *not_null("agg_daily_borough", "pickup_date", "pickup_borough", "total_trips"),
        *not_null("agg_payment_trends", "pickup_month", "payment_type_label"),
        *accepted_values("agg_payment_trends", "payment_type_label", PAYMENTS),
    ]
    if dropoff_too:
        checks += relationship("fact_trips", "dropoff_location_id", "dim_zone", "location_id")
    return checks
