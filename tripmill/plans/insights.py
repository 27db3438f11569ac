"""Consumer questions over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import metrics as M
from tripmill.functions.scalars import pct_change
from tripmill.functions.states import mean_of, state_measures
from tripmill.operators import trends as T


def evening_weekday_zones(hourly: DataFrame, k: int = 10) -> DataFrame:
    """B1: pickup zones earning most between six and nine in the evening on weekdays."""
    busy = hourly.where(F.col("pickup_hour").between(18, 20) & ~F.col("is_weekend"))
    return T.top_k(_zone_revenue(busy), k, F.desc("revenue"), "pickup_zone", "pickup_borough")


def _zone_revenue(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_zone", "pickup_borough").agg(
        M.total("total_revenue").alias("revenue"), M.whole_total("total_trips").alias("trips")
    )


def cash_by_month(payments: DataFrame) -> DataFrame:
    """B2: cash share of all trips per month, and its change from the month before."""
    cash = F.when(F.col("payment_type_label") == "cash", F.col("trip_count")).otherwise(0)
    monthly = payments.groupBy("pickup_month").agg(
        F.sum(cash).alias("cash_trips"), F.sum("trip_count").alias("all_trips")
    )
    monthly = monthly.withColumn("cash_share_pct", F.round(F.lit(100.0) * F.col("cash_trips") / F.col("all_trips"), 2))
    moved = T.prior_period(
        monthly,
        [],
        "pickup_month",
        {"cash_share_pct": "prior_share_pct", "cash_trips": "_prior_cash"},
        steps=1,
        mode="calendar",
    )
    return moved.withColumns(
        {
            "share_change_points": F.round(F.col("cash_share_pct") - F.col("prior_share_pct"), 2),
            "cash_trips_mom_pct": pct_change("cash_trips", "_prior_cash"),
        }
    ).drop("_prior_cash")


def third_quarter_growth(daily: DataFrame) -> DataFrame:
    """B3: boroughs by their best and mean week-over-week change in the third quarter."""
    known = daily.where((F.quarter("pickup_date") == 3) & F.col("trips_wow_pct_change").isNotNull())
    return (
        known.groupBy("pickup_borough")
        .agg(
            F.max("trips_wow_pct_change").alias("max_wow_pct"),
            M.mean("trips_wow_pct_change", 2).alias("mean_wow_pct"),
            M.rows().alias("days_compared"),
        )
        .orderBy(F.desc("max_wow_pct"), F.asc_nulls_first("pickup_borough"))
    )


def airport_revenue_per_mile(fact: DataFrame, of=M.measures) -> DataFrame:
    """B4: revenue per mile of airport trips against the others; from trips, or their states."""
    return fact.groupBy("is_airport_trip").agg(*of(["trips", "revenue", "revenue_per_mile"]))


def weekend_hour_durations(fact: DataFrame, of=M.measures) -> DataFrame:
    """B5: weekend hours by mean duration, from trips or their states rather than from hourly means."""
    mean = mean_of("trip_duration_min", 2) if of is state_measures else M.mean("trip_duration_min", 2)
    return (
        fact.where("is_weekend")
        .groupBy("pickup_hour")
        .agg(mean.alias("avg_duration_min"), *of(["trips"]))
        .orderBy(F.desc("avg_duration_min"), "pickup_hour")
    )


def friday_evening_zones(hourly: DataFrame, k: int = 10) -> DataFrame:
    """B6: pickup zones earning most on Friday evenings."""
    friday = hourly.where(F.col("pickup_hour").between(17, 21) & (F.dayofweek("pickup_date") == 6))
    return T.top_k(_zone_revenue(friday), k, F.desc("revenue"), "pickup_zone", "pickup_borough")


def growth_since(daily: DataFrame, since: str) -> DataFrame:
    """B7: week-over-week trip growth by borough from a date on."""
    return (
        daily.where(F.col("pickup_date") >= F.lit(since).cast("date"))
        .select("pickup_date", "pickup_borough", "total_trips", "trips_wow_pct_change")
        .orderBy("pickup_date", F.asc_nulls_first("pickup_borough"))
    )


def payment_share_by_month(payments: DataFrame) -> DataFrame:
    """B8: trips per payment type and month, with the plain mean of the segment
    shares and the share weighted by trips.

    The plain mean keeps five digits, as a mean of one-digit decimals does.
    """
    monthly = payments.groupBy("pickup_month", "payment_type_label").agg(
        F.sum("trip_count").alias("trips"), M.mean("payment_type_share_pct", 5).alias("avg_share_pct")
    )
    return T.share_of(monthly, ["pickup_month"], "trips", "weighted_share_pct", 2).orderBy(
        "pickup_month", F.desc("trips"), "payment_type_label"
    )


def borough_months(fact: DataFrame) -> DataFrame:
    """Monthly trips and revenue per borough with month-over-month change."""
    monthly = fact.groupBy("pickup_borough", F.trunc("pickup_date", "month").alias("month_start")).agg(
        M.rows().alias("total_trips"), M.total("total_cost").alias("total_revenue")
    )
    return T.period_over_period(
        monthly,
        ["pickup_borough"],
        T.month_number("month_start"),
        {"total_trips": "trips_mom_pct_change", "total_revenue": "revenue_mom_pct_change"},
        steps=1,
        mode="calendar",
    )
