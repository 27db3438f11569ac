"""Staging, dimensions, the trip fact, its states and its three aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import scalars as S
from tripmill.functions.holidays import is_holiday
from tripmill.functions.metrics import band_counts, measures
from tripmill.functions.states import partial_states, state_bands, state_measures
from tripmill.operators import trends as T
from tripmill.operators.enrich import star_join
from tripmill.operators.schema import conform
from tripmill.plans.silver import TRIP_KEYS

# Federal holidays of 2024 as the tables list them, borough groups, hub names, airport patterns.
US_HOLIDAYS = [
    "2024-01-01",
    "2024-01-15",
    "2024-02-19",
    "2024-05-27",
    "2024-06-19",
    "2024-07-04",
    "2024-09-02",
    "2024-10-14",
    "2024-11-11",
    "2024-11-28",
    "2024-12-25",
]
BOROUGH_TYPES = {
    "Manhattan": "core",
    "Brooklyn": "outer",
    "Queens": "outer",
    "Bronx": "outer",
    "Staten Island": "outer",
}
MAJOR_HUBS = [
    "Times Sq/Theatre District",
    "Midtown Center",
    "Penn Station/Madison Sq West",
    "Grand Central",
    "Upper East Side North",
    "Upper East Side South",
    "JFK Airport",
    "LaGuardia Airport",
]
AIRPORT_ZONE_PATTERNS = ["%Airport%", "%JFK%", "%LaGuardia%", "%Newark%"]
# the fact's own list, without Newark; the two are kept apart on purpose
AIRPORT_TRIP_PATTERNS = ["%Airport%", "%JFK%", "%LaGuardia%"]

TIP_BANDS = ["trips_no_tip", "trips_low_tip", "trips_mid_tip", "trips_high_tip"]
TIP_EDGES = [0, 15, 25]


# --- staging ------------------------------------------------------------------


# Column names as the tables have them.
STAGING_COLUMNS = {
    "pickup_datetime": "pickup_datetime",
    "dropoff_datetime": "dropoff_datetime",
    "pickup_date": "pickup_date",
    "pickup_hour": "pickup_hour",
    "pickup_day_of_week": "pickup_day_of_week",
    "pickup_month": "pickup_month",
    "pickup_year_month": "pickup_year_month",
    "is_weekend": "is_weekend",
    "pickup_location_id": "cast(PULocationID as int)",
    "dropoff_location_id": "cast(DOLocationID as int)",
    "pickup_borough": "pickup_borough",
    "pickup_zone": "pickup_zone",
    "pickup_service_zone": "pickup_service_zone",
    "dropoff_borough": "dropoff_borough",
    "dropoff_zone": "dropoff_zone",
    "dropoff_service_zone": "dropoff_service_zone",
    "trip_distance": "trip_distance",
    "trip_duration_min": "trip_duration_min",
    "avg_speed_mph": "avg_speed_mph",
    "is_speed_outlier": "is_speed_outlier",
    "passenger_count": "passenger_count",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_cost": "total_cost",
    "tip_pct": "tip_pct",
    "payment_type": "payment_type",
    "payment_type_label": "payment_type_label",
    "vendor_id": "VendorID",
    "rate_code_id": "RatecodeID",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "source_month": "source_month",
    "source_file": "source_file",
}


def staging_trips(silver: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """Conformed names and the surrogate trip key; a plain projection, meant as a view."""
    keyed = silver.withColumn("trip_id", S.surrogate_key(TRIP_KEYS, casts))
    return conform(keyed, {"trip_id": "trip_id", **STAGING_COLUMNS})


# --- dimensions ---------------------------------------------------------------


def dim_date(spine: DataFrame, as_of: str, holidays: list[str] | None = None) -> DataFrame:
    """Calendar attributes of each day.

    Weeks start on Monday (``week_of_year``, ``week_start_date``), while
    ``day_of_week`` counts from Sunday = 1. ``as_of`` settles the current-period
    flags instead of the clock. Holidays are the listed dates, or those of the federal
    rules in any year.
    """
    day = F.col("calendar_date")
    today = F.lit(as_of).cast("date")
    this_year = F.year(day) == F.year(today)
    return spine.select(
        S.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_num"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_label"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_abbr"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_abbr"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        S.is_weekend(day).alias("is_weekend"),
        (is_holiday(day) if holidays is None else _listed(day, holidays)).alias("is_us_holiday"),
        F.last_day(day).alias("last_day_of_month"),
        F.trunc(day, "week").alias("week_start_date"),
        F.trunc(day, "month").alias("month_start_date"),
        F.trunc(day, "quarter").alias("quarter_start_date"),
        (this_year & (F.month(day) == F.month(today))).alias("is_current_month"),
        this_year.alias("is_current_year"),
    )


def _listed(day: Column, holidays: list[str]) -> Column:
    return day.isin([F.lit(h).cast("date") for h in holidays])


def dim_zone(zones: DataFrame) -> DataFrame:
    zone = F.col("Zone")
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        zone.alias("zone_name"),
        F.col("Borough").alias("borough"),
        "service_zone",
        S.label("Borough", BOROUGH_TYPES, "unknown").alias("borough_type"),
        S.matches_any([zone], AIRPORT_ZONE_PATTERNS).alias("is_airport_zone"),
        F.coalesce(zone.isin(MAJOR_HUBS), F.lit(False)).alias("is_major_hub"),
    )


# --- fact ---------------------------------------------------------------------


# Column names of the fact.
FACT_COLUMNS = [
    "trip_id",
    "date_key",
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_month",
    "pickup_year_month",
    "pickup_date",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
    "dropoff_borough",
    "dropoff_zone",
    "dropoff_service_zone",
    "passenger_count",
    "trip_distance",
    "trip_duration_min",
    "avg_speed_mph",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_cost",
    "tip_pct",
    "payment_type_label",
    "rate_code_id",
    "vendor_id",
    "store_and_fwd_flag",
    "is_cross_borough",
    "is_airport_trip",
    "source_month",
]


def fact_trips(staging: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Trips that are no speed outlier and have a positive duration and distance.

    An unknown outlier flag does not count as false, so such rows leave too.
    """
    kept = staging.where("is_speed_outlier = false and trip_duration_min > 0 and trip_distance > 0")
    flagged = kept.withColumns(
        {
            "date_key": S.date_key("pickup_date"),
            "is_cross_borough": S.differs("pickup_borough", "dropoff_borough"),
            "is_airport_trip": S.matches_any(["pickup_zone", "dropoff_zone"], AIRPORT_TRIP_PATTERNS),
        }
    )
    return stamped(flagged.selectExpr(*FACT_COLUMNS), "loaded_at", loaded_at)


def stamped(df: DataFrame, name: str, at: str | None) -> DataFrame:
    """Adds a run time given by the caller, so that a rerun writes the same rows."""
    return df if at is None else df.withColumn(name, F.lit(at).cast("timestamp_ntz"))


# --- aggregates ---------------------------------------------------------------
# Each takes the fact, or with ``of=state_measures`` the stored states of its trips.

# Grains and published names of the three tables.
HOURLY_GRAIN = [
    "pickup_date",
    "pickup_month",
    "pickup_hour",
    "is_weekend",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
]
DAILY_GRAIN = ["pickup_date", "pickup_month", "is_weekend", "pickup_borough"]
PAYMENT_GRAIN = ["pickup_month", "pickup_borough", "is_weekend", "payment_type_label"]


def trip_states(fact: DataFrame) -> DataFrame:
    """The one scan of the fact that all aggregates need."""
    return partial_states(fact, "tip_pct", TIP_EDGES, TIP_BANDS)


def agg_hourly_zone(fact: DataFrame, at: str | None = None, of=measures) -> DataFrame:
    columns = of(
        {
            "trips": "total_trips",
            "passengers": "total_passengers",
            "revenue": "total_revenue",
            "mean_cost": "avg_fare_per_trip",
            "tips": "total_tips",
            "mean_tip_pct": "avg_tip_pct",
            "mean_distance": "avg_trip_distance_mi",
            "mean_duration": "avg_trip_duration_min",
            "mean_speed": "avg_speed_mph",
            "card_trips": "trips_credit_card",
            "cash_trips": "trips_cash",
            "airport_trips": "airport_trips",
            "cross_borough_trips": "cross_borough_trips",
            "revenue_per_mile": "revenue_per_mile",
        }
    )
    return stamped(fact.groupBy(*HOURLY_GRAIN).agg(*columns), "aggregated_at", at)


def daily_borough_base(fact: DataFrame, of=measures) -> DataFrame:
    columns = of(
        {
            "trips": "total_trips",
            "revenue": "total_revenue",
            "mean_cost": "avg_fare",
            "mean_distance": "avg_distance_mi",
            "mean_duration": "avg_duration_min",
            "tips": "total_tips",
            "mean_tip_pct": "avg_tip_pct",
            "passengers": "total_passengers",
            "airport_trips": "airport_trips",
            "cross_borough_trips": "cross_borough_trips",
            "pickup_zones": "active_pickup_zones",
        }
    )
    return fact.groupBy(*DAILY_GRAIN).agg(*columns)


def week_over_week(daily: DataFrame, mode: str = "rows") -> DataFrame:
    """Change against seven rows earlier, or against the same weekday of the week before."""
    position = "pickup_date" if mode == "rows" else T.day_number("pickup_date")
    return T.period_over_period(
        daily,
        ["pickup_borough"],
        position,
        {"total_trips": "trips_wow_pct_change", "total_revenue": "revenue_wow_pct_change"},
        steps=7,
        mode=mode,
        keep_prior={"total_trips": "trips_wow_prior"},
    )


def month_to_date(daily: DataFrame) -> DataFrame:
    """Running totals per calendar month; the year is part of the month here."""
    keyed = daily.withColumn("_month", F.trunc("pickup_date", "month"))
    return T.running_total(
        keyed,
        ["pickup_borough", "_month"],
        "pickup_date",
        counts={"total_trips": "mtd_trips"},
        amounts={"total_revenue": "mtd_revenue"},
    ).drop("_month")


def borough_ranks(daily: DataFrame) -> DataFrame:
    return T.rank_within(
        daily,
        ["pickup_date"],
        {"total_trips": "borough_rank_by_trips", "total_revenue": "borough_rank_by_revenue"},
    )


def daily_trends(daily: DataFrame, mode: str = "rows") -> DataFrame:
    """Changes, running totals and ranks beside the daily totals."""
    return borough_ranks(month_to_date(week_over_week(daily, mode)))


def agg_daily_borough(fact: DataFrame, at: str | None = None, mode: str = "rows", of=measures) -> DataFrame:
    return stamped(daily_trends(daily_borough_base(fact, of), mode), "aggregated_at", at)


def payment_base(fact: DataFrame, of=measures) -> DataFrame:
    columns = of(
        {"trips": "trip_count", "revenue": "total_revenue", "tips": "total_tips", "mean_tip_pct": "avg_tip_pct"}
    )
    bands = state_bands(TIP_BANDS) if of is state_measures else band_counts("tip_pct", TIP_EDGES, TIP_BANDS)
    return fact.groupBy(*PAYMENT_GRAIN).agg(*columns, *bands)


def agg_payment_trends(fact: DataFrame, at: str | None = None, of=measures) -> DataFrame:
    segment = [c for c in PAYMENT_GRAIN if c != "payment_type_label"]
    shared = T.share_of(payment_base(fact, of), segment, "trip_count", "payment_type_share_pct")
    return stamped(shared, "aggregated_at", at)


# --- star ---------------------------------------------------------------------


def pruned_star(fact: DataFrame, dates: DataFrame, zones: DataFrame, days: Column) -> DataFrame:
    """The star of the trips on the calendar days that ``days`` selects.

    The calendar joins on the month that the written fact is partitioned by, beside the
    day, so Spark hands the months that the filter leaves to the fact's scan at run time
    and other partitions are not read.
    """
    chosen = dates.where(days).select("date_key", "calendar_date")
    chosen = chosen.select(
        F.col("date_key").alias("_day"), S.year_month("calendar_date").alias("_part")
    )
    met = fact.join(chosen, (F.col("pickup_year_month") == F.col("_part")) & (F.col("date_key") == F.col("_day")))
    return trip_star(met.drop("_day", "_part"), dates, zones)


def trip_star(fact: DataFrame, dates: DataFrame, zones: DataFrame) -> DataFrame:
    """The fact with calendar flags and the zone flags of both ends."""
    calendar = {c: c for c in ("quarter_label", "month_name", "day_name", "is_us_holiday")}
    flags = ("borough_type", "is_airport_zone", "is_major_hub")
    return star_join(
        fact,
        (dates, "date_key", "date_key", calendar),
        (zones, "pickup_location_id", "location_id", {c: f"pickup_{c}" for c in flags}),
        (zones, "dropoff_location_id", "location_id", {c: f"dropoff_{c}" for c in flags}),
    )
