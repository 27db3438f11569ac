"""Bronze to Silver: reject, deduplicate, derive, enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import scalars as S
from tripmill.operators.dedup import keep_first
from tripmill.operators.enrich import enrich_role
from tripmill.operators.rules import Rule, accepted, tag_rejects
from tripmill.operators.schema import RESCUE
from tripmill.sources.schemas import BRONZE_TRIPS

# Reject reasons and payment names, as stored in the tables.
BAD_PICKUP_YEAR = "date_infiltration: pickup year != {year}"
BAD_DROPOFF_YEAR = "date_infiltration: dropoff year != {year}"
BAD_ORDER = "causality_violation: pickup >= dropoff"
BAD_DISTANCE = "invalid_distance: negative"
BAD_FARE = "invalid_fare: negative"
BAD_PASSENGERS = "invalid_passengers: null or zero"
NO_LOCATION = "missing_location_id"
UNREADABLE = "unreadable_value: does not fit the declared type"
PAYMENT_NAMES = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}
UNKNOWN_PAYMENT = "unknown"

YEAR = 2024
MAX_SPEED_MPH = 100
TRIP_KEYS = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "fare_amount"]
# what says where a row came from rather than what the trip was
LINEAGE = ["source_file", "source_month", "ingested_at", "trip_file"]
COST_PARTS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge"]
ZONE_COLUMNS = {"Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}


def parse_times(bronze: DataFrame) -> DataFrame:
    """Typed timestamps beside the raw ones; text that is no timestamp becomes NULL."""
    return bronze.withColumns(
        {
            "pickup_datetime": F.col("tpep_pickup_datetime").try_cast("timestamp_ntz"),
            "dropoff_datetime": F.col("tpep_dropoff_datetime").try_cast("timestamp_ntz"),
        }
    )


def date_reasons(year: int = YEAR) -> list[str]:
    return [BAD_PICKUP_YEAR.format(year=year), BAD_DROPOFF_YEAR.format(year=year)]


def date_rules(year: int = YEAR) -> list[Rule]:
    pickup, dropoff = date_reasons(year)
    return [
        Rule(pickup, F.year("pickup_datetime") != year),
        Rule(dropoff, F.year("dropoff_datetime") != year),
    ]


def business_rules() -> list[Rule]:
    riders = F.col("passenger_count")
    return [
        Rule(BAD_ORDER, F.col("pickup_datetime") >= F.col("dropoff_datetime")),
        Rule(BAD_DISTANCE, F.col("trip_distance") < 0),
        Rule(BAD_FARE, F.col("fare_amount") < 0),
        Rule(BAD_PASSENGERS, riders.isNull() | (riders <= 0)),
        Rule(NO_LOCATION, F.col("PULocationID").isNull() | F.col("DOLocationID").isNull()),
    ]


def rescue_rules(bronze: DataFrame) -> list[Rule]:
    """A declared column whose value did not fit its type is no missing value: it has a reason of its own."""
    if RESCUE not in bronze.columns:
        return []
    lost = F.json_object_keys(F.col(RESCUE))
    return [Rule(UNREADABLE, F.arrays_overlap(lost, F.array(*[F.lit(c) for c in BRONZE_TRIPS.names])))]


def tag_trips(bronze: DataFrame, year: int = YEAR) -> DataFrame:
    """Unreadable values first, then date rules before business rules; one reason per row."""
    return tag_rejects(parse_times(bronze), rescue_rules(bronze) + date_rules(year) + business_rules())


def dedup_trips(trips: DataFrame) -> DataFrame:
    """The earliest submission of each trip.

    Ties within a month are settled by the trip's own columns alone, so that neither
    landing a file again nor another ingest time changes the survivor.
    """
    own = sorted(c for c in trips.columns if c not in LINEAGE and c not in TRIP_KEYS)
    return keep_first(trips, TRIP_KEYS, ["source_month"], [F.xxhash64(*own)] if own else [])


def derive_trips(trips: DataFrame) -> DataFrame:
    """Trip measures, calendar parts, labels and the outlier flag.

    Speed uses the rounded duration and the flag the rounded speed, so each step
    builds on the one before.
    """
    seconds = S.whole_seconds("pickup_datetime", "dropoff_datetime")
    duration = F.col("trip_duration_min")
    return (
        trips.withColumn("trip_duration_min", S.minutes_of(seconds))
        .withColumn("avg_speed_mph", S.guarded_speed(F.col("trip_distance"), duration))
        .withColumns(
            {
                "pickup_hour": F.hour("pickup_datetime"),
                "pickup_day_of_week": F.dayofweek("pickup_datetime"),
                "pickup_month": F.month("pickup_datetime"),
                "pickup_year_month": S.year_month("pickup_datetime"),
                "pickup_date": F.col("pickup_datetime").cast("date"),
                "is_weekend": S.is_weekend("pickup_datetime"),
                "total_cost": S.sum_of(COST_PARTS, 2),
                "tip_pct": S.guarded_ratio(F.col("tip_amount"), F.col("fare_amount"), 1, factor=100.0),
                "payment_type_label": S.label("payment_type", PAYMENT_NAMES, UNKNOWN_PAYMENT),
                "is_speed_outlier": F.col("avg_speed_mph") > MAX_SPEED_MPH,
            }
        )
    )


def enrich_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough, zone and service zone of both ends; unmatched ends keep NULLs."""
    trips = enrich_role(trips, zones, "PULocationID", "LocationID", "pickup", ZONE_COLUMNS)
    return enrich_role(trips, zones, "DOLocationID", "LocationID", "dropoff", ZONE_COLUMNS)


def silver_trips(bronze: DataFrame, zones: DataFrame, year: int = YEAR) -> DataFrame:
    """Rejects leave before deduplication, so a bad copy never displaces a good one."""
    kept = dedup_trips(accepted(tag_trips(bronze, year)))
    return enrich_trips(derive_trips(kept), zones)
