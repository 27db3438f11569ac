"""Declared schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


BRONZE_TRIPS = _struct(
    VendorID=IntegerType,
    tpep_pickup_datetime=TimestampNTZType,
    tpep_dropoff_datetime=TimestampNTZType,
    passenger_count=LongType,
    trip_distance=DoubleType,
    RatecodeID=LongType,
    store_and_fwd_flag=StringType,
    PULocationID=IntegerType,
    DOLocationID=IntegerType,
    payment_type=IntegerType,
    fare_amount=DoubleType,
    extra=DoubleType,
    mta_tax=DoubleType,
    tip_amount=DoubleType,
    tolls_amount=DoubleType,
    improvement_surcharge=DoubleType,
)

ZONE_LOOKUP = _struct(LocationID=IntegerType, Borough=StringType, Zone=StringType, service_zone=StringType)

RUN_LOG = _struct(
    pipeline_name=StringType,
    target_month=StringType,
    run_mode=StringType,
    raw_rows=LongType,
    silver_rows=LongType,
    quarantine_rows=LongType,
    dupes_removed=LongType,
    run_timestamp=StringType,
)

INGEST_LOG = _struct(
    pipeline_name=StringType,
    target_month=StringType,
    rows_copied=LongType,
    run_id=StringType,
    status=StringType,
)
