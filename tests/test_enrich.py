from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmill.operators.enrich import enrich, enrich_role
from tripmill.plans import gold as G
from tripmill.plans import silver as V
from tripmill.sources.spine import date_spine


def test_unmatched_rows_stay(bronze, zones):
    trips = bronze({"PULocationID": 1}, {"PULocationID": 24}, {"PULocationID": None})
    out = enrich_role(trips, zones, "PULocationID", "LocationID", "pickup", V.ZONE_COLUMNS)
    rows = {r.PULocationID: (r.pickup_borough, r.pickup_zone, r.pickup_service_zone) for r in out.collect()}
    assert rows == {
        1: ("Manhattan", "Midtown Center", "Yellow Zone"),
        24: (None, None, None),
        None: (None, None, None),
    }


def test_one_lookup_in_two_roles(bronze, zones):
    trip = V.enrich_trips(bronze({}), zones).collect()[0]
    assert (trip.pickup_borough, trip.dropoff_borough) == ("Manhattan", "Queens")
    assert (trip.pickup_zone, trip.dropoff_zone) == ("Midtown Center", "JFK Airport")


def test_duplicate_lookup_key_stops_the_query(spark, bronze, zones):
    twice = zones.unionByName(zones.where("LocationID = 1"))
    with pytest.raises(PySparkException, match="duplicate lookup key in LocationID: 1"):
        enrich(bronze({}), twice, "PULocationID", "LocationID", {"Zone": "zone"}).collect()


def test_duplicate_key_is_noticed_without_any_lookup_column_in_use(spark, bronze, zones):
    twice = zones.unionByName(zones)
    joined = enrich(bronze({}), twice, "PULocationID", "LocationID", {"Zone": "zone"})
    with pytest.raises(PySparkException, match="duplicate lookup key"):
        joined.select("VendorID").collect()


def test_star_join_slices(spark, bronze, zones):
    holiday = {"tpep_pickup_datetime": dt.datetime(2024, 7, 4, 9)}
    trips = bronze({}, {**holiday, "tpep_dropoff_datetime": dt.datetime(2024, 7, 4, 10)})
    silver = V.enrich_trips(V.derive_trips(V.parse_times(trips)), zones)
    lineage = silver.withColumns({"source_month": F.lit("2024-03"), "source_file": F.lit("f")})
    fact = G.fact_trips(G.staging_trips(lineage))
    dates = G.dim_date(date_spine(spark, "2024-01-01", "2024-12-31"), "2024-06-15")
    rows = G.trip_star(fact, dates, G.dim_zone(zones)).orderBy("date_key").collect()
    assert [(r.quarter_label, r.is_us_holiday) for r in rows] == [("Q1", False), ("Q3", True)]
    assert rows[0].pickup_is_major_hub and rows[0].dropoff_is_airport_zone
    assert (rows[0].pickup_borough_type, rows[0].dropoff_borough_type) == ("core", "outer")


def test_large_lookup_takes_a_shuffled_join(spark, bronze, zones):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = V.enrich_trips(bronze({}, {"PULocationID": 24}), zones)
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
