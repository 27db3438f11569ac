from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tripmill.operators import rules as R
from tripmill.plans import silver as V


def reasons(df):
    return [r[R.REASON] for r in df.collect()]


def test_first_matching_rule_names_the_reason(bronze):
    trips = bronze(
        {"tpep_pickup_datetime": dt.datetime(2023, 12, 31, 23, 59), "fare_amount": -1.0},
        {"tpep_dropoff_datetime": dt.datetime(2025, 1, 1), "passenger_count": 0},
        {"tpep_dropoff_datetime": dt.datetime(2024, 3, 5, 10, 0), "trip_distance": -1.0},
        {"trip_distance": -1.0, "fare_amount": -1.0},
        {"fare_amount": -0.01, "passenger_count": None},
        {"passenger_count": None},
        {"passenger_count": 0},
        {"PULocationID": None},
        {"DOLocationID": None},
        {},
    )
    assert reasons(V.tag_trips(trips)) == [
        "date_infiltration: pickup year != 2024",
        "date_infiltration: dropoff year != 2024",
        "causality_violation: pickup >= dropoff",
        "invalid_distance: negative",
        "invalid_fare: negative",
        "invalid_passengers: null or zero",
        "invalid_passengers: null or zero",
        "missing_location_id",
        "missing_location_id",
        None,
    ]


def test_unknown_values_pass_unless_a_rule_names_them(bronze):
    trips = bronze({"tpep_pickup_datetime": None}, {"fare_amount": None}, {"trip_distance": None})
    assert reasons(V.tag_trips(trips)) == [None, None, None]
    strict = R.unknown_rules(["tpep_pickup_datetime", "fare_amount", "trip_distance"])
    assert reasons(R.tag_rejects(trips, strict)) == [
        "missing_value: tpep_pickup_datetime",
        "missing_value: fare_amount",
        "missing_value: trip_distance",
    ]


def test_split_keeps_every_row_once(bronze):
    tagged = V.tag_trips(bronze({}, {"fare_amount": -1.0}, {"passenger_count": 0}))
    assert R.accepted(tagged).count() == 1
    assert R.REASON not in R.accepted(tagged).columns
    assert R.rejected(tagged).count() == 2


def test_other_year_is_a_parameter(bronze):
    trips = bronze({}, {"tpep_pickup_datetime": dt.datetime(2025, 1, 1), "tpep_dropoff_datetime": dt.datetime(2025, 1, 2)})
    assert reasons(V.tag_trips(trips, 2025)) == ["date_infiltration: pickup year != 2025", None]


def test_funnel_adds_up(bronze):
    trips = bronze(
        {}, {}, {"tip_amount": 9.0}, {"fare_amount": 21.0}, {"fare_amount": -1.0}, {"PULocationID": None},
        {"tpep_pickup_datetime": dt.datetime(2009, 1, 1)},
    )
    row = R.funnel(V.tag_trips(trips), V.TRIP_KEYS, V.date_reasons()).collect()[0].asDict()
    assert row == {"raw_rows": 7, "date_rejects": 1, "rule_rejects": 2, "dupes_removed": 2, "silver_rows": 2}


def test_funnel_of_nothing(bronze):
    empty = V.tag_trips(bronze({})).where("1 = 0")
    row = R.funnel(empty, V.TRIP_KEYS, V.date_reasons()).collect()[0]
    assert tuple(row) == (0, 0, 0, 0, 0)


def test_union_of_stages_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, reject_reason string")
    b = spark.createDataFrame([(2, "y", 7)], "id int, reject_reason string, extra int")
    rows = sorted(map(tuple, R.union_rejects(a, b).collect()))
    assert rows == [(1, "x", None), (2, "y", 7)]


def test_profile_counts_reasons(bronze):
    tagged = V.tag_trips(bronze({}, {"fare_amount": -1.0}, {"fare_amount": -2.0}))
    assert {tuple(r) for r in R.reject_profile(tagged).collect()} == {("invalid_fare: negative", 2)}


def test_no_rules_reject_nothing(bronze):
    assert R.rejected(R.tag_rejects(bronze({}), [])).where(F.lit(True)).count() == 0
