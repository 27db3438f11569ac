from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmill.functions import metrics as M
from tripmill.plans import gold as G
from tripmill.plans import insights as I
from tripmill.plans import silver as V
from tripmill.queries import QUERIES
from tripmill.sources.spine import date_spine, date_spine_of

# measured on the given tables with an independent engine
EXPECTED = {
    "0.001": {
        "raw_rows": 6318, "date_rejects": 5314, "rule_rejects": 352, "dupes_removed": 34, "silver_rows": 618,
        "fact": 572, "bands": (467, 37, 30, 38), "profile": [5310, 4, 31, 25, 12, 276, 8],
    },
    "0.01": {
        "raw_rows": 63032, "date_rejects": 53619, "rule_rejects": 3162, "dupes_removed": 304, "silver_rows": 5947,
        "fact": 5186, "bands": (4076, 377, 258, 473), "profile": [53573, 46, 180, 101, 105, 2715, 61],
    },
}
REASONS = [
    "date_infiltration: pickup year != 2024",
    "date_infiltration: dropoff year != 2024",
    "causality_violation: pickup >= dropoff",
    "invalid_distance: negative",
    "invalid_fare: negative",
    "invalid_passengers: null or zero",
    "missing_location_id",
]


@pytest.fixture(scope="module")
def expected(sf_dir):
    scale = sf_dir.rsplit("sf", 1)[1]
    if scale not in EXPECTED:
        pytest.skip("no measured counts for this scale")
    return EXPECTED[scale]


@pytest.fixture(scope="module")
def fact(spark, sf_dir):
    return QUERIES["fact_trips"](spark, sf_dir)


def test_funnel_matches_measured_counts(spark, sf_dir, expected):
    row = QUERIES["funnel_counts"](spark, sf_dir).collect()[0].asDict()
    assert row == {k: expected[k] for k in row}
    assert row["raw_rows"] == sum(v for k, v in row.items() if k != "raw_rows")


def test_profile_matches_measured_counts(spark, sf_dir, expected):
    found = {r.reject_reason: r.row_count for r in QUERIES["reject_profile"](spark, sf_dir).collect()}
    assert found == dict(zip(REASONS, expected["profile"]))


def test_fact_and_bands(spark, sf_dir, fact, expected):
    assert fact.count() == expected["fact"]
    bands = QUERIES["tip_bands"](spark, sf_dir).agg(*[F.sum(b).alias(b) for b in G.TIP_BANDS]).collect()[0]
    assert tuple(bands) == expected["bands"]


def test_rollups_add_up_to_the_fact(spark, sf_dir, fact):
    trips = fact.count()
    for table in (G.agg_hourly_zone(fact), G.daily_borough_base(fact)):
        assert table.agg(F.sum("total_trips")).collect()[0][0] == trips
    assert G.payment_base(fact).agg(F.sum("trip_count")).collect()[0][0] == trips


def test_last_day_of_month_to_date_is_the_month(spark, sf_dir, fact):
    daily = G.month_to_date(G.daily_borough_base(fact))
    last = daily.groupBy("pickup_borough", "pickup_month").agg(
        F.max_by("mtd_trips", "pickup_date").alias("mtd"), F.sum("total_trips").alias("month")
    )
    assert last.where("mtd <> month").count() == 0


def test_shares_of_a_segment_sum_to_one_hundred(spark, sf_dir, fact):
    sums = (
        G.agg_payment_trends(fact)
        .groupBy("pickup_month", "pickup_borough", "is_weekend")
        .agg(F.sum("payment_type_share_pct").alias("all"), F.count("*").alias("n"))
    )
    assert sums.where("abs(`all` - 100) > 0.05 * n + 1e-9").count() == 0


def test_calendar(spark):
    dates = G.dim_date(date_spine(spark, "2024-01-01", "2024-12-31"), as_of="2024-06-15")
    assert len(dates.columns) == 22
    rows = {r.calendar_date: r for r in dates.collect()}
    assert len(rows) == 366
    assert sum(r.is_us_holiday for r in rows.values()) == 11
    assert sum(r.is_current_month for r in rows.values()) == 30
    assert all(r.is_current_year for r in rows.values())
    leap = rows[dt.date(2024, 2, 29)]
    assert (leap.date_key, leap.quarter_label, leap.month_name, leap.month_abbr) == (20240229, "Q1", "February", "Feb")
    assert (leap.day_name, leap.day_abbr, leap.day_of_week, leap.day_of_year) == ("Thursday", "Thu", 5, 60)
    assert (leap.last_day_of_month, leap.week_start_date) == (dt.date(2024, 2, 29), dt.date(2024, 2, 26))
    sunday = rows[dt.date(2024, 12, 29)]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.week_of_year) == (1, True, 52)
    assert rows[dt.date(2024, 12, 30)].week_of_year == 1  # ISO week of the next year


def test_spine_over_data(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27),), (None,), (dt.date(2024, 3, 2),)], "d date")
    assert [r[0].day for r in date_spine_of(df, F.col("d")).orderBy("calendar_date").collect()] == [27, 28, 29, 1, 2]


def test_zone_flags(zones):
    rows = {r.location_id: r for r in G.dim_zone(zones).collect()}
    assert [rows[i].borough_type for i in (1, 2, 3, 4)] == ["core", "outer", "unknown", "outer"]
    assert [rows[i].is_airport_zone for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert [rows[i].is_major_hub for i in (1, 2, 3, 4)] == [True, True, False, False]


def _fact_of(trips, zones):
    silver = V.enrich_trips(V.derive_trips(V.parse_times(trips)), zones)
    lineage = silver.withColumns({"source_month": F.lit("2024-03"), "source_file": F.lit("f")})
    return G.fact_trips(G.staging_trips(lineage))


def test_fact_drops_outliers_and_unknown_speed(bronze, zones):
    same_second = {"tpep_dropoff_datetime": dt.datetime(2024, 3, 5, 10, 0, 0, 500)}
    trips = bronze({}, {"trip_distance": 500.0}, {"trip_distance": 0.0}, {"trip_distance": None}, same_second)
    assert _fact_of(trips, zones).count() == 1


def test_airport_lists_differ_on_newark(bronze, zones):
    trips = bronze({"PULocationID": 3, "DOLocationID": 4}, {"PULocationID": 4, "DOLocationID": 4}, {"PULocationID": 24})
    rows = _fact_of(trips, zones).orderBy("pickup_location_id").collect()
    assert [r.is_airport_trip for r in rows] == [True, False, True]
    assert [r.is_cross_borough for r in rows] == [True, False, False]
    assert set(G.FACT_COLUMNS) == set(rows[0].asDict())


def test_unmatched_borough_keeps_its_own_windows(bronze, zones):
    def on(day, place):
        at = dt.datetime(2024, 3, day, 10)
        return {
            "tpep_pickup_datetime": at,
            "tpep_dropoff_datetime": at + dt.timedelta(minutes=30),
            "PULocationID": place,
        }

    trips = bronze(on(1, 1), on(1, 24), on(2, 24), on(2, 24), on(2, 1))
    rows = {(r.pickup_borough, r.pickup_date.day): r for r in G.agg_daily_borough(_fact_of(trips, zones)).collect()}
    assert [rows[(None, d)].mtd_trips for d in (1, 2)] == [1, 3]
    assert rows[(None, 2)].borough_rank_by_trips == 1 and rows[("Manhattan", 2)].borough_rank_by_trips == 2


def test_load_times_are_given_by_the_caller(bronze, zones):
    fact = _fact_of(bronze({}), zones)
    row = G.agg_hourly_zone(fact, "2024-06-15T06:00:00").collect()[0]
    assert row.aggregated_at == dt.datetime(2024, 6, 15, 6)
    assert "aggregated_at" not in G.agg_hourly_zone(fact).columns


def test_cash_question(spark):
    payments = spark.createDataFrame(
        [(1, "cash", 40), (1, "credit_card", 60), (2, "cash", 30), (2, "credit_card", 90), (4, "cash", 1)],
        "pickup_month int, payment_type_label string, trip_count long",
    )
    rows = I.cash_by_month(payments).orderBy("pickup_month").collect()
    assert [(r.cash_share_pct, r.prior_share_pct, r.share_change_points) for r in rows] == [
        (40.0, None, None),
        (25.0, 40.0, -15.0),
        (100.0, None, None),  # March is missing
    ]


def test_weekend_durations_weigh_trips_not_hours(bronze, zones):
    def saturday(day, minutes):
        at = dt.datetime(2024, 3, day, 10)
        return {"tpep_pickup_datetime": at, "tpep_dropoff_datetime": at + dt.timedelta(minutes=minutes)}

    trips = bronze(saturday(2, 10), saturday(2, 11), saturday(9, 40))
    row = I.weekend_hour_durations(_fact_of(trips, zones)).collect()[0]
    assert (row.pickup_hour, row.avg_duration_min, row.trips) == (10, 20.33, 3)


def test_metric_names_per_table(bronze, zones):
    fact = _fact_of(bronze({}), zones)
    assert "avg_fare" in G.daily_borough_base(fact).columns
    assert "avg_fare_per_trip" in G.agg_hourly_zone(fact).columns
    assert set(M.REVENUE_BUNDLE) | set(M.VOLUME_BUNDLE) <= set(M.REGISTRY)
