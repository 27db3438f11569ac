from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmill.functions import metrics as M


def one(df, column):
    return df.agg(column.alias("x")).collect()[0].x


def test_sums_do_not_depend_on_order(spark):
    values = [(0.1,)] * 10 + [(1e9,), (-1e9,)]
    up = spark.createDataFrame(values, "v double")
    down = spark.createDataFrame(values[::-1], "v double").repartition(3)
    assert one(up, M.total("v")) == one(down, M.total("v")) == 1.0


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(24.69,), (0.0,)], "v double")
    assert one(df, M.mean("v", 2)) == 12.35
    assert one(spark.createDataFrame([(-1.005,)], "v double"), M.total("v")) == -1.01


def test_means_skip_nulls_and_survive_empty_groups(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert one(df, M.mean("v", 1)) == 1.5
    assert one(df.where("v is null"), M.mean("v", 1)) is None
    assert one(df.where("1 = 0"), M.total("v")) is None


def test_ratio_of_totals_guards_zero(spark):
    df = spark.createDataFrame([(10.0, 4.0), (5.0, 0.0)], "a double, b double")
    assert one(df, M.ratio_of_totals("a", "b")) == 3.75
    assert one(df.where("b = 0"), M.ratio_of_totals("a", "b")) is None


def test_small_values_and_large_sums_are_kept(spark):
    small = spark.range(100_000).select(F.lit(0.00004).alias("v"))
    assert one(small, M.total("v")) == 4.0
    large = spark.createDataFrame([(5e14,), (5e14,), (0.25,)], "v double")
    assert one(large, M.total("v")) == 1e15 + 0.25
    assert one(large, M.mean("v", 2)) == pytest.approx(1e15 / 3, abs=0.5)
    mixed = spark.createDataFrame([(1.23456789,), (-0.23456789,), (2.5,), (None,), (-7.0,)], "v double")
    assert one(mixed, M.total("v", 8)) == -3.5
    fast = spark.range(1000).select(F.lit(8.9e10).alias("v"))
    assert one(fast, M.total("v")) == 8.9e13


def test_a_sum_past_the_range_raises(spark):
    df = spark.createDataFrame([(9e24,), (9e24,)], "v double")
    with pytest.raises(PySparkException):
        one(df, M.total("v"))


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 15.0, 15.1, 25.0, 25.1, -3.0, None)], "v double")
    row = df.agg(*M.band_counts("v", [0, 15, 25], ["none", "low", "mid", "high"])).collect()[0]
    assert tuple(row) == (1, 1, 2, 1)
    with pytest.raises(ValueError):
        M.band_counts("v", [0, 15], ["none"])


def test_bundles_take_a_prefix(spark):
    df = spark.createDataFrame(
        [(10.0, 1.0, 10.0, 2.0, 1, 6.0, 20.0)],
        "total_cost double, tip_amount double, tip_pct double, trip_distance double, passenger_count long,"
        " trip_duration_min double, avg_speed_mph double",
    ).alias("t")
    row = df.agg(*M.revenue_metrics("t."), *M.trip_volume_metrics("t.")).collect()[0].asDict()
    assert row == {
        "total_revenue": 10.0,
        "avg_fare_per_trip": 10.0,
        "total_tips": 1.0,
        "avg_tip_pct": 10.0,
        "revenue_per_mile": 5.0,
        "total_trips": 1,
        "total_passengers": 1,
        "avg_distance_mi": 2.0,
        "avg_duration_min": 6.0,
        "avg_speed_mph": 20.0,
    }


def test_distinct_and_conditional_counts(spark):
    df = spark.createDataFrame([(1, True), (1, None), (2, False)], "k int, f boolean")
    assert one(df, M.distinct_count("k")) == 2
    assert one(df, M.count_where(F.col("f"))) == 1
