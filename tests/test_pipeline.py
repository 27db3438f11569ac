from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripmill.operators.checks import QualityGateError
from tripmill.operators.schema import align_schema, require_columns
from tripmill.plans import pipeline as P
from tripmill.plans.gold import US_HOLIDAYS
from tripmill.session import shared_folder
from tripmill.sinks import landing as L
from tripmill.sinks import layout as Y
from tripmill.sinks import tables as K
from tripmill.sources.bronze import month_paths, read_bronze, read_lookup
from tripmill.sources.schemas import BRONZE_TRIPS, INGEST_LOG

TS = "2024-06-15T06:00:00"


def at(month, day, hour=10, fare=20.0, tip=3.0, **more):
    start = dt.datetime(2024, month, day, hour)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + dt.timedelta(minutes=30),
        "fare_amount": fare,
        "tip_amount": tip,
        **more,
    }


@pytest.fixture
def lake(lake_root, zones):
    made = P.Lake(lake_root)
    L.land_lookup(zones, made.lookup)
    return made


def silver(spark, lake):
    rows = P.read(spark, lake, lake.silver).collect()
    return sorted((r.pickup_year_month, r.source_month, r.pickup_datetime.day, r.tip_amount) for r in rows)


def january(bronze):
    return bronze(at(1, 5), at(1, 6, tip=4.0), at(1, 31, fare=-1.0), at(2, 1, tip=5.0))


def february(bronze):
    # the first row resubmits one of January's, the second one of the strays
    return bronze(at(1, 5, tip=9.0), at(2, 1, tip=8.0), at(2, 10, tip=1.0), at(2, 11, passenger_count=0))


EXPECTED = [
    ("2024-01", "2024-01", 5, 3.0),
    ("2024-01", "2024-01", 6, 4.0),
    ("2024-02", "2024-01", 1, 5.0),
    ("2024-02", "2024-02", 10, 1.0),
]


def test_landing_counts_and_paths(spark, lake, bronze):
    assert L.land_month(january(bronze), lake.bronze, "2024", "01") == 4
    back = read_bronze(spark, lake.bronze, "2024-01", TS).collect()
    assert {r.source_month for r in back} == {"2024-01"}
    assert all("yellow_tripdata_2024-01.parquet" in r.source_file for r in back)
    assert {r.ingested_at for r in back} == {dt.datetime(2024, 6, 15, 6)}
    assert L.land_month(january(bronze), lake.bronze, "2024", "01") == 4  # replaced, not appended
    with pytest.raises(ValueError):
        month_paths(lake.bronze, "January")


def test_landing_many_months_at_once(spark, lake, bronze):
    trips = january(bronze).withColumn("source_month", F.lit("2024-01")).unionByName(
        february(bronze).withColumn("source_month", F.lit("2024-02"))
    )
    L.land_months(trips, lake.bronze)
    counts = read_bronze(spark, lake.bronze, "all", TS).groupBy("source_month").count().collect()
    assert {tuple(r) for r in counts} == {("2024-01", 4), ("2024-02", 4)}
    assert read_bronze(spark, lake.bronze, ["2024-02"], TS).count() == 4


def test_lookup_is_landed_once(spark, lake, zones):
    L.land_lookup(zones.where("LocationID = 1"), lake.lookup)
    assert read_lookup(spark, lake.lookup).count() == 4


@pytest.mark.parametrize("order", [["full"], ["2024-01", "2024-02"], ["2024-02", "2024-01"]])
def test_any_order_of_months_gives_the_same_silver(spark, lake, bronze, order):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    for step in order:
        if step == "full":
            log = P.run_silver(spark, lake, mode="full", run_ts=TS)
            assert (log["raw_rows"], log["silver_rows"], log["quarantine_rows"], log["dupes_removed"]) == (8, 4, 2, 2)
        else:
            P.run_silver(spark, lake, step, "incremental", TS)
    assert silver(spark, lake) == EXPECTED
    assert P.read(spark, lake, lake.quarantine).count() == 2


def test_rerun_changes_nothing(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    for _ in range(2):
        log = P.run_silver(spark, lake, "2024-02", "incremental", TS)
        assert (log["raw_rows"], log["silver_rows"], log["quarantine_rows"], log["dupes_removed"]) == (4, 1, 1, 2)
    assert silver(spark, lake) == EXPECTED
    assert P.read(spark, lake, lake.run_log).count() == 3


def test_corrected_month_gives_back_what_it_displaced(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    # January is landed again without the resubmitted trip, the bad fare and the stray
    L.land_month(bronze(at(1, 6, tip=4.0)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert silver(spark, lake) == [
        ("2024-01", "2024-01", 6, 4.0),
        ("2024-01", "2024-02", 5, 9.0),
        ("2024-02", "2024-02", 1, 8.0),
        ("2024-02", "2024-02", 10, 1.0),
    ]
    assert P.read(spark, lake, lake.quarantine).where("source_month = '2024-01'").count() == 0


def test_partition_that_loses_all_rows_is_emptied(spark, lake, bronze):
    L.land_month(bronze(at(1, 5), at(3, 1)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert len(silver(spark, lake)) == 2
    L.land_month(bronze(at(1, 5)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert silver(spark, lake) == [("2024-01", "2024-01", 5, 3.0)]


def test_month_without_accepted_rows(spark, lake, bronze):
    L.land_month(bronze(at(1, 5, fare=-1.0)), lake.bronze, "2024", "01")
    log = P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert (log["raw_rows"], log["silver_rows"], log["quarantine_rows"], log["dupes_removed"]) == (1, 0, 1, 0)


def test_trips_without_a_pickup_time_stay_in_silver(spark, lake, bronze):
    L.land_month(bronze(at(1, 5), {"tpep_pickup_datetime": None}), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    parts = {r.pickup_year_month for r in P.read(spark, lake, lake.silver).collect()}
    assert parts == {"2024-01", P.NO_MONTH}


def test_gold_and_gate(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    log = P.run_pipeline(spark, lake, "all", "full", TS, "2024-06-15")
    assert log["silver_rows"] == 3
    gold = {name: P.read(spark, lake, lake.gold(name)) for name in P.GOLD_TABLES}
    assert gold["dim_date"].count() == 366
    assert gold["fact_trips"].count() == 3
    assert gold["agg_daily_borough"].agg(F.sum("total_trips")).collect()[0][0] == 3
    assert spark.table("stg_silver_trips").count() == 3
    report = {(r["check"], r["table"], r["column"]): r["failures"] for r in P.check_run(spark, lake).collect()}
    assert len(report) == 39 and set(report.values()) == {0}


def test_gate_stops_on_an_unmatched_zone(spark, lake, bronze):
    L.land_month(bronze(at(1, 5), at(1, 6, PULocationID=24)), lake.bronze, "2024", "01")
    with pytest.raises(QualityGateError, match="relationships on fact_trips.pickup_location_id: 1"):
        P.run_pipeline(spark, lake, "all", "full", TS, "2024-06-15")


def test_unknown_mode(spark, lake):
    with pytest.raises(ValueError):
        P.run_silver(spark, lake, mode="sometimes")


def test_ingest_log(spark, lake_root):
    L.log_ingest(spark, f"{lake_root}/ingest_log", "2024-01", 4, "run-1")
    row = spark.read.schema(INGEST_LOG).parquet(f"{lake_root}/ingest_log").collect()[0]
    assert tuple(row) == ("ingest_trips", "2024-01", 4, "run-1", "Succeeded")


# --- writers ------------------------------------------------------------------


def test_dynamic_overwrite_touches_only_its_partitions(spark, lake_root):
    df = spark.range(100).selectExpr("id", "cast(id % 2 as string) p")
    K.write_partitions(df, lake_root, ["p"], ["id"], "all")
    K.write_partitions(spark.range(3).selectExpr("id + 1000 id", "'1' p"), lake_root, ["p"], ["id"])
    counts = {r[0]: r[1] for r in spark.read.parquet(lake_root).groupBy("p").count().collect()}
    assert counts == {"0": 50, "1": 3}
    with pytest.raises(ValueError):
        K.write_partitions(df, lake_root, ["p"], replace="some")


def test_catalog_table_is_replaced(spark):
    K.save_as_table(spark.range(3), "tripmill_numbers")
    K.save_as_table(spark.range(2), "tripmill_numbers")
    assert spark.table("tripmill_numbers").count() == 2
    spark.sql("drop table tripmill_numbers")


def test_range_layout_splits_a_hot_value(spark):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 7, id) k", "id")
    parts = Y.clustered(df, ["k"], files=6).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 6 and max(r["count"] for r in parts) < 2500  # the hot value alone has 3,334 rows


def test_z_order_key(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "a int, b int")
    keys = [r[0] for r in df.select(Y.interleaved([F.col("a"), F.col("b")], 2)).collect()]
    assert keys == [0b0101, 0b1010, 0b0110]
    with pytest.raises(ValueError):
        Y.interleaved([F.col("a")] * 4, 16)


def test_z_order_layout_narrows_both_columns(spark, lake_root):
    grid = spark.range(64 * 64).selectExpr("cast(id % 64 as int) a", "cast(id / 64 as int) b")
    K.write_table(Y.zordered(grid, {"a": F.col("a"), "b": F.col("b")}, bits=6, files=16), lake_root)
    spans = (
        spark.read.parquet(lake_root)
        .groupBy(F.input_file_name())
        .agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
        .collect()
    )
    assert len(spans) > 8
    assert sum(r.a for r in spans) / len(spans) < 40 and sum(r.b for r in spans) / len(spans) < 40
    assert spark.read.parquet(lake_root).count() == 64 * 64


# --- schema drift -------------------------------------------------------------


def test_align_schema(spark, bronze):
    drifted = bronze({}, {"passenger_count": 2}).drop("tolls_amount").withColumns(
        {"passenger_count": F.concat(F.col("passenger_count").cast("string"), F.lit("")), "surge": F.lit(1)}
    )
    kept = align_schema(drifted, BRONZE_TRIPS)
    assert kept.columns == [*BRONZE_TRIPS.names, "surge"]
    assert [f.dataType for f in kept.schema][:16] == [f.dataType for f in BRONZE_TRIPS]
    assert kept.collect()[0].tolls_amount is None
    assert align_schema(drifted, BRONZE_TRIPS, "drop").columns == BRONZE_TRIPS.names
    with pytest.raises(ValueError, match="surge"):
        align_schema(drifted, BRONZE_TRIPS, "error")
    dirty = drifted.withColumn("passenger_count", F.lit("two"))
    assert align_schema(dirty, BRONZE_TRIPS).collect()[0].passenger_count is None


def test_drifted_files_are_read_together(spark, lake, bronze):
    bronze({}).write.parquet(f"{lake.bronze}/yellow_tripdata_2024-01.parquet")
    bronze({}).withColumn("surge", F.lit(2.5)).write.parquet(f"{lake.bronze}/yellow_tripdata_2024-02.parquet")
    rows = read_bronze(spark, lake.bronze, "all", TS, schema=None).orderBy("source_month").collect()
    assert [(r.source_month, r.surge) for r in rows] == [("2024-01", None), ("2024-02", 2.5)]


def test_missing_columns_are_named(bronze):
    with pytest.raises(ValueError, match="fare_amount"):
        require_columns(bronze({}).drop("fare_amount"), BRONZE_TRIPS)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert os.path.isdir(shared_folder(spark))


def test_lake_without_any_accepted_trip_still_builds(spark, lake, bronze):
    L.land_month(bronze(at(1, 5, fare=-1.0)), lake.bronze, "2024", "01")
    log = P.run_silver(spark, lake, mode="full", run_ts=TS)
    assert (log["raw_rows"], log["silver_rows"], log["quarantine_rows"], log["dupes_removed"]) == (1, 0, 1, 0)
    tables = P.build_gold(spark, lake, TS, "2024-06-15")
    assert tables["fact_trips"].count() == 0
    assert tables["dim_date"].count() == 366


def test_columns_nobody_declared_reach_silver_and_quarantine(spark, lake, bronze):
    trips = january(bronze).withColumn("congestion_surcharge", F.lit(2.5))
    L.land_month(trips, lake.bronze, "2024", "01")
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    for month in ("2024-01", "2024-02"):
        P.run_silver(spark, lake, month, "incremental", TS)
    for path in (lake.silver, lake.quarantine):
        rows = P.read(spark, lake, path).groupBy("source_month").agg(F.max("congestion_surcharge").alias("x")).collect()
        assert {(r.source_month, r.x) for r in rows} <= {("2024-01", 2.5), ("2024-02", None)}
        assert ("2024-01", 2.5) in {(r.source_month, r.x) for r in rows}


def test_a_month_landed_both_ways_is_read_once(spark, lake, bronze):
    L.land_months(january(bronze).withColumn("source_month", F.lit("2024-01")), lake.bronze)
    assert L.land_month(january(bronze), lake.bronze, "2024", "01") == 4
    assert read_bronze(spark, lake.bronze, "all", TS).count() == 4


def test_types_that_drift_between_months_run_together(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    L.land_month(february(bronze).withColumn("passenger_count", F.col("passenger_count").cast("double")), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    assert silver(spark, lake) == EXPECTED


@pytest.mark.parametrize("fail_at", range(1, 6))
def test_a_run_that_fails_after_any_write_is_repaired_by_the_next(spark, lake, bronze, monkeypatch, fail_at):
    L.land_month(bronze(at(1, 5), at(3, 1)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    L.land_month(bronze(at(1, 5)), lake.bronze, "2024", "01")
    done = []

    def counted(write):
        def run(*args, **kwargs):
            if len(done) == fail_at:
                raise RuntimeError("lost")
            done.append(1)
            return write(*args, **kwargs)

        return run

    with monkeypatch.context() as patch:
        for name in ("write_leaf", "write_partitions", "clear_leaf", "append_record"):
            patch.setattr(P.K, name, counted(getattr(P.K, name)))
        try:
            P.run_silver(spark, lake, "2024-01", "incremental", TS)
        except RuntimeError:
            pass
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert silver(spark, lake) == [("2024-01", "2024-01", 5, 3.0)]


def test_the_survivor_of_a_tie_is_the_same_after_another_landing(spark, lake, bronze):
    trips = bronze(*[{**at(1, 5), "tip_amount": float(k), "extra": float(k % 3)} for k in range(40)])
    found = set()
    for ts in ("2024-06-15T06:00:00", "2024-07-01T06:00:00"):
        L.land_month(trips.repartition(3), lake.bronze, "2024", "01")
        P.run_silver(spark, lake, mode="full", run_ts=ts)
        found |= {r.tip_amount for r in P.read(spark, lake, lake.silver).collect()}
    assert len(found) == 1


def test_gold_refuses_a_year_without_holidays(spark, lake):
    with pytest.raises(ValueError, match="2025"):
        P.build_gold(spark, lake, TS, "2025-01-01", 2025, US_HOLIDAYS)
