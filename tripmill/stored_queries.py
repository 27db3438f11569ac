"""Registered queries over stored tables: incremental Gold, drifted files, catalog, buckets, layouts, streams."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import metrics as M
from tripmill.functions import sketches as H
from tripmill.functions.holidays import is_holiday
from tripmill.functions.states import state_measures
from tripmill.operators import rules as R
from tripmill.operators.checks import QualityGateError
from tripmill.operators.dedup import keep_first
from tripmill.operators.schema import RESCUE, rescued_counts
from tripmill.plans import gold as G
from tripmill.plans import increment
from tripmill.plans import insights as I
from tripmill.plans import pipeline as P
from tripmill.plans import silver as V
from tripmill.queries import (
    AS_OF,
    RUN_TS,
    _accepted,
    _bronze,
    _by_borough,
    _dates,
    _fact,
    _landed_lake,
    _silver,
    _staging,
    _zones,
    query,
)
from tripmill.session import fresh_folder
from tripmill.sinks import catalog
from tripmill.sinks import landing as L
from tripmill.sinks import layout as Y
from tripmill.sinks import tables as K
from tripmill.sources import star
from tripmill.sources.bronze import ALL_MONTHS, found_paths, month_paths, read_bronze, trip_file
from tripmill.sources.inventory import report, schema_groups
from tripmill.sources.schemas import BRONZE_TRIPS
from tripmill.sources.spine import date_spine_of
from tripmill.streaming import silver as stream_silver
from tripmill.streaming import trips as stream

# --- states and incremental Gold ----------------------------------------------


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.trip_states(_fact(spark, sf_dir))


@query
def hourly_from_states(spark, sf_dir):
    """The hourly table from mergeable states."""
    return G.agg_hourly_zone(_states(spark, sf_dir), of=state_measures)


@query
def daily_from_states(spark, sf_dir):
    return G.agg_daily_borough(_states(spark, sf_dir), of=state_measures)


@query
def payments_from_states(spark, sf_dir):
    return G.agg_payment_trends(_states(spark, sf_dir), of=state_measures)


@query
def airport_from_states(spark, sf_dir):
    return I.airport_revenue_per_mile(_states(spark, sf_dir), state_measures)


@query
def weekend_hours_from_states(spark, sf_dir):
    return I.weekend_hour_durations(_states(spark, sf_dir), state_measures)


CHANGED = "2024-03"


def _changed_lake(spark: SparkSession, sf_dir: str) -> tuple[P.Lake, dict[str, set[str]]]:
    """A lake whose March was incomplete in a full build, then corrected and run incrementally.

    Also the files of each Gold table before the second build. Each query builds its own,
    so what it costs does not depend on which ran before.
    """
    lake = P.Lake(fresh_folder(spark, "lake"))
    trips = star.bridge_trips(spark, sf_dir)
    L.land_months(trips, lake.bronze)  # the joins run once; March is cut from what they landed
    march = L.take_month(spark, lake.bronze, CHANGED, trips.drop("source_month").schema)
    L.land_month(march.where(F.col("VendorID") == 1), lake.bronze, *CHANGED.split("-"))
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    P.update_gold(spark, lake, RUN_TS, AS_OF)
    before = {name: set(_files(spark, lake, name)) for name in STORED}
    L.land_month(march, lake.bronze, *CHANGED.split("-"))
    P.run_silver(spark, lake, CHANGED, "incremental", RUN_TS)
    P.update_gold(spark, lake, RUN_TS, AS_OF)
    return lake, before


STORED = ["fact_trips", "trip_states", "agg_hourly_zone", "agg_daily_borough"]


def _files(spark: SparkSession, lake: P.Lake, name: str) -> list[str]:
    return P.read(spark, lake, lake.gold(name)).inputFiles()


@query
def gold_incremental(spark, sf_dir):
    """The daily table after a full build, a corrected month and an incremental one."""
    lake, _ = _changed_lake(spark, sf_dir)
    return P.gold_table(spark, lake, "agg_daily_borough").drop("aggregated_at")


@query
def gold_incremental_hourly(spark, sf_dir):
    lake, _ = _changed_lake(spark, sf_dir)
    return P.gold_table(spark, lake, "agg_hourly_zone").drop("aggregated_at")


@query
def gold_incremental_parts(spark, sf_dir):
    """Which partitions of the Gold tables an incremental build wrote anew."""
    lake, before = _changed_lake(spark, sf_dir)
    rows = []
    for name in STORED:
        now = increment.fingerprints(_files(spark, lake, name))
        old = increment.fingerprints(before[name])
        # months of the calendar, one row each
        rows += [(name, part, now.get(part) != old.get(part)) for part in now]
    return spark.createDataFrame(rows, "table_name string, pickup_year_month string, rewritten boolean")


# --- drifted files ------------------------------------------------------------

DRIFTED = "2024-05"


def _drifted_lake(spark: SparkSession, sf_dir: str) -> P.Lake:
    """May comes in files that differ: one as declared, one with passengers as text and a
    column of its own, one with distances as text, some of which are no numbers."""
    lake = P.Lake(fresh_folder(spark, "lake"))
    trips = star.bridge_trips(spark, sf_dir)
    L.land_months(trips, lake.bronze)  # the joins run once; May is cut from what they landed
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    may = L.take_month(spark, lake.bronze, DRIFTED, trips.drop("source_month").schema)
    kind = F.col("RatecodeID") % 3
    first = may.where(kind == 0)
    second = may.where(kind == 1).withColumns(
        {"passenger_count": F.col("passenger_count").cast("string"), "surge": F.col("VendorID") * 10}
    )
    far = F.when(F.col("payment_type") == 1, F.lit("n/a")).otherwise(F.col("trip_distance").cast("string"))
    third = may.where(kind == 2).withColumns({"trip_distance": far, "surge": F.col("VendorID") * 0.5})
    for number, part in enumerate((first, second, third)):
        part.write.parquet(f"{lake.bronze}/trip_file={trip_file(DRIFTED)}/delivery={number}")
    return lake


@query
def drifted_columns(spark, sf_dir):
    """What columns and types the files of the drifted month have."""
    lake = _drifted_lake(spark, sf_dir)
    groups = schema_groups(spark, found_paths(spark, month_paths(lake.bronze, DRIFTED)))
    found = report(spark, groups, BRONZE_TRIPS)
    return found.where(F.col("column_name").isin("passenger_count", "trip_distance", "surge")).drop("path_count")


@query
def drifted_month(spark, sf_dir):
    """Every trip of files that differ within a month, with the column that only some have."""
    lake = _drifted_lake(spark, sf_dir)
    bronze = read_bronze(spark, lake.bronze, ALL_MONTHS, RUN_TS)
    return bronze.groupBy("source_month").agg(
        M.rows().alias("row_count"),
        M.whole_total("passenger_count").alias("passengers"),
        M.total("trip_distance").alias("distance"),
        M.total("surge").alias("surge"),
        F.count(RESCUE).alias("rescued_rows"),
    )


@query
def drifted_values(spark, sf_dir):
    """Values that did not fit: how many of each column, in quarantine under a reason of their own."""
    lake = _drifted_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    bad = P.read(spark, lake, lake.quarantine)
    return rescued_counts(bad, ["source_month", R.REASON])


# --- exact stream into Silver -------------------------------------------------

BATCHES = 2


@query
def stream_into_silver(spark, sf_dir):
    """Trips streamed in several batches, each over all months, into Silver."""
    lines = fresh_folder(spark, "lines")
    table = star.table(spark, sf_dir, "lineitem")
    # each task deals the rows that it reads to two files: no shuffle, and files that do not grow with the table
    table.withColumn("part", F.monotonically_increasing_id() % 2).write.partitionBy("part").parquet(lines)
    batch = max(1, math.ceil(len(spark.read.schema(table.schema).parquet(lines).inputFiles()) / BATCHES))
    lineitem = stream.stream_files(spark, f"{lines}/part=*", table.schema, files_per_batch=batch)
    trips = star.bridge_trips(spark, sf_dir, lineitem=lineitem)
    lake = P.Lake(fresh_folder(spark, "lake"))
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    silver = stream_silver.run_into_silver(trips, lake, "lines", fresh_folder(spark, "checkpoint"), RUN_TS)
    return silver.groupBy("source_month", "pickup_year_month").agg(
        M.rows().alias("row_count"), M.total("total_cost").alias("revenue")
    )


# --- sketches -----------------------------------------------------------------


@query
def users_by_month(spark, sf_dir):
    """Distinct users a month from merged daily sketches, against the exact count."""
    events = star.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    daily = events.groupBy("event_type", "day").agg(H.distinct_state("user_id").alias("users"))
    month = F.trunc("day", "month").alias("month_start")
    merged = daily.groupBy("event_type", month).agg(H.estimate(H.merged_state("users")).alias("estimated"))
    exact = events.groupBy("event_type", month).agg(M.distinct_count("user_id").alias("users"))
    both = exact.join(merged, ["event_type", "month_start"])
    return both.withColumn("within_bound", H.within_bound(F.col("estimated"), F.col("users"))).drop("estimated")


# --- layout, buckets, pruning, catalog ----------------------------------------


@query
def zorder_skipping(spark, sf_dir):
    """Files of a z-order layout that two filters meet; each column skips at least half, both skip more."""
    path = fresh_folder(spark, "zorder")
    silver = _silver(spark, sf_dir)
    K.write_table(Y.zordered_by_quantiles(silver, P.LAYOUT, files=16), path)
    table = spark.read.parquet(path)
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-02-01", "2024-03-01"))
    time, borough = F.col("pickup_datetime"), F.col("pickup_borough")
    rows = table.where((time >= low) & (time < high) & (borough == "Queens"))
    files = Y.file_ranges(table, P.LAYOUT)
    by_time = (F.col("pickup_datetime_high") >= low) & (F.col("pickup_datetime_low") < high)
    by_borough = (F.col("pickup_borough_high") >= "Queens") & (F.col("pickup_borough_low") <= "Queens")
    met = files.agg(
        F.count("*").alias("n"),
        F.count_if(by_time).alias("t"),
        F.count_if(by_borough).alias("b"),
        F.count_if(by_time & by_borough).alias("both"),
    )
    n, t, b, both = met.first()  # four counts
    return rows.agg(M.rows().alias("row_count"), M.total("total_cost").alias("revenue")).withColumns(
        {
            "time_skips": F.lit(2 * t <= n),
            "borough_skips": F.lit(2 * b <= n),
            "both_skip_more": F.lit(both < t and both < b),
        }
    )


@query
def zorder_silver(spark, sf_dir):
    """A lake whose Silver is laid out in z-order by quantiles."""
    lake = P.Lake(fresh_folder(spark, "lake"), zorder=True)
    L.land_months(star.bridge_trips(spark, sf_dir), lake.bronze)
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    return _by_borough(P.read(spark, lake, lake.silver))


def _unused(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def bucketed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _accepted(spark, sf_dir)
    return catalog.bucketed(accepted, _unused("trips"), V.TRIP_KEYS, 8, fresh_folder(spark, "bucketed"))


@query
def bucketed_dedup(spark, sf_dir):
    """Keep-first over a table bucketed by the trip's keys: no exchange."""
    return V.dedup_trips(bucketed_trips(spark, sf_dir)).drop("source_file")


@query
def bucketed_copies(spark, sf_dir):
    """Trip keys that occur more than once, counted without an exchange."""
    found = catalog.copies(bucketed_trips(spark, sf_dir), V.TRIP_KEYS)
    return found.agg(M.rows().alias("repeated_keys"), F.sum("row_count").alias("rows"))


@query
def bucketed_lines(spark, sf_dir):
    """Keep-first of order lines from a bucketed table."""
    lines = star.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    table = catalog.bucketed(lines, _unused("lines"), keys, 8, fresh_folder(spark, "bucketed"))
    ties = [c for c in lines.columns if c not in (*keys, "l_shipdate")]
    kept = keep_first(table, keys, ["l_shipdate"], ties)
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        M.rows().alias("row_count"), M.total("l_extendedprice").alias("revenue")
    )


def written_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "fact")
    K.write_partitions(_fact(spark, sf_dir), path, [increment.PART], replace="all")
    return spark.read.parquet(path)


def quarter_star(spark: SparkSession, sf_dir: str, fact: DataFrame) -> DataFrame:
    days = (F.col("quarter_label") == "Q3") & (F.col("year") == 2024)
    return G.pruned_star(fact, _dates(spark, sf_dir), _zones(spark, sf_dir), days)


@query
def star_join_quarter(spark, sf_dir):
    """The star of one quarter; the calendar prunes the fact's partitions at run time."""
    star_ = quarter_star(spark, sf_dir, written_fact(spark, sf_dir))
    return star_.groupBy("month_name", "is_us_holiday", "pickup_borough_type", "dropoff_is_airport_zone").agg(
        M.rows().alias("trips"), M.total("total_cost").alias("revenue")
    )


@query
def catalog_gold(spark, sf_dir):
    """The whole job by table names: a full run, a month again, and the daily table by name."""
    database = _unused("lake")
    lake = P.Lake(fresh_folder(spark, "lake"), database=database)
    spark.sql(f"create database {database} location '{lake.root}/database'")
    L.land_months(star.bridge_trips(spark, sf_dir), lake.bronze)
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    P.update_gold(spark, lake, RUN_TS, AS_OF)
    P.run_silver(spark, lake, CHANGED, "incremental", RUN_TS)
    P.update_gold(spark, lake, RUN_TS, AS_OF)
    P.gold_table(spark, lake, "agg_daily_borough")
    return spark.table(lake.named("gold/agg_daily_borough")).drop("aggregated_at", increment.PART)


# --- calendar, view, gate, unknown numbers ------------------------------------


@query
def holiday_rules(spark, sf_dir):
    """Holidays by rule over all the years that orders span."""
    spine = date_spine_of(star.table(spark, sf_dir, "orders"), star.moved("o_orderdate").cast("date"))
    return G.dim_date(spine, AS_OF).where("is_us_holiday").select("calendar_date", "day_name", is_holiday("calendar_date", observed=False).alias("on_its_day"))


@query
def staging_view(spark, sf_dir):
    """Staging as a view, read by name in SQL."""
    K.publish_view(_staging(spark, sf_dir), "stg_trips_by_name")
    return spark.sql(
        "select pickup_year_month, count(*) as trips, count(distinct trip_id) as trip_ids from stg_trips_by_name group by 1"
    )


@query
def gate_outcome(spark, sf_dir):
    """What the quality gate says of the written tables: unmatched zones stop the run."""
    lake = _landed_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    P.update_gold(spark, lake, RUN_TS, AS_OF)
    try:
        report_, stopped = P.check_run(spark, lake, gate=True), False
    except QualityGateError as e:  # the report that the run was stopped over: the checks run once
        report_, stopped = e.report, True
    return report_.agg(F.count_if(F.col("failures") > 0).alias("failed_checks"), F.lit(stopped).alias("stopped"))


@query
def unknown_numbers(spark, sf_dir):
    """Sums and means over values of which some are NaN or infinite: these are unknown."""
    trips = _bronze(spark, sf_dir)
    odd = (
        F.when(F.col("payment_type") == 1, F.lit(float("nan")))
        .when(F.col("payment_type") == 2, F.lit(float("inf")))
        .otherwise(F.col("fare_amount"))
    )
    return trips.withColumn("odd", odd).groupBy("source_month").agg(
        M.total("odd").alias("fares"), M.mean("odd", 2).alias("mean_fare"), M.known_count("odd").alias("known")
    )
