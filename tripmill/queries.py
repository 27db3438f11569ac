"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import metrics as M
from tripmill.functions import scalars as S
from tripmill.operators import checks as C
from tripmill.operators import rules as R
from tripmill.operators import trends as T
from tripmill.operators.dedup import keep_first
from tripmill.operators.enrich import enrich
from tripmill.operators.schema import align_schema
from tripmill.plans import gold as G
from tripmill.plans import insights as I
from tripmill.plans import pipeline as P
from tripmill.plans import quality as Q
from tripmill.plans import silver as V
from tripmill.session import fresh_folder, pin_session
from tripmill.sinks import landing as L
from tripmill.sinks import layout as Y
from tripmill.sinks import tables as K
from tripmill.sources import star
from tripmill.sources.bronze import ALL_MONTHS, TRIP_FILE, read_bronze
from tripmill.sources.schemas import BRONZE_TRIPS
from tripmill.sources.spine import date_spine_of
from tripmill.streaming import trips as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = "2024-06-15"
RUN_TS = "2024-06-15T06:00:00"


def query(run: Query) -> Query:
    """Registers a query under its own name."""

    @wraps(run)
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_session(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = pinned
    return run


# --- inputs -------------------------------------------------------------------
# Shared views, built once per session and folder; they are plans, not data.

view = lru_cache(maxsize=64)


def _with_file(trips: DataFrame) -> DataFrame:
    head, tail = TRIP_FILE.split("{month}")
    return trips.withColumn("source_file", F.concat(F.lit(head), F.col("source_month"), F.lit(tail)))


@view
def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All submitted trips, the ones to be rejected included."""
    return _with_file(star.bridge_trips(spark, sf_dir))


@view
def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.tag_trips(_bronze(spark, sf_dir))


@view
def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that pass the rules; the year rule also narrows the scan."""
    return R.accepted(V.tag_trips(_with_file(star.bridge_trips(spark, sf_dir))))


@view
def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.dedup_trips(_accepted(spark, sf_dir))


@view
def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.enrich_trips(V.derive_trips(_kept(spark, sf_dir)), star.bridge_zones(spark, sf_dir))


@view
def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.staging_trips(_silver(spark, sf_dir))


@view
def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.fact_trips(_staging(spark, sf_dir))


@view
def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the days the orders span, moved like the trips."""
    spine = date_spine_of(star.table(spark, sf_dir, "orders"), star.moved("o_orderdate").cast("date"))
    return G.dim_date(spine, AS_OF, G.US_HOLIDAYS)


@view
def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.dim_zone(star.bridge_zones(spark, sf_dir))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for results that are read more than once."""
    path = fresh_folder(df.sparkSession, name)
    K.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- rejects, dedup, derive, enrich -------------------------------------------


@query
def reject_profile(spark, sf_dir):
    return R.reject_profile(_tagged(spark, sf_dir))


@query
def funnel_counts(spark, sf_dir):
    return R.funnel(_tagged(spark, sf_dir), V.TRIP_KEYS, V.date_reasons())


@query
def quarantine_rows(spark, sf_dir):
    return R.rejected(_tagged(spark, sf_dir))


@query
def quarantine_union(spark, sf_dir):
    """The two rule stages one after the other, united by name; the first stage lacks a column."""
    typed = V.parse_times(_bronze(spark, sf_dir))
    by_date = R.tag_rejects(typed, V.date_rules())
    by_rule = R.tag_rejects(R.accepted(by_date), V.business_rules()).withColumn("stage", F.lit("business"))
    both = R.union_rejects(R.rejected(by_date), R.rejected(by_rule))
    return both.groupBy("stage", R.REASON).agg(M.rows().alias("row_count"), M.total("fare_amount").alias("fares"))


@query
def strict_null_rules(spark, sf_dir):
    """Reject profile with explicit rules for missing values put first."""
    typed = V.parse_times(_bronze(spark, sf_dir))
    rules = R.unknown_rules(["PULocationID", "passenger_count"]) + V.date_rules() + V.business_rules()
    return R.reject_profile(R.tag_rejects(typed, rules))


@query
def dedup_keep_first(spark, sf_dir):
    return _kept(spark, sf_dir).drop("source_file")


@query
def derived_trip_columns(spark, sf_dir):
    derived = V.derive_trips(_kept(spark, sf_dir))
    return derived.select(
        *V.TRIP_KEYS,
        "source_month",
        "trip_duration_min",
        "avg_speed_mph",
        "pickup_hour",
        "pickup_day_of_week",
        "pickup_month",
        "pickup_year_month",
        "pickup_date",
        "is_weekend",
        "total_cost",
        "tip_pct",
        "payment_type_label",
        "is_speed_outlier",
    )


@query
def zone_enrichment(spark, sf_dir):
    ends = [f"{role}_{name}" for role in ("pickup", "dropoff") for name in V.ZONE_COLUMNS.values()]
    return _silver(spark, sf_dir).select(*V.TRIP_KEYS, *ends)


@query
def staging_conform(spark, sf_dir):
    return _staging(spark, sf_dir)


# --- gold ---------------------------------------------------------------------


@query
def fact_trips(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def dim_date(spark, sf_dir):
    return _dates(spark, sf_dir).orderBy("calendar_date")


@query
def dim_zone(spark, sf_dir):
    return _zones(spark, sf_dir).orderBy("location_id")


@query
def agg_hourly_zone(spark, sf_dir):
    return G.agg_hourly_zone(_fact(spark, sf_dir))


@query
def agg_daily_borough_base(spark, sf_dir):
    return G.daily_borough_base(_fact(spark, sf_dir))


@query
def agg_daily_borough(spark, sf_dir):
    return G.agg_daily_borough(_fact(spark, sf_dir))


def _daily(spark, sf_dir):
    return G.daily_borough_base(_fact(spark, sf_dir)).select(
        "pickup_date", "pickup_borough", "total_trips", "total_revenue"
    )


@query
def wow_rows(spark, sf_dir):
    return G.week_over_week(_daily(spark, sf_dir), "rows")


@query
def wow_calendar(spark, sf_dir):
    return G.week_over_week(_daily(spark, sf_dir), "calendar")


@query
def mtd_running(spark, sf_dir):
    return G.month_to_date(_daily(spark, sf_dir))


@query
def borough_rank(spark, sf_dir):
    return G.borough_ranks(_daily(spark, sf_dir))


@query
def mom_borough(spark, sf_dir):
    return I.borough_months(_fact(spark, sf_dir))


@query
def agg_payment_trends(spark, sf_dir):
    return G.agg_payment_trends(_fact(spark, sf_dir)).orderBy(
        "pickup_month", "pickup_borough", "is_weekend", F.desc("trip_count")
    )


@query
def tip_bands(spark, sf_dir):
    return (
        _fact(spark, sf_dir)
        .groupBy("payment_type_label")
        .agg(M.rows().alias("trip_count"), *M.band_counts("tip_pct", G.TIP_EDGES, G.TIP_BANDS))
    )


@query
def payment_share(spark, sf_dir):
    counts = _fact(spark, sf_dir).groupBy("pickup_month", "payment_type_label").agg(M.rows().alias("trip_count"))
    return T.share_of(counts, ["pickup_month"], "trip_count", "share_pct")


@query
def revenue_metrics(spark, sf_dir):
    return _fact(spark, sf_dir).alias("t").groupBy("pickup_borough").agg(*M.revenue_metrics("t."))


@query
def volume_metrics(spark, sf_dir):
    return _fact(spark, sf_dir).alias("t").groupBy("pickup_borough").agg(*M.trip_volume_metrics("t."))


@query
def star_join_holiday(spark, sf_dir):
    joined = G.trip_star(_fact(spark, sf_dir), _dates(spark, sf_dir), _zones(spark, sf_dir))
    grain = [
        "quarter_label",
        "is_us_holiday",
        "pickup_borough_type",
        "pickup_is_major_hub",
        "dropoff_borough_type",
        "dropoff_is_airport_zone",
    ]
    return joined.groupBy(*grain).agg(M.rows().alias("trips"), M.total("total_cost").alias("revenue"))


# --- quality ------------------------------------------------------------------


def _declared(spark, sf_dir, kind):
    """The declared checks of one kind, over the tables they need."""
    checks = [c for c in Q.silver_checks() + Q.gold_checks() if c.kind == kind]
    needed = {c.table for c in checks} | {c.parent for c in checks}
    silver = _silver(spark, sf_dir)
    if "silver_trips" in needed:
        silver = _written(silver, "silver")
    fact = G.fact_trips(G.staging_trips(silver))
    if kind in ("not_null", "accepted_values"):  # several tables below read it
        fact = _written(fact, "fact")
    build = {
        "silver_trips": lambda: silver,
        "dim_date": lambda: _dates(spark, sf_dir),
        "dim_zone": lambda: _zones(spark, sf_dir),
        "fact_trips": lambda: fact,
        "agg_hourly_zone": lambda: G.agg_hourly_zone(fact),
        "agg_daily_borough": lambda: G.agg_daily_borough(fact),
        "agg_payment_trends": lambda: G.agg_payment_trends(fact),
    }
    return C.run_checks({name: build[name]() for name in needed if name}, checks)


@query
def dq_not_null(spark, sf_dir):
    return _declared(spark, sf_dir, "not_null")


@query
def dq_unique(spark, sf_dir):
    return _declared(spark, sf_dir, "unique")


@query
def dq_accepted_values(spark, sf_dir):
    return _declared(spark, sf_dir, "accepted_values")


@query
def dq_relationships(spark, sf_dir):
    return _declared(spark, sf_dir, "relationships")


@query
def dq_raw_trips(spark, sf_dir):
    """Checks of every kind over the unfiltered trips, where many of them fail."""
    tables = {"trips": V.parse_times(_bronze(spark, sf_dir)), "dim_zone": _zones(spark, sf_dir)}
    return C.run_checks(
        tables,
        [
            *C.not_null("trips", "PULocationID", "passenger_count", "fare_amount"),
            *C.unique("trips", "pickup_datetime"),
            *C.accepted_values("trips", "payment_type", list(V.PAYMENT_NAMES)),
            *C.relationship("trips", "PULocationID", "dim_zone", "location_id"),
            *C.assertion("trips", "no_negative_fares", Q.negative_fare()),
        ],
    )


@query
def assert_no_negative_fares(spark, sf_dir):
    return Q.negative_fares(_fact(spark, sf_dir))


@query
def assert_pickup_before_dropoff(spark, sf_dir):
    return Q.pickups_not_before_dropoffs(_fact(spark, sf_dir))


@query
def raw_negative_fares(spark, sf_dir):
    """The fare assertion over the unfiltered trips."""
    trips = V.parse_times(_bronze(spark, sf_dir))
    columns = ["pickup_datetime", "fare_amount", "PULocationID"]
    return C.failing_rows(trips, Q.negative_fare(), columns, Q.NEGATIVE_FARE)


@query
def raw_wrong_order(spark, sf_dir):
    """The order assertion over the unfiltered trips."""
    trips = V.derive_trips(V.parse_times(_bronze(spark, sf_dir)))
    columns = ["pickup_datetime", "dropoff_datetime", "trip_duration_min"]
    return C.failing_rows(trips, Q.wrong_order(), columns, Q.WRONG_ORDER)


@query
def fk_orphans(spark, sf_dir):
    ends = _fact(spark, sf_dir).select("pickup_location_id", "dropoff_location_id")
    fact, zones = _written(ends, "trip_ends"), _zones(spark, sf_dir)
    sides = [
        C.orphans(fact, f"{end}_location_id", zones, "location_id").select(
            F.lit(end).alias("trip_end"), F.col(f"{end}_location_id").alias("location_id"), "row_count"
        )
        for end in ("pickup", "dropoff")
    ]
    return sides[0].unionByName(sides[1])


# --- consumer questions -------------------------------------------------------


@query
def b1_evening_weekday_zones(spark, sf_dir):
    return I.evening_weekday_zones(G.agg_hourly_zone(_fact(spark, sf_dir)))


@query
def b2_cash_by_month(spark, sf_dir):
    return I.cash_by_month(G.payment_base(_fact(spark, sf_dir)))


@query
def b3_third_quarter_growth(spark, sf_dir):
    return I.third_quarter_growth(G.agg_daily_borough(_fact(spark, sf_dir)))


@query
def b4_airport_revenue_per_mile(spark, sf_dir):
    return I.airport_revenue_per_mile(_fact(spark, sf_dir))


@query
def b5_weekend_hour_durations(spark, sf_dir):
    return I.weekend_hour_durations(_fact(spark, sf_dir))


@query
def b6_friday_evening_zones(spark, sf_dir):
    return I.friday_evening_zones(G.agg_hourly_zone(_fact(spark, sf_dir)))


@query
def b7_growth_since(spark, sf_dir):
    return I.growth_since(G.agg_daily_borough(_fact(spark, sf_dir)), "2024-06-01")


@query
def b8_payment_share_by_month(spark, sf_dir):
    return I.payment_share_by_month(G.agg_payment_trends(_fact(spark, sf_dir)))


# --- the same operators on the star tables ------------------------------------


@query
def orders_daily_region_trends(spark, sf_dir):
    """Both lag modes, running totals and ranks over days with gaps."""
    orders = (
        star.table(spark, sf_dir, "orders")
        .join(star.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(star.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("order_date"), F.col("r_name").alias("region")).agg(
        M.rows().alias("orders"), M.total("o_totalprice").alias("revenue")
    )
    by_row = T.period_over_period(
        daily, ["region"], "order_date", {"orders": "orders_row_pct", "revenue": "revenue_row_pct"}, steps=7
    )
    by_day = T.period_over_period(
        by_row,
        ["region"],
        T.day_number("order_date"),
        {"orders": "orders_wow_pct", "revenue": "revenue_wow_pct"},
        steps=7,
        mode="calendar",
        keep_prior={"orders": "orders_week_before"},
    )
    running = T.running_total(
        by_day.withColumn("month_start", F.trunc("order_date", "month")),
        ["region", "month_start"],
        "order_date",
        counts={"orders": "mtd_orders"},
        amounts={"revenue": "mtd_revenue"},
    )
    return T.rank_within(running, ["order_date"], {"orders": "rank_by_orders", "revenue": "rank_by_revenue"})


@query
def lineitem_dedup(spark, sf_dir):
    """Keep-first with an explicit tie-break: lines repeat, also on the ship date."""
    ties = [
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ]
    lines = star.table(spark, sf_dir, "lineitem")
    return keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ties)


@query
def shipdate_causality(spark, sf_dir):
    """Lines shipped on or before the order day, as a rejection rule."""
    joined = star.table(spark, sf_dir, "lineitem").join(
        star.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    rules = [
        R.Rule("shipped before order", F.col("l_shipdate") < F.col("o_orderdate")),
        R.Rule("shipped on order day", F.col("l_shipdate") == F.col("o_orderdate")),
    ]
    return (
        R.rejected(R.tag_rejects(joined, rules))
        .groupBy(R.REASON, "l_returnflag")
        .agg(M.rows().alias("row_count"), M.total("l_extendedprice").alias("revenue"))
    )


@query
def events_hourly_type(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    grain = [F.col("ts").cast("date").alias("event_date"), F.hour("ts").alias("event_hour"), F.col("event_type")]
    return events.groupBy(*grain).agg(
        M.rows().alias("event_count"),
        M.distinct_count("user_id").alias("users"),
        M.total("value").alias("total_value"),
        M.mean("value", 2).alias("avg_value"),
    )


@query
def events_type_share(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    daily = events.groupBy(F.col("ts").cast("date").alias("event_date"), "event_type").agg(
        M.rows().alias("event_count")
    )
    return T.share_of(daily, ["event_date"], "event_count", "share_pct")


@query
def segment_share(spark, sf_dir):
    """Order share of each market segment within its nation, nations as a lookup."""
    customers = star.table(spark, sf_dir, "customer")
    orders = star.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    counts = orders.groupBy("c_nationkey", "c_mktsegment").agg(
        M.rows().alias("order_count"), M.total("o_totalprice").alias("revenue")
    )
    named = enrich(
        counts, star.table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey", {"n_name": "nation"}
    ).drop("c_nationkey")
    return T.share_of(named, ["nation"], "order_count", "order_share_pct")


@query
def order_price_bands(spark, sf_dir):
    """Band counts, guarded ratios and labels on orders."""
    orders = star.table(spark, sf_dir, "orders")
    status = S.label("o_orderstatus", {"F": "filled", "O": "open"}, "other")
    return orders.groupBy(status.alias("status")).agg(
        *M.band_counts("o_totalprice", [0, 100000, 250000], ["free", "small", "medium", "large"]),
        M.mean("o_totalprice", 2).alias("avg_price"),
        M.distinct_count("o_custkey").alias("customers"),
    )


@query
def schema_drift(spark, sf_dir):
    """Trips with a lost column, a text column and a new one, fitted to the declared schema."""
    drifted = (
        _bronze(spark, sf_dir)
        .drop("tolls_amount", "source_file", "source_month")
        .withColumns({"passenger_count": F.col("passenger_count").cast("string"), "surge": F.col("extra") * 2})
    )
    return align_schema(drifted, BRONZE_TRIPS, extra="keep")


# --- written tables -----------------------------------------------------------


def _landed_lake(spark: SparkSession, sf_dir: str) -> P.Lake:
    """A new lake in the shared folder with every month landed."""
    lake = P.Lake(fresh_folder(spark, "lake"))
    L.land_months(star.bridge_trips(spark, sf_dir), lake.bronze)
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    return lake


@query
def bronze_lineage(spark, sf_dir):
    """Every landed month read back with its lineage."""
    bronze = read_bronze(spark, _landed_lake(spark, sf_dir).bronze, ALL_MONTHS, RUN_TS)
    name = F.regexp_extract("source_file", r"(yellow_tripdata_[^/]*\.parquet)", 1)
    return bronze.groupBy("source_month", name.alias("file_name"), "ingested_at").agg(
        M.rows().alias("row_count"), M.total("fare_amount").alias("fares")
    )


@query
def bronze_extra_columns(spark, sf_dir):
    """A column nobody declared, through landing, rejection and deduplication, to Silver and quarantine."""
    lake = P.Lake(fresh_folder(spark, "lake"))
    trips = star.bridge_trips(spark, sf_dir)
    L.land_months(trips.withColumn("congestion_surcharge", F.col("VendorID") * 2.5), lake.bronze)
    L.land_lookup(star.bridge_zones(spark, sf_dir), lake.lookup)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    parts = [("silver", lake.silver), ("quarantine", lake.quarantine)]
    found = [P.read(spark, lake, path).select(F.lit(name).alias("part"), "source_month", "congestion_surcharge") for name, path in parts]
    return found[0].union(found[1]).groupBy("part", "source_month").agg(
        M.rows().alias("row_count"), M.total("congestion_surcharge").alias("surcharge")
    )


@query
def landed_twice(spark, sf_dir):
    """One month landed by both ways: its count on landing, its rows on reading and the ingest log."""
    lake = P.Lake(fresh_folder(spark, "lake"))
    trips = star.bridge_trips(spark, sf_dir)
    L.land_months(trips, lake.bronze)
    copied = L.land_month(trips.where("source_month = '2024-03'").drop("source_month"), lake.bronze, "2024", "03")
    log = f"{lake.root}/ingest_log"
    L.log_ingest(spark, log, "2024-03", copied, "run-1")
    logged = spark.read.parquet(log).select("target_month", "status", F.col("rows_copied").alias("row_count"))
    read_back = read_bronze(spark, lake.bronze, "2024-03", RUN_TS).groupBy(F.col("source_month").alias("target_month"))
    return logged.union(read_back.agg(F.lit("Read").alias("status"), M.rows().alias("row_count")))


@query
def sum_small_values(spark, sf_dir):
    """Totals of values far below a cent."""
    lines = star.table(spark, sf_dir, "lineitem").withColumn("tiny", F.col("l_tax") / 1000)
    return lines.groupBy("l_returnflag").agg(M.total("tiny", 6).alias("total_tiny"), M.mean("tiny", 9).alias("mean_tiny"))


@query
def medallion_run_log(spark, sf_dir):
    """Land, full Silver build, and the logged counts."""
    lake = _landed_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    return P.read(spark, lake, lake.run_log).drop("run_timestamp")


@query
def medallion_rerun(spark, sf_dir):
    """Full build, then two months run again: Silver by source and pickup month is unchanged."""
    lake = _landed_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    for month in ("2024-03", "2024-04"):
        P.run_silver(spark, lake, month, "incremental", RUN_TS)
    silver = P.read(spark, lake, lake.silver)
    return silver.groupBy("source_month", "pickup_year_month").agg(
        M.rows().alias("row_count"), M.total("total_cost").alias("revenue")
    )


@query
def medallion_gold(spark, sf_dir):
    """The whole run; the daily table as written."""
    lake = _landed_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    return P.build_gold(spark, lake, RUN_TS, AS_OF)["agg_daily_borough"].drop("aggregated_at")


@query
def medallion_quality(spark, sf_dir):
    """The whole run; the report of every declared check over the written tables."""
    lake = _landed_lake(spark, sf_dir)
    P.run_silver(spark, lake, mode="full", run_ts=RUN_TS)
    P.build_gold(spark, lake, RUN_TS, AS_OF)
    return P.check_run(spark, lake, gate=False)


@query
def layout_range(spark, sf_dir):
    """Trips written in range layout and read back."""
    path = fresh_folder(spark, "range")
    K.write_table(Y.clustered(_silver(spark, sf_dir), ["pickup_datetime", "pickup_borough"]), path)
    return _by_borough(spark.read.parquet(path))


@query
def layout_zorder(spark, sf_dir):
    """Trips written in z-order over day and zone, and read back."""
    path = fresh_folder(spark, "zorder")
    buckets = {"pickup_datetime": F.dayofyear("pickup_datetime"), "PULocationID": F.col("PULocationID")}
    K.write_table(Y.zordered(_silver(spark, sf_dir), buckets, bits=9), path)
    return _by_borough(spark.read.parquet(path))


def _by_borough(silver: DataFrame) -> DataFrame:
    return silver.groupBy("pickup_borough").agg(M.rows().alias("trips"), M.total("total_cost").alias("revenue"))


# --- streaming ----------------------------------------------------------------


def _lineitem_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = star.table(spark, sf_dir, "lineitem").schema
    return stream.stream_files(spark, f"{sf_dir}/lineitem.parquet*", schema)


@query
def stream_clean_and_tag(spark, sf_dir):
    """Trips tagged and enriched as a stream, then profiled."""
    trips = star.bridge_trips(spark, sf_dir, lineitem=_lineitem_stream(spark, sf_dir))
    tagged = stream.clean_and_tag(trips, star.bridge_zones(spark, sf_dir))
    out = fresh_folder(spark, "stream")
    done = stream.run_available(tagged, f"{out}/table", f"{out}/checkpoint")
    return done.groupBy(R.REASON, "pickup_borough").agg(
        M.rows().alias("row_count"), M.total("total_cost").alias("revenue")
    )


@query
def stream_hourly_events(spark, sf_dir):
    """Hour totals of the event stream, open hours included."""
    schema = star.table(spark, sf_dir, "events").schema
    events = stream.stream_files(spark, f"{sf_dir}/events.parquet*", schema)
    totals = stream.hourly_totals(
        events.withColumn("at", F.col("ts").cast("timestamp")),
        "at",
        ["event_type"],
        [M.rows().alias("event_count"), M.total("value").alias("total_value")],
        delay="1 hour",
    )
    out = fresh_folder(spark, "stream")
    done = stream.run_totals(totals, f"{out}/table", f"{out}/checkpoint", ["hour_start", "event_type"])
    return done.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query
def stream_dedup_keys(spark, sf_dir):
    """Trip keys that survive streaming deduplication."""
    trips = star.bridge_trips(spark, sf_dir, lineitem=_lineitem_stream(spark, sf_dir))
    clean = R.accepted(V.tag_trips(trips)).withColumn("at", F.col("pickup_datetime").cast("timestamp"))
    first = stream.first_arrivals(clean, V.TRIP_KEYS, at="at", spread=16).select(*V.TRIP_KEYS)
    out = fresh_folder(spark, "stream")
    return stream.run_available(first, f"{out}/table", f"{out}/checkpoint")
