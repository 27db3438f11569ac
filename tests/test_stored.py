"""Stored tables: incremental Gold, drifted files, exact streams, layouts, buckets, pruning, the catalog."""

from __future__ import annotations

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_pipeline import at, february, january

from tripmill import stored_queries as Q
from tripmill.functions import sketches as H
from tripmill.functions.holidays import is_holiday
from tripmill.functions.states import STATE_GRAIN, merged, state_measures
from tripmill.operators.checks import QualityGateError
from tripmill.operators.schema import RESCUE, align_schema, rescued_counts
from tripmill.plans import gold as G
from tripmill.plans import increment
from tripmill.plans import pipeline as P
from tripmill.plans import silver as V
from tripmill.sinks import catalog
from tripmill.sinks import landing as L
from tripmill.sinks import layout as Y
from tripmill.sinks import tables as K
from tripmill.sources import inventory as N
from tripmill.sources.bronze import read_bronze, trip_file
from tripmill.sources.spine import date_spine
from tripmill.streaming import silver as S
from tripmill.streaming.trips import stream_files

TS, LATER, DAY = "2024-06-15T06:00:00", "2024-07-15T06:00:00", "2024-06-15"


@pytest.fixture
def lake(lake_root, zones):
    made = P.Lake(lake_root)
    L.land_lookup(zones, made.lookup)
    return made


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(df.collect(), key=str)


def gold(spark, lake):
    return {n: rows(P.gold_table(spark, lake, n).drop("aggregated_at", "loaded_at")) for n in P.GOLD_TABLES}


# --- states and incremental Gold ----------------------------------------------


def test_aggregates_take_one_scan_of_the_fact(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    P.update_gold(spark, lake, TS, DAY)
    fact, states = (P.read(spark, lake, lake.gold(n)) for n in ("fact_trips", "trip_states"))
    assert plan(G.trip_states(fact)).count("FileScan") == 1
    for build in (G.agg_hourly_zone, G.agg_daily_borough, G.agg_payment_trends):
        df = build(states, of=state_measures)
        assert plan(df).count("FileScan") == 1 and all("/gold/trip_states/" in f for f in df.inputFiles())
        assert rows(build(states, of=state_measures)) == rows(build(fact))


def test_states_of_parts_add_up(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    P.update_gold(spark, lake, TS, DAY)
    fact = P.read(spark, lake, lake.gold("fact_trips"))
    odd = F.hash("trip_id") % 2 == 0
    parts = G.trip_states(fact.where(odd)).union(G.trip_states(fact.where(~odd)))
    assert rows(merged(parts, STATE_GRAIN)) == rows(G.trip_states(fact))


def days_of(bronze, month, days, **more):
    return bronze(*[at(month, d, **more) for d in days])


def test_incremental_gold_equals_a_rebuild(spark, lake, bronze):
    for month, days in ((1, range(1, 29)), (2, range(1, 10)), (3, (1, 2)), (4, range(1, 20)), (6, range(1, 5))):
        L.land_month(days_of(bronze, month, days), lake.bronze, "2024", f"{month:02d}")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    assert P.update_gold(spark, lake, TS, DAY) == ["2024-01", "2024-02", "2024-03", "2024-04", "2024-06"]
    assert P.update_gold(spark, lake, TS, DAY) == []
    before = {n: set(P.read(spark, lake, lake.gold(n)).inputFiles()) for n in Q.STORED}
    L.land_month(days_of(bronze, 2, range(1, 12), fare=50.0), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, "2024-02", "incremental", LATER)
    assert P.update_gold(spark, lake, LATER, DAY) == ["2024-02"]
    left = {n: {f.split("month=")[1][:7] for f in before[n] & set(P.read(spark, lake, lake.gold(n)).inputFiles())} for n in Q.STORED}
    others = {"2024-01", "2024-03", "2024-04", "2024-06"}
    assert left["fact_trips"] == left["trip_states"] == left["agg_hourly_zone"] == others
    # two days of March and the first five of April look back into February
    assert left["agg_daily_borough"] == {"2024-01", "2024-06"}
    found = gold(spark, lake)
    P.build_gold(spark, lake, LATER, DAY)
    assert found == gold(spark, lake)


def test_a_month_that_goes_leaves_gold(spark, lake, bronze):
    L.land_month(bronze(at(1, 5), at(3, 1)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    P.update_gold(spark, lake, TS, DAY)
    L.land_month(bronze(at(1, 5)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    assert P.update_gold(spark, lake, TS, DAY) == ["2024-01", "2024-03"]
    assert P.gold_table(spark, lake, "fact_trips").count() == 1
    assert P.gold_table(spark, lake, "agg_payment_trends").count() == 1
    assert P.gold_table(spark, lake, "agg_daily_borough").count() == 1


def test_a_build_that_failed_is_made_up_for(spark, lake, bronze, monkeypatch):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    P.update_gold(spark, lake, TS, DAY)
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, "2024-02", "incremental", TS)
    with monkeypatch.context() as m:
        m.setattr(increment, "daily_part", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.update_gold(spark, lake, TS, DAY)
    P.update_gold(spark, lake, TS, DAY)
    found = gold(spark, lake)
    P.build_gold(spark, lake, TS, DAY)
    assert found == gold(spark, lake)


# --- drifted files ------------------------------------------------------------


def test_every_file_of_a_month_counts(spark, lake, bronze):
    month = f"{lake.bronze}/trip_file={trip_file('2024-01')}"
    bronze(at(1, 5)).write.parquet(f"{month}/a")
    bronze(at(1, 6)).withColumn("surge", F.lit(3)).write.parquet(f"{month}/b")
    text = F.col("passenger_count").cast("string")
    bronze(at(1, 7), at(1, 8)).withColumns({"passenger_count": text, "surge": F.lit(2.5)}).write.parquet(f"{month}/c")
    odd = F.when(F.dayofmonth("tpep_pickup_datetime") == 9, F.lit("abc")).otherwise(F.lit("2.7"))
    bronze(at(1, 9), at(1, 10)).withColumn("passenger_count", odd).write.parquet(f"{month}/d")
    found = {r.tpep_pickup_datetime.day: r for r in read_bronze(spark, lake.bronze, "2024-01", TS).collect()}
    assert [found[d].surge for d in range(5, 11)] == [None, 3.0, 2.5, 2.5, None, None]
    assert [found[d].passenger_count for d in range(5, 11)] == [1, 1, 1, 1, None, None]
    assert found[9][RESCUE] == '{"passenger_count":"abc"}' and found[10][RESCUE] == '{"passenger_count":"2.7"}'
    assert all(found[d][RESCUE] is None for d in range(5, 9))
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    bad = P.read(spark, lake, lake.quarantine)
    assert {r.reject_reason for r in bad.collect()} == {V.UNREADABLE}
    assert [tuple(r) for r in rescued_counts(bad).collect()] == [("passenger_count", 2)]
    assert P.read(spark, lake, lake.silver).count() == 4


def test_values_that_do_not_fit_are_kept(spark):
    df = spark.createDataFrame(
        [("1", 2.0, 2**40, dt.date(2024, 1, 2)), ("x", 2.5, 7, None), (None, float("nan"), None, None)],
        "a string, b double, c long, d date",
    )
    target = T.StructType.fromDDL("a int, b long, c int, d timestamp_ntz, e string")
    got = align_schema(df, target, rescue=RESCUE).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 2, None, dt.datetime(2024, 1, 2)), (None, None, 7, None), (None, None, None, None)]
    assert [r[RESCUE] for r in got] == ['{"c":"1099511627776"}', '{"a":"x","b":"2.5"}', '{"b":"NaN"}']
    assert RESCUE not in align_schema(df, df.schema, rescue=RESCUE).columns


def test_the_ladder_of_types():
    wide = [("int", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "double", "double"),
            ("double", "string", "string"), ("float", "int", "double"), ("array<int>", "int", "string"),
            ("decimal(10,0)", "decimal(6,4)", "decimal(14,4)"), ("decimal(38,0)", "decimal(38,10)", "double")]
    for a, b, c in wide:
        kinds = [T.StructType.fromDDL(f"c {x}")["c"].dataType for x in (a, b, c)]
        assert N.wider(kinds[0], kinds[1]) == N.wider(kinds[1], kinds[0]) == kinds[2]


def test_files_are_grouped_by_schema_not_by_place(spark, tmp_path):
    for k in range(8):
        kind = "int" if k % 2 else "string"
        spark.range(2).select(F.lit(str(k)).cast(kind).alias("v"), F.lit(1).alias(f"c{k % 3}")).write.parquet(f"{tmp_path}/{k}")
    groups = N.schema_groups(spark, [f"{tmp_path}/{k}" for k in range(8)])
    assert sorted(len(paths) for _, paths in groups) == [4, 4]
    assert {f.name for s, _ in groups for f in s.fields} == {"v", "c0", "c1", "c2"}
    assert N.widened(groups)["v"].dataType == T.StringType()


def test_a_type_that_changes_later_asks_for_a_full_run(spark, lake, bronze):
    L.land_month(bronze(at(1, 5)).withColumn("surge", F.lit(1)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    L.land_month(bronze(at(2, 5)).withColumn("surge", F.lit("high")), lake.bronze, "2024", "02")
    with pytest.raises(ValueError, match="surge was written as int and is string now"):
        P.run_silver(spark, lake, "2024-02", "incremental", TS)
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    assert {r.surge for r in P.read(spark, lake, lake.silver).collect()} == {"1", "high"}


def test_ingest_times_of_other_months_stay(spark, lake, bronze):
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, "2024-01", "incremental", TS)
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    P.run_silver(spark, lake, "2024-02", "incremental", LATER)
    got = {(r.source_month, r.ingested_at.month) for r in P.read(spark, lake, lake.silver).collect()}
    assert got == {("2024-01", 6), ("2024-02", 7)}


# --- exact stream into Silver -------------------------------------------------


def arrivals(spark, bronze, path):
    """Four deliveries out of order, with copies before their originals."""
    jan, feb = (df(bronze).withColumn("source_month", F.lit(m)) for df, m in ((february, "2024-02"), (january, "2024-01")))
    for k, (df, part) in enumerate([(jan, 0), (feb, 0), (jan, 1), (feb, 1)]):
        df.where(F.dayofmonth("tpep_pickup_datetime") % 2 == part).coalesce(1).write.parquet(f"{path}/{k}")


def survivors(df):
    return sorted((r.pickup_year_month, r.source_month, r.pickup_datetime.day, r.tip_amount) for r in df.collect())


def test_streamed_silver_equals_the_batch_job(spark, lake, bronze, tmp_path, zones):
    from test_pipeline import EXPECTED

    path = str(tmp_path / "arrivals")
    arrivals(spark, bronze, path)
    schema = spark.read.parquet(f"{path}/*").schema
    trips = stream_files(spark, f"{path}/*", schema, files_per_batch=1)
    done = S.run_into_silver(trips, lake, "s", str(tmp_path / "check"), TS)
    assert survivors(done) == EXPECTED
    assert P.read(spark, lake, lake.quarantine).count() == 2
    # drained again there is nothing new; a repeated batch changes nothing either
    assert survivors(S.run_into_silver(trips, lake, "s", str(tmp_path / "check"), TS)) == EXPECTED
    again = S.into_silver(lake, "s", TS)
    for k in (2, 0):
        again(spark.read.parquet(f"{path}/{k}"), k)
    assert read_bronze(spark, lake.bronze, "all", TS).count() == 8
    batch = P.Lake(lake.root + "-batch")
    L.land_lookup(zones, batch.lookup)
    L.land_months(spark.read.parquet(f"{path}/*"), batch.bronze)
    P.run_silver(spark, batch, mode="full", run_ts=TS)
    assert survivors(P.read(spark, lake, lake.silver)) == survivors(P.read(spark, batch, batch.silver)) == EXPECTED


# --- layouts, sketches, holidays ----------------------------------------------


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp_ntz", "string", "boolean"])
def test_quantile_buckets_follow_the_order_of_any_type(spark, kind):
    made = {"date": "date_add(date'2024-01-01', cast(id as int))", "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id)",
            "string": "concat(char(97 + id % 26), 'x', id)", "boolean": "id % 2 = 0"}
    df = spark.range(1000).selectExpr(f"{made.get(kind, f'cast(id * id as {kind})')} as v").union(spark.sql(f"select cast(null as {kind})"))
    edges = Y.quantile_edges(df, ["v"], 3)["v"]
    got = df.select("v", Y.bucket_of(Y.ordinal(df, "v"), edges).alias("b")).collect()
    known = sorted((r.v, r.b) for r in got if r.v is not None)
    assert [b for _, b in known] == sorted(b for _, b in known)
    assert {r.b for r in got if r.v is None} == {0}
    sizes = [sum(b == k for _, b in known) for k in range(len(edges) + 1)]
    assert max(sizes) <= (600 if kind == "boolean" else 200)


def test_bucket_numbers_beyond_their_bits_count_as_the_largest(spark):
    df = spark.createDataFrame([(k,) for k in (-3, 0, 7, 8, 900, None)], "b int")
    got = [r[0] for r in df.select(Y.interleaved([F.col("b"), F.lit(0)], 3)).collect()]
    assert got == [0, 0, 21, 21, 21, 0]


def test_daily_sketches_add_up(spark):
    df = spark.range(40_000).selectExpr("id % 9000 as u", "id % 30 as day")
    daily = df.groupBy("day").agg(H.distinct_state("u").alias("s"))
    got = daily.agg(H.estimate(H.merged_state("s")).alias("n")).select(H.within_bound(F.col("n"), F.lit(9000))).first()[0]
    assert got is True
    assert df.where("false").agg(H.estimate(H.distinct_state("u"))).first()[0] == 0


def test_holiday_rules(spark):
    days = date_spine(spark, "2024-01-01", "2024-12-31")
    assert sorted(str(r[0]) for r in days.where(is_holiday("calendar_date")).collect()) == G.US_HOLIDAYS
    found = {str(r[0]) for r in date_spine(spark, "2021-01-01", "2022-12-31").where(is_holiday("calendar_date")).collect()}
    # 4 July 2021 was a Sunday, Christmas 2021 and New Year 2022 were Saturdays, 19 June 2022 a Sunday
    assert {"2021-07-05", "2021-12-24", "2021-12-31", "2022-06-20"} <= found
    assert not {"2021-07-04", "2021-12-25", "2022-01-01", "2022-06-19"} & found and len(found) == 22


# --- buckets, pruning, the catalog --------------------------------------------


def test_bucketed_tables_need_no_exchange(spark, sf_dir):
    table = Q.bucketed_trips(spark, sf_dir)
    for df in (V.dedup_trips(table), catalog.copies(table, V.TRIP_KEYS)):
        assert "Exchange" not in plan(df)


def test_the_calendar_prunes_the_fact_at_run_time(spark, sf_dir):
    star = Q.quarter_star(spark, sf_dir, Q.written_fact(spark, sf_dir))
    scan = re.search(r"FileScan parquet [^\n]*trip_id[^\n]*", plan(star))[0]
    assert "dynamicpruning" in scan.lower()
    read = star.select("pickup_year_month").distinct().collect()
    assert {r[0] for r in read} == {"2024-07", "2024-08", "2024-09"}


def test_catalog_tables_prune_by_the_metastore(spark, lake_root, bronze, zones):
    database = f"lake_{uuid.uuid4().hex}"
    lake = P.Lake(lake_root, database=database)
    spark.sql(f"create database {database} location '{lake_root}/database'")
    L.land_lookup(zones, lake.lookup)
    L.land_month(january(bronze), lake.bronze, "2024", "01")
    P.run_pipeline(spark, lake, "2024-01", "incremental", TS, DAY)
    L.land_month(february(bronze), lake.bronze, "2024", "02")
    P.run_pipeline(spark, lake, "2024-02", "incremental", TS, DAY)
    P.run_pipeline(spark, lake, "2024-02", "incremental", TS, DAY)
    P.read(spark, lake, lake.gold("fact_trips"))
    fact = spark.table(lake.named("gold/fact_trips"))
    assert fact.count() == 4
    text = plan(fact.where("pickup_year_month = '2024-01'"))
    assert "CatalogFileIndex" in text or "InMemoryFileIndex(1 paths)" in text
    assert catalog.partitions(spark, lake.named("gold/fact_trips")) == {f"pickup_year_month=2024-0{k}" for k in (1, 2)}
    K.drop_table(spark, f"{lake.gold('fact_trips')}/pickup_year_month=2024-02")
    P.read(spark, lake, lake.gold("fact_trips"))
    assert spark.table(lake.named("gold/fact_trips")).count() == 2


# --- one pass over the tables, whole results ----------------------------------


@pytest.fixture
def submitted(spark, monkeypatch, bronze):
    """Stands in for the trips of the given tables; its list grows by one a query and row read."""
    trips = bronze(
        *[at(month, day, RatecodeID=day, VendorID=1 + day % 2, payment_type=1) for month in (3, 4, 5) for day in range(1, 9)]
    )
    trips = trips.withColumn("source_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    read = spark.sparkContext.accumulator(0)

    def see(month):
        read.add(1)
        return month

    seen = F.udf(see, "string").asNondeterministic()
    monkeypatch.setattr(Q.star, "bridge_trips", lambda *_: trips.withColumn("source_month", seen("source_month")))
    return read


def test_a_corrected_month_takes_one_pass_over_the_tables(spark, sf_dir, submitted):
    """The corrected month is cut from what was landed, and comes back whole."""
    assert Q.gold_incremental_hourly(spark, sf_dir).count() == 24
    assert submitted.value == 24


def test_a_drifted_month_takes_one_pass_over_the_tables(spark, sf_dir, submitted):
    """Each query builds its own lake and reads every row of the tables once, whatever ran before."""
    found = {r.source_month: r.row_count for r in Q.drifted_month(spark, sf_dir).collect()}
    assert found == {"2024-03": 8, "2024-04": 8, "2024-05": 8}
    assert submitted.value == 24
    assert [(r.column_name, r.value_count) for r in Q.drifted_values(spark, sf_dir).collect()] == [("trip_distance", 3)]
    assert submitted.value == 2 * 24


def test_a_month_is_taken_out_whole(spark, lake, bronze):
    trips = bronze(at(1, 5), at(1, 6), at(2, 3))
    L.land_months(trips.withColumn("source_month", F.date_format("tpep_pickup_datetime", "yyyy-MM")), lake.bronze)
    january = L.take_month(spark, lake.bronze, "2024-01", trips.schema)
    assert january.count() == 2 and january.schema == trips.schema
    assert {r.source_month for r in read_bronze(spark, lake.bronze, "all", TS).collect()} == {"2024-02"}
    assert L.take_month(spark, lake.bronze, "2024-07", trips.schema).count() == 0


def test_quarantine_is_written_without_a_shuffle(spark, lake, bronze, monkeypatch):
    """Bronze files hold a month each, so rejected rows go where they belong from the scan."""
    plans = []
    real = K.write_partitions

    def spied(df, path, by, *args, **kwargs):
        if path == lake.quarantine:
            gather = kwargs.get("gather", True)
            plans.append((gather, plan(df)))
        return real(df, path, by, *args, **kwargs)

    monkeypatch.setattr(K, "write_partitions", spied)
    monkeypatch.setattr(P.K, "write_partitions", spied)
    for month in (1, 2):
        L.land_month(bronze(at(month, 5, fare=-1.0), at(month, 6)), lake.bronze, "2024", f"{month:02d}")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    P.rebuild_months(spark, lake, P.read(spark, lake, lake.zones), ["2024-01", "2024-02"], TS)
    assert len(plans) == 2 and not any(gather or "Exchange" in text for gather, text in plans)
    bad = P.read(spark, lake, lake.quarantine)
    assert sorted(r.source_month for r in bad.collect()) == ["2024-01", "2024-02"]


def test_the_streamed_lines_grow_in_files_not_in_size(spark, sf_dir, tmp_path, monkeypatch):
    """Lines of several files stream in two batches, and no file takes the rows of many tasks."""
    table = Q.star.table(spark, sf_dir, "lineitem")
    wide = str(tmp_path / "lineitem")
    table.repartition(6).write.parquet(wide)
    many = spark.read.schema(table.schema).option("maxPartitionBytes", 1).parquet(wide)
    real, taken = Q.star.table, {}
    monkeypatch.setattr(Q.star, "table", lambda s, d, name: many if name == "lineitem" else real(s, d, name))
    stream_of = Q.stream.stream_files

    def spied(session, path, schema, files_per_batch=None):
        files = session.read.schema(schema).parquet(path).inputFiles()
        taken.update(files=len(files), batch=files_per_batch)
        return stream_of(session, path, schema, files_per_batch)

    monkeypatch.setattr(Q.stream, "stream_files", spied)
    found = rows(Q.stream_into_silver(spark, sf_dir))
    monkeypatch.setattr(Q.star, "table", real)
    assert taken["files"] > 2 and taken["batch"] == (taken["files"] + 1) // 2
    assert found == rows(Q.stream_into_silver(spark, sf_dir))


def test_the_gate_runs_the_checks_once(spark, lake, bronze, monkeypatch):
    """The error that stops a run carries the report it was stopped over."""
    runs, real = [], P.run_checks
    monkeypatch.setattr(P, "run_checks", lambda *args: runs.append(1) or real(*args))
    L.land_month(bronze(at(1, 5, DOLocationID=99)), lake.bronze, "2024", "01")
    P.run_silver(spark, lake, mode="full", run_ts=TS)
    P.update_gold(spark, lake, TS, DAY)
    with pytest.raises(QualityGateError) as stopped:
        P.check_run(spark, lake, gate=True)
    report = stopped.value.report
    assert len(runs) == 1 and "Exchange" not in plan(report)
    assert rows(report) == rows(P.check_run(spark, lake, gate=False))
