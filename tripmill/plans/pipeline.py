"""The monthly run: Bronze to Silver to Gold, repeatable and month by month.

Copies of a trip share its pickup time, hence its pickup month. A Silver
partition (one pickup month) can therefore be rebuilt on its own, exactly, from
the Bronze months that hold rows for it; a small coverage table records which
ones do. An incremental run rebuilds just the partitions its month touches, so
late resubmissions are deduplicated across months, reruns change nothing, and a
corrected month gives back rows it used to displace.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tripmill.functions.scalars import year_month
from tripmill.operators.checks import enforce, run_checks
from tripmill.operators.rules import accepted, rejected
from tripmill.plans import gold as G
from tripmill.plans import increment
from tripmill.plans.quality import gold_checks, silver_checks
from tripmill.plans.silver import YEAR, dedup_trips, derive_trips, enrich_trips, tag_trips
from tripmill.session import pin_session
from tripmill.sinks import catalog
from tripmill.sinks import tables as K
from tripmill.sinks.layout import zordered_by_quantiles
from tripmill.sources.bronze import ALL_MONTHS, read_bronze, read_lookup
from tripmill.sources.inventory import wider
from tripmill.sources.schemas import BRONZE_TRIPS, RUN_LOG, ZONE_LOOKUP
from tripmill.sources.spine import date_spine

PIPELINE = "bronze_to_silver_trips"
AGGREGATES = {
    "agg_hourly_zone": G.agg_hourly_zone,
    "agg_daily_borough": G.agg_daily_borough,
    "agg_payment_trends": G.agg_payment_trends,
}
#: Aggregates that are stored by pickup month, which is no column of theirs.
BY_PICKUP_MONTH = ["agg_hourly_zone", "agg_daily_borough"]
GOLD_TABLES = ["dim_date", "dim_zone", "fact_trips", *AGGREGATES]
NO_MONTH = "unknown"  # partition of trips without a pickup time


@dataclass(frozen=True)
class Lake:
    """Where the tables live.

    ``zorder`` lays Silver out by time and borough at once, for an extra pass of
    sketches. With a ``database`` tables are read by name through the catalog.
    """

    root: str
    fmt: str = K.FORMAT
    zorder: bool = False
    database: str | None = None

    def named(self, name: str) -> str:
        return f"{self.database}.{name.replace('/', '_')}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze/trips")

    @property
    def lookup(self) -> str:
        return self.path("bronze/zone_lookup")

    @property
    def zones(self) -> str:
        return self.path("silver/zone_lookup")

    @property
    def silver(self) -> str:
        return self.path("silver/trips")

    @property
    def quarantine(self) -> str:
        return self.path("silver/rejected")

    @property
    def coverage(self) -> str:
        return self.path("silver/coverage")

    @property
    def columns(self) -> str:
        return self.path("silver/columns")

    @property
    def run_log(self) -> str:
        return self.path("silver/run_log")

    def gold(self, name: str) -> str:
        return self.path(f"gold/{name}")


@lru_cache(maxsize=4)
def table_schemas(spark: SparkSession) -> dict[str, StructType]:
    """Schemas of the written tables by relative path, taken from their plans.

    Reading with them spares the look into file footers, and lets a table that
    has no rows yet, and so no files, be read like any other.
    """
    lineage = [("source_file", "string"), ("source_month", "string"), ("ingested_at", "timestamp_ntz")]
    bronze = reduce(lambda schema, column: schema.add(*column), lineage, StructType(list(BRONZE_TRIPS.fields)))
    zones = spark.createDataFrame([], ZONE_LOOKUP)
    tagged = tag_trips(spark.createDataFrame([], bronze))
    silver = _silver(accepted(tagged), zones)
    now = "1970-01-01T00:00:00"
    fact = G.fact_trips(G.staging_trips(silver), now)
    frames = {
        "silver/zone_lookup": zones,
        "silver/trips": silver,
        "silver/rejected": rejected(tagged),
        "silver/coverage": coverage_of(tagged),
        "gold/dim_date": G.dim_date(date_spine(spark, "2024-01-01", "2024-01-01"), "2024-01-01"),
        "gold/dim_zone": G.dim_zone(zones),
        "gold/fact_trips": fact,
        "gold/trip_states": G.trip_states(fact),
        **{f"gold/{name}": build(fact, now) for name, build in AGGREGATES.items()},
    }
    for name in BY_PICKUP_MONTH:
        frames[f"gold/{name}"] = frames[f"gold/{name}"].withColumn(increment.PART, F.lit(""))
    return {**{name: frame.schema for name, frame in frames.items()}, "silver/run_log": RUN_LOG}


#: Tables that also hold whatever further columns Bronze has.
OPEN_TABLES = ("silver/trips", "silver/rejected")
PARTITIONED_BY = {
    "silver/trips": ["pickup_year_month"],
    "silver/rejected": ["source_month"],
    "silver/coverage": ["source_month"],
    "gold/fact_trips": ["pickup_year_month"],
    "gold/trip_states": ["pickup_year_month"],
    "gold/agg_hourly_zone": ["pickup_year_month"],
    "gold/agg_daily_borough": ["pickup_year_month"],
    "gold/agg_payment_trends": ["pickup_month"],
}
COLUMNS = "table_name string, column_name string, column_type string"


def read(spark: SparkSession, lake: Lake, path: str) -> DataFrame:
    reader = spark.read.format(lake.fmt)
    name = path.removeprefix(f"{lake.root}/")
    known = table_schemas(spark).get(name)
    if known is not None and lake.fmt == K.FORMAT:
        if name in OPEN_TABLES:
            known = StructType([*known.fields, *further_columns(spark, lake, name).fields])
        if lake.database:
            return catalog.table(spark, lake.named(name), known, path, PARTITIONED_BY.get(name, []), lake.fmt)
        reader = reader.schema(known)
    return reader.load(path)


def further_columns(spark: SparkSession, lake: Lake, name: str) -> StructType:
    """Columns that an open table was written with beyond the declared ones; no footer is read for it."""
    if not K.exists(spark, lake.columns):
        return StructType([])
    rows = spark.read.schema(COLUMNS).parquet(lake.columns).where(F.col("table_name") == name).distinct().collect()
    kinds: dict[str, DataType] = {}
    for row in sorted(rows):
        kind = StructType.fromDDL(f"c {row.column_type}")["c"].dataType
        kinds[row.column_name] = wider(kinds.get(row.column_name, kind), kind)
    return StructType([StructField(column, kind, True) for column, kind in kinds.items()])


def remember_columns(spark: SparkSession, lake: Lake, **written: DataFrame) -> None:
    """Notes the further columns of open tables before rows with them are written.

    A column whose type has changed since must be brought to one type by a full run.
    """
    new = []
    for key, df in written.items():
        name = f"silver/{key}"
        declared, noted = table_schemas(spark)[name].names, further_columns(spark, lake, name)
        for f in df.schema.fields:
            if f.name in declared:
                continue
            if f.name in noted.names and noted[f.name].dataType != f.dataType:
                before, now = noted[f.name].dataType.simpleString(), f.dataType.simpleString()
                raise ValueError(f"{f.name} was written as {before} and is {now} now: run all months in mode 'full'")
            if f.name not in noted.names:
                new.append((name, f.name, f.dataType.simpleString()))
    if new:
        spark.createDataFrame(new, COLUMNS).coalesce(1).write.mode("append").parquet(lake.columns)


def with_pickup_partition(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_year_month", F.coalesce(year_month("pickup_datetime"), F.lit(NO_MONTH)))


def coverage_of(tagged: DataFrame) -> DataFrame:
    """Accepted rows by source month and pickup month, and when the source was ingested."""
    return (
        with_pickup_partition(accepted(tagged))
        .groupBy("source_month", "pickup_year_month")
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("ingested_at").alias("ingested_at"))
    )


def restamped(bronze: DataFrame, times: dict) -> DataFrame:
    """Rows of months that were ingested by earlier runs keep their ingest time."""
    if not times:
        return bronze
    known = F.create_map(*[part for month, at in sorted(times.items()) for part in (F.lit(month), F.lit(at).cast("timestamp_ntz"))])
    return bronze.withColumn("ingested_at", F.coalesce(F.try_element_at(known, F.col("source_month")), "ingested_at"))


def _silver(accepted_rows: DataFrame, zones: DataFrame) -> DataFrame:
    return with_pickup_partition(enrich_trips(derive_trips(dedup_trips(accepted_rows)), zones))


#: Silver's files cover narrow ranges of the first of these, or in z-order of both.
LAYOUT = ["pickup_datetime", "pickup_borough"]


def _write_silver(silver: DataFrame, lake: Lake, replace: str) -> None:
    by = ["pickup_year_month"]
    if lake.zorder:
        laid_out = zordered_by_quantiles(silver, LAYOUT, lead=by)
        K.write_partitions(laid_out, lake.silver, by, replace=replace, fmt=lake.fmt, gather=False)
    else:
        K.write_partitions(silver, lake.silver, by, ["pickup_date", *LAYOUT], replace, lake.fmt)


def _log(spark: SparkSession, lake: Lake, month: str, mode: str, raw: int, kept: int, bad: int, run_ts: str) -> dict:
    record = {
        "pipeline_name": PIPELINE,
        "target_month": month,
        "run_mode": mode,
        "raw_rows": raw,
        "silver_rows": kept,
        "quarantine_rows": bad,
        "dupes_removed": raw - bad - kept,
        "run_timestamp": run_ts,
    }
    K.append_record(spark, lake.run_log, record, RUN_LOG, lake.fmt)
    return record


def store_zones(spark: SparkSession, lake: Lake) -> DataFrame:
    """The lookup as a Silver table, for the dimension to read."""
    K.write_table(read_lookup(spark, lake.lookup), lake.zones, lake.fmt)
    return read(spark, lake, lake.zones)


def run_silver(
    spark: SparkSession,
    lake: Lake,
    target_month: str = ALL_MONTHS,
    mode: str = "incremental",
    run_ts: str = "1970-01-01T00:00:00",
    year: int = YEAR,
) -> dict:
    """One Bronze-to-Silver run; returns the run-log record.

    Quarantine and Silver are written from two scans of the same map-only
    tagging. Counts come from the written tables (Parquet footers), not from
    accumulators, so a lost executor cannot inflate them.
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"mode is 'incremental' or 'full', not {mode!r}")
    pin_session(spark)
    zones = store_zones(spark, lake)
    if mode == "full" or target_month == ALL_MONTHS:
        return _run_all(spark, lake, zones, target_month, mode, run_ts, year)
    return _run_month(spark, lake, zones, target_month, mode, run_ts, year)


def _run_all(spark, lake, zones, target_month, mode, run_ts, year) -> dict:
    bronze = read_bronze(spark, lake.bronze, ALL_MONTHS, run_ts)
    tagged = tag_trips(bronze, year)
    silver = _silver(_in_year(accepted(tagged), year), zones)
    K.drop_table(spark, lake.columns)
    remember_columns(spark, lake, trips=silver, rejected=rejected(tagged))
    # Bronze files already hold one source month each: no shuffle
    K.write_partitions(rejected(tagged), lake.quarantine, ["source_month"], replace="all", fmt=lake.fmt, gather=False)
    K.write_partitions(coverage_of(tagged), lake.coverage, ["source_month"], [], "all", lake.fmt)
    _write_silver(silver, lake, "all")
    raw = bronze.count()
    kept = read(spark, lake, lake.silver).count()
    bad = read(spark, lake, lake.quarantine).count()
    return _log(spark, lake, target_month, mode, raw, kept, bad, run_ts)


def _months(rows: DataFrame, column: str) -> set[str]:
    """Distinct months of the coverage table: bounded by the calendar."""
    return {r[0] for r in rows.select(column).distinct().collect()}


def _run_month(spark, lake, zones, month, mode, run_ts, year) -> dict:
    touched = rebuild_months(spark, lake, zones, [month], run_ts, year)
    of_month = F.col("source_month") == month
    raw = read_bronze(spark, lake.bronze, month, run_ts).count()
    bad = read(spark, lake, lake.quarantine).where(of_month).count()
    kept = 0
    if touched and K.exists(spark, lake.silver):
        kept = read(spark, lake, lake.silver).where(of_month & F.col("pickup_year_month").isin(touched)).count()
    return _log(spark, lake, month, mode, raw, kept, bad, run_ts)


def rebuild_months(spark, lake: Lake, zones: DataFrame, months: list[str], run_ts: str, year: int = YEAR) -> list[str]:
    """The Bronze months into the tables that are there; returns the Silver partitions rebuilt.

    Coverage is written last, and the partitions to rebuild are also asked of Silver
    itself: whichever write a run fails after, running it again finds all partitions
    that the months touch or used to touch.
    """
    bronze = read_bronze(spark, lake.bronze, months, run_ts)
    tagged = tag_trips(bronze, year)
    of_months = F.col("source_month").isin(months)
    before: set[str] = set()
    for path in (lake.coverage, lake.silver):
        if K.exists(spark, path):
            before |= _months(read(spark, lake, path).where(of_months), "pickup_year_month")

    remember_columns(spark, lake, rejected=rejected(tagged))
    if len(months) == 1:
        K.write_leaf(rejected(tagged), lake.quarantine, "source_month", months[0], lake.fmt)
    else:
        K.replace_partitions(rejected(tagged), lake.quarantine, "source_month", months, lake.fmt)

    # one row a source and pickup month: bounded by the calendar
    own = coverage_of(tagged).collect()
    mine = spark.createDataFrame(own, table_schemas(spark)["silver/coverage"])
    coverage, times = mine, {}
    if K.exists(spark, lake.coverage):
        others = read(spark, lake, lake.coverage).where(~of_months).select(*mine.columns)
        coverage = others.union(mine)
        times = {r[0]: r[1] for r in others.groupBy("source_month").agg(F.max("ingested_at")).collect() if r[1]}
    touched = sorted(before | {r.pickup_year_month for r in own})
    holders = coverage.where(F.col("pickup_year_month").isin(touched))
    sources, filled = _months(holders, "source_month"), _months(holders, "pickup_year_month")

    if sources:
        again = restamped(read_bronze(spark, lake.bronze, sorted(sources), run_ts), times)
        again = with_pickup_partition(accepted(tag_trips(again, year))).where(F.col("pickup_year_month").isin(touched))
        silver = _silver(_in_months(again, touched), zones)
        remember_columns(spark, lake, trips=silver)
        _write_silver(silver, lake, "touched")
    for empty in sorted(set(touched) - filled):  # had rows before, has none now
        K.clear_leaf(spark, table_schemas(spark)["silver/trips"], lake.silver, "pickup_year_month", empty, lake.fmt)
    K.replace_partitions(mine.coalesce(1), lake.coverage, "source_month", months, lake.fmt)
    return touched


def _in_months(trips: DataFrame, months: list[str]) -> DataFrame:
    """A plain range on the raw pickup time, which the Parquet scan can use to skip row groups."""
    named = [m for m in months if m != NO_MONTH]
    if not named or len(named) != len(months):
        return trips
    first = F.lit(f"{named[0]}-01 00:00:00").cast("timestamp_ntz")
    after = F.lit(f"{named[-1]}-01 00:00:00").cast("timestamp_ntz") + F.expr("interval 1 month")
    raw = F.col("tpep_pickup_datetime")
    return trips.where((raw >= first) & (raw < after))


def _in_year(trips: DataFrame, year: int) -> DataFrame:
    """The year that the date rules accept, as a range for the Parquet scan; a null time stays."""
    raw = F.col("tpep_pickup_datetime")
    first, after = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return trips.where(raw.isNull() | ((raw >= first) & (raw < after)))


def build_gold(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    as_of: str,
    year: int = YEAR,
    holidays: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Dimensions, fact, and aggregates from the states of one scan of the fact; a full replace.

    ``holidays`` lists dates of the year as text, and a list without any is refused;
    without a list the federal rules hold.
    """
    K.drop_table(spark, lake.gold("built"))
    update_gold(spark, lake, run_ts, as_of, year, holidays)
    return gold_tables(spark, lake)


def update_gold(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    as_of: str,
    year: int = YEAR,
    holidays: list[str] | None = None,
) -> list[str]:
    """Gold brought up to Silver: all of it at first, then the partitions that changed months reach.

    Returns the changed pickup months. The dimensions are small and written each time.
    """
    if holidays is not None and not any(day.startswith(f"{year}-") for day in holidays):
        raise ValueError(f"no holidays are given for {year}")
    pin_session(spark)
    silver = read(spark, lake, lake.silver)
    K.publish_view(G.staging_trips(silver), "stg_silver_trips")

    spine = date_spine(spark, f"{year}-01-01", f"{year}-12-31")
    K.write_table(G.dim_date(spine, as_of, holidays), lake.gold("dim_date"), lake.fmt)
    K.write_table(G.dim_zone(read(spark, lake, lake.zones)), lake.gold("dim_zone"), lake.fmt)
    return increment.update_tables(spark, lake, lambda path: read(spark, lake, path), silver, run_ts)


def gold_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A Gold table with its own columns only."""
    table = read(spark, lake, lake.gold(name))
    return table.drop(increment.PART) if name in BY_PICKUP_MONTH else table


def gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {name: gold_table(spark, lake, name) for name in GOLD_TABLES}


def check_run(spark: SparkSession, lake: Lake, gate: bool = True) -> DataFrame:
    """The report over Silver and Gold; with ``gate`` a failing check stops the run."""
    pin_session(spark)
    tables = gold_tables(spark, lake)
    tables["silver_trips"] = read(spark, lake, lake.silver)
    report = run_checks(tables, silver_checks() + gold_checks())
    if gate:
        # one row a declared check: the gate and whoever looks at the report see one run of the checks
        report = spark.createDataFrame(report.collect(), report.schema)
        enforce(report)
    return report


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    target_month: str,
    mode: str,
    run_ts: str,
    as_of: str,
    year: int = YEAR,
    gate: bool = True,
) -> dict:
    """Silver, Gold and the checks, in that order."""
    record = run_silver(spark, lake, target_month, mode, run_ts, year)
    update_gold(spark, lake, run_ts, as_of, year)
    check_run(spark, lake, gate)
    return record
