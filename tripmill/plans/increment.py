"""Incremental Gold: only the partitions that a changed month reaches are written.

A pickup month is a partition of Silver, of the fact, of the trip states and of the hourly
and daily tables; the payment table is partitioned by month number. What changed is asked
of Silver itself: each build keeps the names of the Silver files behind every partition,
and a partition whose files have other names now is touched. So a build that failed
halfway, or a Silver run nobody reported, is found by the next build.

Changes spread from a touched month as the tables depend on it: the fact, the states and
the hourly table in that month; payments in its month number; running totals and ranks of
the daily table in that month; and week-over-week changes also in the seven days with
data that follow it, borough by borough, wherever these lie.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.functions.scalars import year_month
from tripmill.functions.states import state_measures
from tripmill.plans import gold as G
from tripmill.sinks import tables as K

PART = "pickup_year_month"
STEPS_BACK = 7  # days with data that a week-over-week change looks back
MONTH = re.compile(r"\d{4}-\d\d")
BUILT = "pickup_year_month string, fingerprint string"


def fingerprints(files: Iterable[str], column: str = PART) -> dict[str, str]:
    """A digest of the file names of each partition; a rewritten file has another name."""
    by_part: dict[str, list[str]] = {}
    for path in files:
        found = re.search(rf"/{column}=([^/]+)/", path)
        if found:
            by_part.setdefault(found.group(1), []).append(path.rsplit("/", 1)[1])
    return {part: hashlib.md5("\n".join(sorted(names)).encode()).hexdigest() for part, names in by_part.items()}


def changed(before: dict[str, str], now: dict[str, str]) -> list[str]:
    return sorted(part for part in before.keys() | now.keys() if before.get(part) != now.get(part))


def reached_days(keys: DataFrame, touched: list[str]) -> list[str]:
    """Months of the daily table to rebuild: the touched ones and those of the days that look back into them.

    ``keys`` has one row a borough and day. A later day is reached if fewer than seven
    days with data lie between it and the end of a touched month.
    """
    back = F.lag("pickup_date", STEPS_BACK).over(Window.partitionBy("pickup_borough").orderBy("pickup_date"))
    seen = keys.select("pickup_date", back.alias("back"))
    ends = [f"last_day(date'{m}-01')" for m in touched if MONTH.fullmatch(m)]
    tests = " or ".join(f"(pickup_date > {end} and (back is null or back <= {end}))" for end in ends)
    months = seen.where(tests or "false").select(year_month("pickup_date").alias("month")).distinct()
    return sorted({*touched, *(r.month for r in months.collect())})


def daily_part(states: DataFrame, stored: DataFrame | None, touched: list[str]) -> tuple[DataFrame, list[str]]:
    """The daily table's rows in the reached months, and these months.

    ``stored`` is the table as it is. Its rows are one a borough and day, so the windows
    run over all of them; rows of untouched months keep the totals that they have.
    """
    base = G.daily_borough_base(states.where(F.col(PART).isin(touched)), state_measures)
    if stored is None:
        return G.daily_trends(base).withColumn(PART, year_month("pickup_date")), touched
    rest = stored.where(~F.col(PART).isin(touched)).select(*base.columns)
    both = rest.unionByName(base)
    months = reached_days(both.select("pickup_borough", "pickup_date"), touched)
    return G.daily_trends(both).withColumn(PART, year_month("pickup_date")).where(F.col(PART).isin(months)), months


def update_tables(spark: SparkSession, lake, read, silver: DataFrame, run_ts: str) -> list[str]:
    """Fact, states and aggregates brought up to the Silver table; returns the touched months.

    ``read`` reads a table of the lake by its path. The record of what was built is
    written last, so whatever a run fails after, the next one finds the same months.
    """
    fact_at, states_at, built_at = (lake.gold(n) for n in ("fact_trips", "trip_states", "built"))
    now, before = fingerprints(silver.inputFiles()), {}
    if K.exists(spark, built_at):
        before = {r[0]: r[1] for r in spark.read.schema(BUILT).parquet(built_at).collect()}
    whole = not before
    touched = sorted(now) if whole else changed(before, now)
    if not touched and not whole:
        return []

    def replace(df: DataFrame, name: str, column: str, parts: list[str]) -> None:
        """A first build writes the table, later ones the named partitions."""
        path = lake.gold(name)
        if whole:
            K.write_partitions(df, path, [column], replace="all", fmt=lake.fmt, gather=False)
        else:
            K.replace_partitions(df, path, column, parts, lake.fmt)

    staging = G.staging_trips(silver if whole else silver.where(F.col(PART).isin(touched)))
    # Silver files already hold one pickup month each, sorted by time: no shuffle
    replace(G.fact_trips(staging, run_ts), "fact_trips", PART, touched)
    fact = read(fact_at).where(F.col(PART).isin(touched))
    replace(K.gathered(G.trip_states(fact), PART), "trip_states", PART, touched)
    states = read(states_at)
    own = states.where(F.col(PART).isin(touched))

    hourly = G.agg_hourly_zone(own, run_ts, of=state_measures)
    hourly = hourly.withColumn(PART, year_month("pickup_date"))
    replace(K.gathered(hourly, PART), "agg_hourly_zone", PART, touched)

    numbers = sorted({str(int(m[5:7])) for m in touched if MONTH.fullmatch(m)})
    # the month number is part of the partition's name, so other partitions are not read
    same = states.where(F.substring(PART, 6, 2).cast("int").cast("string").isin(numbers))
    payments = G.agg_payment_trends(same, run_ts, of=state_measures)
    replace(K.gathered(payments, "pickup_month"), "agg_payment_trends", "pickup_month", numbers)

    stored = None if whole else read(lake.gold("agg_daily_borough"))
    daily, months = daily_part(states, stored, touched)
    if stored is not None:  # the table is read and written: what is read is set aside first
        daily = K.set_aside(spark, daily)
    replace(K.gathered(G.stamped(daily, "aggregated_at", run_ts), PART), "agg_daily_borough", PART, months)

    K.write_table(spark.createDataFrame(sorted(now.items()), BUILT).coalesce(1), built_at, lake.fmt)
    return touched
