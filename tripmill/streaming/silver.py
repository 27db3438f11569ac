"""A stream of trips into Silver, exactly as a batch run would leave it.

A micro-batch lands its rows in Bronze under its own number and then rebuilds the Silver
partitions that its months touch, from all that Bronze holds for them. Both steps replace
what an earlier attempt left: a batch that is repeated after a failure, months that
arrive in any order and copies that arrive before their originals change nothing about
the table in the end. The survivor of a set of copies is that of the batch job, the
earliest submission, not the first to arrive.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.schema import require_columns
from tripmill.plans import pipeline as P
from tripmill.plans.silver import YEAR
from tripmill.session import pin_session
from tripmill.sources.bronze import MONTH_IN_PATH, TRIP_FILE
from tripmill.sources.inventory import files_of
from tripmill.sources.schemas import BRONZE_TRIPS


def land_batch(batch: DataFrame, lake: P.Lake, label: str) -> list[str]:
    """Lands a batch of trips (with ``source_month``) under ``label``; returns its months.

    The folder of a month keeps one folder a batch, replaced when the batch comes again.
    """
    head, tail = TRIP_FILE.split("{month}")
    named = require_columns(batch, BRONZE_TRIPS).withColumns(
        {"trip_file": F.concat(F.lit(head), F.col("source_month"), F.lit(tail)), "batch": F.lit(label)}
    )
    writer = named.drop("source_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("trip_file", "batch").parquet(lake.bronze)
    return landed_months(batch.sparkSession, lake, label)


def landed_months(spark: SparkSession, lake: P.Lake, label: str) -> list[str]:
    """Months that a batch landed rows for, from the names of its files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{lake.bronze}/*/batch={label}")
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    paths = [f.getPath().toString() for f in files or []]
    found = (re.search(MONTH_IN_PATH, path) for path in (files_of(spark, paths) if paths else []))
    return sorted({m.group(1) for m in found if m})


def into_silver(lake: P.Lake, stream: str, run_ts: str, year: int = YEAR) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` takes. ``stream`` names the source: its batch numbers are its own."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pin_session(spark)
        months = land_batch(batch, lake, f"{stream}-{number}")
        if months:
            P.rebuild_months(spark, lake, P.read(spark, lake, lake.zones), months, run_ts, year)

    return apply


def run_into_silver(
    trips: DataFrame, lake: P.Lake, stream: str, checkpoint: str, run_ts: str, year: int = YEAR
) -> DataFrame:
    """Drains a stream of trips into Silver; returns the table."""
    spark = trips.sparkSession
    pin_session(spark)
    P.store_zones(spark, lake)
    query = (
        trips.writeStream.foreachBatch(into_silver(lake, stream, run_ts, year))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return P.read(spark, lake, lake.silver)
