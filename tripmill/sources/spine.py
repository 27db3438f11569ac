"""Date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("calendar_date")


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(_days(F.lit(first).cast("date"), F.lit(last).cast("date")))


def date_spine_of(df: DataFrame, day: Column) -> DataFrame:
    """One row per day between the earliest and the latest day found in a table."""
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(_days(F.col("first"), F.col("last")))
