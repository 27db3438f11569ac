"""Structured Streaming forms of the trip operators.

Each function maps a streaming frame to a streaming frame; ``run_available``
drains a source into a file sink, which commits exactly once per batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmill.plans.silver import TRIP_KEYS, YEAR, derive_trips, enrich_trips, tag_trips


def stream_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream over the files below ``path``, a folder or a pattern (a lone file needs a pattern)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def clean_and_tag(trips: DataFrame, zones: DataFrame, year: int = YEAR) -> DataFrame:
    """Tag, derive and enrich against a static lookup; keeps no state."""
    return enrich_trips(derive_trips(tag_trips(trips, year)), zones)


def hourly_totals(stream: DataFrame, at: str, keys: Sequence[str], metrics: Iterable[Column], delay: str) -> DataFrame:
    """Totals per hour and key.

    ``delay`` is how late a row may arrive; the state holds the hours within it. In
    append mode an hour is published once the watermark has passed it; with
    ``run_totals`` open hours are published too, and corrected as rows arrive.
    """
    grouped = stream.withWatermark(at, delay).groupBy(F.window(at, "1 hour").alias("_hour"), *keys)
    return grouped.agg(*metrics).withColumn("hour_start", F.col("_hour.start")).drop("_hour")


def first_arrivals(
    stream: DataFrame,
    keys: Sequence[str] = TRIP_KEYS,
    at: str = "pickup_datetime",
    within: str = "366 days",
    spread: int = 0,
) -> DataFrame:
    """One row per key: the first to arrive, not the earliest submission.

    ``within`` bounds the state. The default covers the one year that the date
    rules accept, so no accepted row is ever too late.

    All copies of a key meet in one task. Where a key may have very many,
    ``spread`` thins them first: copies are deduplicated within that many slices
    of the input partitions, and only the survivors meet. A slice follows the
    partition number, which a retried task keeps.
    """
    marked = stream.withWatermark(at, within)
    if spread:
        marked = marked.withColumn("_slice", F.spark_partition_id() % spread)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what the source holds now, then stop; returns the written table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_totals(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Like ``run_available`` for totals: also hours still open when the source is drained.

    Each batch writes the totals it changed to a folder of its own, which a repeated
    batch replaces; the latest total of each key counts.
    """

    def publish(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rest = [c for c in stream.columns if c not in keys]
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    written = stream.sparkSession.read.schema(schema).parquet(path)
    latest = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_latest"))
    return latest.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])
