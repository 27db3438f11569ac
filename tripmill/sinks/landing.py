"""Landing months and the lookup in Bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.operators.schema import require_columns
from tripmill.sinks.layout import balanced
from tripmill.sinks.tables import append_record, drop_table, set_aside
from tripmill.sources.bronze import TRIP_FILE, month_paths, trip_file
from tripmill.sources.schemas import BRONZE_TRIPS, INGEST_LOG


def landed_rows(spark: SparkSession, root: str, months: str | list[str]) -> int:
    """Rows in the landed files, answered from Parquet footers."""
    return spark.read.schema(BRONZE_TRIPS).parquet(*month_paths(root, months)).count()


def land_month(df: DataFrame, root: str, year: str, month: str) -> int:
    """Copies one month unchanged into Bronze and returns the rows copied.

    The folder is the one that ``land_months`` uses, so a month landed both ways is
    there once. Rows are counted in what was written: an accumulator could count a task
    twice when an executor is lost.
    """
    name = f"{year}-{month}"
    require_columns(df, BRONZE_TRIPS).write.mode("overwrite").parquet(f"{root}/trip_file={trip_file(name)}")
    return landed_rows(df.sparkSession, root, name)


def land_months(df: DataFrame, root: str, month_column: str = "source_month") -> None:
    """Lands every month of a frame in one job, replacing the months it holds.

    Columns that nobody declared land as well; only the month column becomes the name,
    after the shuffle, which carries the shorter of the two.
    """
    head, tail = TRIP_FILE.split("{month}")
    months = balanced(require_columns(df, BRONZE_TRIPS), [month_column])
    named = months.withColumn("trip_file", F.concat(F.lit(head), F.col(month_column), F.lit(tail)))
    (
        named.drop(month_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trip_file")
        .parquet(root)
    )


def take_month(spark: SparkSession, root: str, month: str, schema: StructType) -> DataFrame:
    """Takes a landed month out of Bronze; returns its rows, kept in a folder of their own."""
    name = trip_file(month)
    landed = spark.read.schema(StructType([*schema.fields, StructField("trip_file", StringType())])).parquet(root)
    rows = set_aside(spark, landed.where(F.col("trip_file") == name).drop("trip_file"))
    drop_table(spark, f"{root}/trip_file={name}")
    return rows


def land_lookup(zones: DataFrame, path: str) -> None:
    """Copies the lookup once; an existing copy is left alone."""
    zones.write.mode("ignore").csv(path, header=True)


def log_ingest(spark: SparkSession, path: str, month: str, rows_copied: int, run_id: str) -> None:
    record = {
        "pipeline_name": "ingest_trips",
        "target_month": month,
        "rows_copied": rows_copied,
        "run_id": run_id,
        "status": "Succeeded",
    }
    append_record(spark, path, record, INGEST_LOG)
