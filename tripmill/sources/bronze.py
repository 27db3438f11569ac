"""Bronze readers: monthly trip files and the zone lookup, with lineage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.operators.schema import RESCUE, align_schema
from tripmill.sources.inventory import schema_groups, widened
from tripmill.sources.schemas import BRONZE_TRIPS, ZONE_LOOKUP

# How monthly files are named, and where the month stands in a path.
TRIP_FILE = "yellow_tripdata_{month}.parquet"
MONTH_IN_PATH = r"(\d{4}-\d{2})\.parquet"

ALL_MONTHS = "all"


def trip_file(month: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}", month):
        raise ValueError(f"month is YYYY-MM, not {month!r}")
    return TRIP_FILE.format(month=month)


def month_paths(root: str, months: str | list[str]) -> list[str]:
    """Paths for every month, or for the listed ones only.

    A month may be one file, a folder of that name, or a folder written by a
    partitioned landing (``trip_file=<name>``); the leading wildcard covers all.
    """
    if months == ALL_MONTHS:
        return [f"{root}/*.parquet"]
    return [f"{root}/*{trip_file(m)}" for m in ([months] if isinstance(months, str) else months)]


def month_in(path: Column) -> Column:
    """The month a path carries: the pattern's result, mostly without the pattern.

    Where the text between the last ``_`` and the first ``.parquet`` is a month,
    it is what the pattern would find; a regular expression per row costs about
    twice as much, so it decides only the other paths.
    """
    direct = F.substring_index(F.substring_index(path, ".parquet", 1), "_", -1)
    is_month = (F.length(direct) == 7) & F.concat(direct, F.lit("-01")).try_cast("date").isNotNull()
    return F.when(is_month, direct).otherwise(F.regexp_extract(path, MONTH_IN_PATH, 1))


def with_lineage(df: DataFrame, run_ts: str) -> DataFrame:
    """Source file, the month its name carries, and the ingest time (a parameter)."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file")).withColumns(
        {
            "source_month": month_in(F.col("source_file")),
            "ingested_at": F.lit(run_ts).cast("timestamp_ntz"),
        }
    )


def found_paths(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The months that the patterns match; a pattern without any stays, and gives the usual error on reading."""
    context, paths = spark.sparkContext, []
    for pattern in patterns:
        glob = context._jvm.org.apache.hadoop.fs.Path(pattern)
        matches = glob.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(glob)
        paths += sorted(m.getPath().toString() for m in matches or []) or [pattern]
    return paths


def read_bronze(
    spark: SparkSession,
    root: str,
    months: str | list[str],
    run_ts: str,
    schema: StructType | None = BRONZE_TRIPS,
) -> DataFrame:
    """Monthly trip files with lineage.

    Columns of ``schema`` come first and with its types; columns that only some files
    have, also within a month, are kept behind them, in a type that holds the values of
    all files. Files are read by kind of schema, each kind fitted to the whole, and
    brought together by name. A value that does not fit is kept as text in
    ``rescued_values``. ``None`` stands for the declared schema as well.
    """
    target = schema or BRONZE_TRIPS
    groups = schema_groups(spark, found_paths(spark, month_paths(root, months)))
    wide = widened(groups)
    more = [f for f in wide.fields if f.name not in target.names]
    whole_schema = StructType([*target.fields, *more])
    frames = []
    for found, paths in groups:
        reader = spark.read.schema(found).option("recursiveFileLookup", "true")
        raw = with_lineage(reader.parquet(*paths), run_ts)
        frames.append(align_schema(raw, whole_schema, rescue=RESCUE))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    lineage = ["source_file", "source_month", "ingested_at"]
    rescued = [RESCUE] if RESCUE in whole.columns else []
    return whole.select(*whole_schema.names, *rescued, *lineage)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ZONE_LOOKUP).csv(path, header=True)
