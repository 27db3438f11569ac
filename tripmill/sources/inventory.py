"""What columns and types the files of a table have, from all of their footers.

Spark reads the footers in tasks and merges them; files whose types differ do not merge,
so paths are halved until each half does, down to single files. Homogeneous tables, the
usual case, cost one job, and each drift a few more. Groups without conflicts are then
joined again, so there are as few groups as there are kinds of files.
"""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Group = tuple[T.StructType, list[str]]

#: Numeric types from narrow to wide; beyond them there is text.
LADDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType]
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def files_of(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files below the paths, listed by Spark; folders within them are no partitions here."""
    reader = spark.read.schema("any_column int").option("recursiveFileLookup", "true")
    return sorted(reader.parquet(*paths).inputFiles())


def merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """All columns of the files, or None where their types contradict each other."""
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    try:
        return reader.parquet(*paths).schema
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e) and "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" not in str(e):
            raise
        return None


def schema_groups(spark: SparkSession, paths: list[str]) -> list[Group]:
    """The paths, or files below them, by schemas that agree in the types of shared columns."""
    return _joined(_split(spark, paths))


def _split(spark: SparkSession, paths: list[str]) -> list[Group]:
    schema = merged_schema(spark, paths)
    if schema is not None:
        return [(schema, paths)]
    parts = paths if len(paths) > 1 else files_of(spark, paths)
    half = len(parts) // 2
    return _split(spark, parts[:half]) + _split(spark, parts[half:])


def _joined(groups: list[Group]) -> list[Group]:
    whole: list[tuple[dict[str, T.DataType], list[str]]] = []
    for schema, paths in groups:
        kinds = {f.name: f.dataType for f in schema.fields}
        for known, members in whole:
            if all(known.get(name, kind) == kind for name, kind in kinds.items()):
                known.update(kinds)
                members.extend(paths)
                break
        else:
            whole.append((kinds, list(paths)))
    return [(T.StructType([T.StructField(n, k, True) for n, k in kinds.items()]), paths) for kinds, paths in whole]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the ladder that both fit: integers, decimals, doubles, then text."""
    if a == b:
        return a
    if type(a) not in LADDER or type(b) not in LADDER:
        return T.StringType()
    low, high = sorted((a, b), key=lambda t: LADDER.index(type(t)))
    if isinstance(high, T.DecimalType):
        scale = max(high.scale, low.scale if isinstance(low, T.DecimalType) else 0)
        whole = max(high.precision - high.scale, WHOLE_DIGITS.get(type(low), 0))
        if isinstance(low, T.DecimalType):
            whole = max(whole, low.precision - low.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(high, T.FloatType) and not isinstance(low, T.FloatType):
        return T.DoubleType()
    return high


def widened(groups: Iterable[Group]) -> T.StructType:
    """Every column of any group, in the type that holds the values of all."""
    kinds: dict[str, T.DataType] = {}
    for schema, _ in groups:
        for f in schema.fields:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds.items()])


def report(spark: SparkSession, groups: list[Group], declared: T.StructType) -> DataFrame:
    """(column_name, found_type, read_as, is_declared, path_count): one row a column and type found."""
    whole, counts = widened(groups), {}
    for schema, paths in groups:
        for f in schema.fields:
            key = (f.name, f.dataType.simpleString())
            counts[key] = counts.get(key, 0) + len(paths)
    rows = []
    for (name, kind), n in sorted(counts.items()):
        known = name in declared.names
        target = declared[name].dataType if known else whole[name].dataType
        rows.append((name, kind, target.simpleString(), known, n))
    return spark.createDataFrame(
        rows, "column_name string, found_type string, read_as string, is_declared boolean, path_count long"
    )
