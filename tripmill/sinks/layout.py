"""File layout for data skipping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Brings equal keys together; adaptive execution merges small and splits large partitions."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Range layout: each output file covers a narrow range of the columns.

    A content hash follows the columns in the range key, so rows that share one
    hot value still spread over several files.
    """
    spread = F.xxhash64(*df.columns)
    keys = [*[F.col(c) for c in columns], spread]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*columns)


def interleaved(buckets: Sequence[Column], bits: int) -> Column:
    """Z-order key: the bits of the bucket numbers, interleaved.

    Numbers beyond ``bits`` bits count as the largest, negative and NULL ones as 0.
    """
    if bits * len(buckets) > 62:
        raise ValueError("the key must fit into a long")
    most = F.lit((1 << bits) - 1)
    whole = [F.greatest(F.lit(0), F.least(F.coalesce(b.cast("bigint"), F.lit(0)), most)) for b in buckets]
    parts = []
    for bit in range(bits):
        for place, bucket in enumerate(whole):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1))
            parts.append(F.shiftleft(one, bit * len(buckets) + place))
    return reduce(Column.bitwiseOR, parts)


def zordered(df: DataFrame, buckets: Mapping[str, Column], bits: int = 16, files: int | None = None) -> DataFrame:
    """Z-order layout over bucket numbers of several columns.

    Files then cover narrow ranges of every column at once rather than of the
    first one only. ``buckets`` maps a column name to its integer bucket.
    """
    keyed = df.withColumn("_zorder", interleaved(list(buckets.values()), bits))
    spread = F.xxhash64(*df.columns)
    keys = [F.col("_zorder"), spread]
    ranged = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions("_zorder", *buckets).drop("_zorder")


PREFIX = 6  # bytes of a text that order it here


def ordinal(df: DataFrame, name: str) -> Column:
    """A number that orders rows as the column does; a text by its first bytes."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (NumericType, BooleanType)):
        return value.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    digits = F.rpad(F.hex(F.substring(value.cast("string").cast("binary"), 1, PREFIX)), 2 * PREFIX, "0")
    return F.conv(digits, 16, 10).cast("double")


def quantile_edges(df: DataFrame, columns: Sequence[str], bits: int, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Edges that part each column's rows into 2^bits buckets of about equal size, from one pass of sketches.

    A value that many rows share is several edges at once, so that bucket numbers span
    all their bits for columns of few values too.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    asked = [F.percentile_approx(ordinal(df, c), shares, accuracy).alias(c) for c in columns]
    found = df.agg(*asked).first()
    return {c: sorted(found[c] or []) for c in columns}


def bucket_of(value: Column, edges: Sequence[float], first: int = 0) -> Column:
    """How many edges lie at or below a value, by halving; 0 for NULL."""
    if not edges:
        return F.lit(first)
    half = len(edges) // 2
    low, high = bucket_of(value, edges[:half], first), bucket_of(value, edges[half + 1 :], first + half + 1)
    return F.when(value >= F.lit(edges[half]), high).otherwise(low)


def zordered_by_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    bits: int = 6,
    files: int | None = None,
    lead: Sequence[str] = (),
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Z-order layout over columns of any type, whatever their distribution.

    Buckets end at quantiles, so a skewed column still parts its rows evenly. ``lead``
    columns order before the key, as those that a table is partitioned by.
    """
    if edges is None:
        edges = quantile_edges(df, columns, bits)
    key = interleaved([bucket_of(ordinal(df, c), list(edges[c])) for c in columns], bits)
    keyed = df.withColumn("_zorder", key)
    keys = [*[F.col(c) for c in lead], F.col("_zorder"), F.xxhash64(*df.columns)]
    ranged = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*lead, "_zorder", *columns).drop("_zorder")


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file_name, <column>_low, <column>_high, row_count) of a table's files, as a reader could skip them by."""
    bounds = [f(c).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "low"), (F.max, "high"))]
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(*bounds, F.count(F.lit(1)).alias("row_count"))
