"""Lake tables in the catalog: read by name, with partitions that the catalog knows.

A registered table has its schema and its partitions in the catalog, so a read lists no
folders beyond the partitions it needs and looks into no footers. Partitions that
were added or removed since are registered when the table is next asked for.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, StructType

from tripmill.sinks import tables as K


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def register(spark: SparkSession, name: str, schema: StructType, path: str, by: Sequence[str] = (), fmt: str = K.FORMAT) -> None:
    """Makes the table at ``path`` known as ``name``; a table of that name is replaced, its files stay."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"drop table if exists {_quoted(name)}")
    parts = f"partitioned by ({', '.join(f'`{c}`' for c in by)})" if by else ""
    spark.sql(f"create table {_quoted(name)} ({columns}) using {fmt} {parts} location '{path}'")
    if by and K.exists(spark, path):
        spark.sql(f"msck repair table {_quoted(name)}")


def partitions(spark: SparkSession, name: str) -> set[str]:
    """The registered partitions, as ``column=value``."""
    return {row.partition for row in spark.sql(f"show partitions {_quoted(name)}").collect()}


def folders(spark: SparkSession, path: str, column: str) -> set[str]:
    """The partitions that a table's folder has: one listing of their names, of no files."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*")
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return {f.getPath().getName() for f in found or []}


def table(spark: SparkSession, name: str, schema: StructType, path: str, by: Sequence[str] = (), fmt: str = K.FORMAT) -> DataFrame:
    """The table by name, registered first where it is not yet, or not with these columns.

    Partitions that were written or removed by path since are registered or dropped.
    """
    known = spark.table(name).schema if spark.catalog.tableExists(name) else StructType([])
    kinds = [{f.name: f.dataType for f in s.fields} for s in (known, schema)]
    if kinds[0] != kinds[1]:
        register(spark, name, schema, path, by, fmt)
    elif by:
        before, now = partitions(spark, name), folders(spark, path, by[0])
        for part in sorted(before ^ now):
            column, value = part.split("=", 1)
            if not re.fullmatch(r"[\w.-]+", value):
                raise ValueError(f"not a partition name: {value!r}")
            change = "add if not exists" if part in now else "drop if exists"
            spark.sql(f"alter table {_quoted(name)} {change} partition (`{column}` = '{value}')")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str, order: Sequence[str] = ()) -> DataFrame:
    """Writes ``df`` as a table bucketed by ``keys`` and reads it back by name.

    Rows with equal keys are in one bucket, so grouping, deduplicating or joining on the
    keys needs no exchange. Choose buckets such that one fits a task's memory; the
    table's buckets must match those of the tables that it is to be joined with.
    Floating-point keys take no part in the choice of a bucket: Spark groups them by a
    normalized form that it does not recognize in a table's buckets.
    """
    own = [k for k in keys if not isinstance(df.schema[k].dataType, FractionalType) or isinstance(df.schema[k].dataType, DecimalType)]
    if not own:
        raise ValueError("a key that is no floating-point number is needed")
    laid_out = df.repartition(buckets, *[F.col(k) for k in own])
    writer = laid_out.write.format(K.FORMAT).mode("overwrite").option("path", path).bucketBy(buckets, own[0], *own[1:])
    writer.sortBy(*(order or keys)).saveAsTable(name)
    return df.sparkSession.table(name)


def copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often; without an exchange on a table bucketed by them."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") > 1)
