"""Table writes that can be repeated without changing the result.

The table format is an argument: Parquet here, another Spark format where its
jar is present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.session import fresh_folder
from tripmill.sinks.layout import balanced

FORMAT = "parquet"


def write_table(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Full replace."""
    df.write.format(fmt).mode("overwrite").save(path)


def save_as_table(df: DataFrame, name: str, fmt: str = FORMAT) -> None:
    """Full replace of a catalog table."""
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def publish_view(df: DataFrame, name: str) -> None:
    """A staging view: no data is written."""
    df.createOrReplaceTempView(name)


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    order: Sequence[str] = (),
    replace: str = "touched",
    fmt: str = FORMAT,
    gather: bool = True,
) -> None:
    """Partitioned overwrite.

    ``touched`` replaces only the partitions present in ``df``, so writing the
    same month again leaves the same table; ``all`` replaces the table.

    With ``gather``, rows are brought together by partition and first order
    column and sorted before writing, which keeps the number of files down,
    while adaptive execution splits partitions that are too large for one task.
    Without it there is no shuffle: right for rows read from a table that is
    already laid out by the same partitions.
    """
    if replace not in ("touched", "all"):
        raise ValueError(f"replace is 'touched' or 'all', not {replace!r}")
    laid_out = balanced(df, [*by, *order[:1]]).sortWithinPartitions(*by, *order) if gather else df
    mode = "dynamic" if replace == "touched" else "static"
    laid_out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).save(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder is there; any other trouble is an error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a table's folder, where there is one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def gathered(df: DataFrame, column: str) -> DataFrame:
    """Rows of a small table brought together by partition, so that each has few files."""
    return balanced(df, [column])


def set_aside(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows written to a new folder and read back: what a table that is overwritten is computed from."""
    path = fresh_folder(spark, "aside")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, parts: Sequence[str], fmt: str = FORMAT) -> None:
    """Replaces the named partitions by the rows of ``df``, also by nothing at all.

    A dynamic overwrite leaves a partition without new rows as it was: those whose files
    still have their old names afterwards are emptied.
    """
    spark = df.sparkSession

    def files() -> set[str]:
        table = spark.read.format(fmt).schema(df.schema).load(path)
        return set(table.where(F.col(column).isin(list(parts))).select(column).inputFiles())

    before = files() if exists(spark, path) else set()
    write_partitions(df, path, [column], replace="touched", fmt=fmt, gather=False)
    left = before & files() if before else before
    for part in parts:
        if any(f"/{column}={part}/" in name for name in left):
            clear_leaf(spark, df.schema, path, column, part, fmt)


def write_leaf(df: DataFrame, path: str, column: str, value: str, fmt: str = FORMAT) -> None:
    """Replace one partition folder, also by nothing at all.

    A dynamic overwrite never touches a partition without new rows; this does.
    """
    df.drop(column).write.format(fmt).mode("overwrite").save(f"{path}/{column}={value}")


def clear_leaf(spark: SparkSession, schema: StructType, path: str, column: str, value: str, fmt: str = FORMAT) -> None:
    write_leaf(spark.createDataFrame([], schema), path, column, value, fmt)


def append_record(spark: SparkSession, path: str, record: dict, schema: StructType, fmt: str = FORMAT) -> None:
    """One log row; names are checked against the schema."""
    row = spark.range(1).select(*[F.lit(record[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])
    row.coalesce(1).write.format(fmt).mode("append").save(path)
