"""Left joins to lookups: role-playing enrichment and the star join.

No broadcast is forced. Spark broadcasts a lookup only if its size is below
``spark.sql.autoBroadcastJoinThreshold``; a larger one takes the shuffled join,
where adaptive execution splits hot keys (the left side of a left join can be
split).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unique_lookup(lookup: DataFrame, key: str) -> DataFrame:
    """The lookup, failing at run time if a key occurs twice.

    A repeated key would multiply the rows on the left side of a join. The test
    sits inside the join key, so no optimiser rule can prune it away.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(key))
    message = F.concat(F.lit(f"duplicate lookup key in {key}: "), F.col(key).cast("string"))
    checked = F.when(copies > 1, F.raise_error(message)).otherwise(F.col(key))
    return lookup.where(F.col(key).isNotNull()).withColumn("_checked", checked).drop(key).withColumnRenamed(
        "_checked", key
    )


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    key: str,
    columns: Mapping[str, str],
    check: bool = True,
) -> DataFrame:
    """Adds lookup columns (source name to new name); rows without a match keep NULLs."""
    side = unique_lookup(lookup, key) if check else lookup
    side = side.select(F.col(key).alias("_lookup_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(side, F.col(on) == F.col("_lookup_key"), "left").drop("_lookup_key")


def enrich_role(
    df: DataFrame, lookup: DataFrame, on: str, key: str, role: str, columns: Mapping[str, str], check: bool = True
) -> DataFrame:
    """The same lookup under a role: its columns are named ``<role>_<name>``."""
    return enrich(df, lookup, on, key, {c: f"{role}_{n}" for c, n in columns.items()}, check)


def star_join(fact: DataFrame, *dimensions: tuple[DataFrame, str, str, Mapping[str, str]]) -> DataFrame:
    """Left joins of a fact to dimensions given as (table, fact column, key, columns)."""
    for table, on, key, columns in dimensions:
        fact = enrich(fact, table, on, key, columns)
    return fact
