"""Deterministic keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tie_break: Sequence[Column | str] | None = None,
) -> DataFrame:
    """One row per key: the first by ``order``, NULL keys counting as equal.

    Rows that tie on ``order`` are settled by content: ``tie_break`` if given,
    else a 64-bit hash of every remaining column, so the survivor does not
    depend on file or task order.

    Filtering on ``row_number() = 1`` lets Spark limit each group before the
    shuffle as well as after it, so a key with very many copies sends one row
    per map task instead of all of them.
    """
    if tie_break is None:
        ordered = {c for c in order if isinstance(c, str)}
        rest = [c for c in df.columns if c not in ordered and c not in set(keys)]
        tie_break = [F.xxhash64(*rest)] if rest else []

    def sort_column(c: Column | str) -> Column:
        return F.col(c).asc_nulls_first() if isinstance(c, str) else c

    window = Window.partitionBy(*keys).orderBy(*[sort_column(c) for c in (*order, *tie_break)])
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")
