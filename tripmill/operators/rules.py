"""First-match rejection rules, the accepted/rejected split, and its counts."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


class Rule(NamedTuple):
    """Rows for which ``fails`` is true are rejected with ``reason``."""

    reason: str
    fails: Column


def first_reason(rules: Iterable[Rule]) -> Column:
    """Reason of the first failing rule, NULL if none fails.

    A condition that is NULL does not fail: unknown values pass unless a rule
    tests for NULL itself (see ``unknown_rules``).
    """
    chain = None
    for rule in rules:
        step = F.when if chain is None else chain.when
        chain = step(rule.fails, F.lit(rule.reason))
    return F.lit(None).cast("string") if chain is None else chain.otherwise(F.lit(None).cast("string"))


def unknown_rules(columns: Iterable[str]) -> list[Rule]:
    """Optional strict rules: reject rows whose listed columns are NULL."""
    return [Rule(f"missing_value: {name}", F.col(name).isNull()) for name in columns]


def tag_rejects(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds one reason per row. Map-only, so both halves can be written from one scan shape."""
    return df.withColumn(REASON, first_reason(rules))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def reject_profile(tagged: DataFrame) -> DataFrame:
    return rejected(tagged).groupBy(REASON).agg(F.count(F.lit(1)).alias("row_count"))


def union_rejects(*parts: DataFrame) -> DataFrame:
    """Quarantine from several rule stages; columns a stage lacks become NULL."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def funnel(tagged: DataFrame, keys: list[str], first_stage: Iterable[str]) -> DataFrame:
    """Raw, first-stage rejects, later rejects, duplicates and surviving rows, in one pass.

    Only the dedup keys and the reason are shuffled. Rejected rows drop their
    keys before grouping, so each reason collapses to one row per map task, and
    copies of an accepted key are counted map-side rather than moved.
    """
    passes = F.col(REASON).isNull()
    stage = F.when(passes, F.lit(0)).when(F.col(REASON).isin(list(first_stage)), F.lit(1)).otherwise(F.lit(2))
    # the key columns of accepted rows only
    slots = [F.when(passes, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    groups = (
        tagged.select(stage.alias("_stage"), *slots)
        .groupBy("_stage", *[f"_k{i}" for i in range(len(keys))])
        .agg(F.count(F.lit(1)).alias("_n"))
    )

    def rows_of(code: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_stage") == code, F.col("_n"))), F.lit(0))

    kept = F.count_if(F.col("_stage") == 0)
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_rows"),
        rows_of(1).alias("date_rejects"),
        rows_of(2).alias("rule_rejects"),
        (rows_of(0) - kept).alias("dupes_removed"),
        kept.alias("silver_rows"),
    )
