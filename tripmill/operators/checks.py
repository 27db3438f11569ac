"""Declarative data-quality checks, row assertions and the gate."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.metrics import count_where


class QualityGateError(RuntimeError):
    """Raised when a check finds failing rows; carries the report."""

    def __init__(self, message: str, report: DataFrame | None = None):
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    fails: Column | None = field(default=None, compare=False)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check("unique", table, c) for c in columns]


def accepted_values(table: str, column: str, values: Iterable) -> list[Check]:
    return [Check("accepted_values", table, column, values=tuple(values))]


def relationship(table: str, column: str, parent: str, parent_column: str) -> list[Check]:
    return [Check("relationships", table, column, parent=parent, parent_column=parent_column)]


def assertion(table: str, name: str, fails: Column) -> list[Check]:
    """A named row test; the name takes the place of the column in the report."""
    return [Check("assertion", table, name, fails=fails)]


def _failing(check: Check) -> Column:
    column = F.col(check.column) if check.kind != "assertion" else None
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))  # NULL is neither in nor out: it passes
    return check.fails


def _report_line(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        failures.cast("bigint").alias("failures"),
    )


def row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of one table in a single aggregate pass."""
    counted = df.agg(*[count_where(_failing(c)).alias(f"_f{i}") for i, c in enumerate(checks)])
    lines = F.array(*[_report_line(c, F.col(f"_f{i}")) for i, c in enumerate(checks)])
    return counted.select(F.inline(lines))


def unique_check(df: DataFrame, check: Check) -> DataFrame:
    """Number of values that occur more than once; NULLs are left out."""
    copies = df.where(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count(F.lit(1)).alias("_n"))
    counted = copies.agg(F.count_if(F.col("_n") > 1).alias("_f"))
    return counted.select(F.inline(F.array(_report_line(check, F.col("_f")))))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values without a parent, with the number of child rows; NULL keys are left out.

    Child keys are counted before the join, so a hot key crosses the shuffle as
    one row per map task and the anti-join sees each key once.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(parent_column).alias("_parent_key"))
    return keys.join(known, F.col(column) == F.col("_parent_key"), "left_anti")


def relationship_checks(child: DataFrame, checks: list[Check], parents: Mapping[str, DataFrame]) -> DataFrame:
    """All foreign keys of one table in a single pass over it.

    Each row yields its known keys tagged with their check; counting them before
    the join leaves one row per distinct key. Keys are compared in the parent's type;
    one that the type cannot hold stands as it is, and so has no parent.
    """

    def key(c: Check) -> Column:
        value = F.col(c.column)
        fitted = value.try_cast(parents[c.parent].schema[c.parent_column].dataType)
        same = fitted.try_cast(child.schema[c.column].dataType) == value
        return F.when(same, fitted.cast("string")).otherwise(value.cast("string"))

    tagged = [F.struct(F.lit(i).alias("fk"), key(c).alias("key")) for i, c in enumerate(checks)]
    keys = (
        child.select(F.inline(F.array(*tagged)))
        .where(F.col("key").isNotNull())
        .groupBy("fk", "key")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = [
        parents[c.parent].select(F.lit(i).alias("fk"), F.col(c.parent_column).cast("string").alias("key"))
        for i, c in enumerate(checks)
    ]
    lost = keys.join(reduce(DataFrame.unionByName, known), ["fk", "key"], "left_anti")
    counted = lost.agg(*[F.sum(F.when(F.col("fk") == i, F.col("_n"))).alias(f"_f{i}") for i in range(len(checks))])
    lines = [_report_line(c, F.coalesce(F.col(f"_f{i}"), F.lit(0))) for i, c in enumerate(checks)]
    return counted.select(F.inline(F.array(*lines)))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One report row per check: (check, table, column, failures).

    A table is read once for its row-level checks, once for its foreign keys,
    and once per unique column.
    """
    by_row: dict[str, list[Check]] = defaultdict(list)
    by_key: dict[str, list[Check]] = defaultdict(list)
    reports = []
    for check in checks:
        if check.kind == "unique":
            reports.append(unique_check(tables[check.table], check))
        elif check.kind == "relationships":
            by_key[check.table].append(check)
        else:
            by_row[check.table].append(check)
    reports += [relationship_checks(tables[name], group, tables) for name, group in by_key.items()]
    reports += [row_checks(tables[name], group) for name, group in by_row.items()]
    return reduce(DataFrame.unionByName, reports)


def failing_rows(df: DataFrame, fails: Column, columns: Iterable[str], reason: str) -> DataFrame:
    """The rows an assertion objects to, with the reason."""
    return df.where(fails).select(*columns, F.lit(reason).alias("failure_reason"))


def enforce(report: DataFrame) -> None:
    """Stop the run if any check failed. The report has one row per declared check."""
    broken = report.where(F.col("failures") > 0).collect()
    if broken:
        raise QualityGateError(
            "; ".join(f"{r['check']} on {r['table']}.{r['column']}: {r['failures']}" for r in broken), report
        )
