"""Schema alignment and conforming projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def conform(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select in order: new name to a column or SQL expression of the source."""
    return df.selectExpr(*[name if name == source else f"{source} as {name}" for name, source in mapping.items()])


#: Holds, as a JSON text of column to value, what did not fit a row's target types.
RESCUE = "rescued_values"


def _fitted(name: str, have: DataType, target: DataType) -> tuple[Column, Column]:
    """The value in the target type, and whether it is the same value there."""
    raw = F.col(name)
    if have == target:
        return raw, F.lit(True)
    if isinstance(target, StringType):
        nested = isinstance(have, (ArrayType, MapType, StructType))
        return (F.to_json(raw) if nested else raw.cast(target)), F.lit(True)
    numbers = isinstance(have, NumericType) and isinstance(target, NumericType)
    direct = numbers or isinstance(have, (StringType, DateType, TimestampType, TimestampNTZType))
    # types that do not convert directly meet as text
    value = (raw if direct else raw.cast("string")).try_cast(target)
    same = value.isNotNull()
    if numbers:  # a fraction cut off, or digits lost, is another value
        same = same & F.coalesce(value.try_cast(have) == raw, F.lit(False))
    return F.when(same, value), raw.isNull() | same


def align_schema(df: DataFrame, target: StructType, extra: str = "keep", rescue: str | None = None) -> DataFrame:
    """Fit a frame to a target schema.

    Missing columns become NULL, and columns the target lacks are kept at the end,
    dropped, or refused. Differing types are converted; a value that does not fit, also
    one that would lose a fraction or digits, becomes NULL. ``rescue`` names a column
    that keeps such values: a JSON text of column to value, NULL for rows that fit. It is
    added only where types differ.
    """
    unknown = [c for c in df.columns if c not in target.names]
    if extra == "error" and unknown:
        raise ValueError(f"columns not in the target schema: {', '.join(unknown)}")
    if extra not in ("keep", "drop", "error"):
        raise ValueError(f"extra is 'keep', 'drop' or 'error', not {extra!r}")
    have = {f.name: f.dataType for f in df.schema.fields}
    out, lost = [], []
    for field in target.fields:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, fits = _fitted(field.name, have[field.name], field.dataType)
        out.append(value.alias(field.name))
        if have[field.name] != field.dataType and not isinstance(field.dataType, StringType):
            lost += [F.lit(field.name), F.when(~fits, F.col(field.name).cast("string"))]
    if extra == "keep":
        out += [F.col(c) for c in unknown]
    if rescue and lost:
        held = F.map_filter(F.create_map(*lost), lambda _, value: value.isNotNull())
        out.append(F.when(F.size(held) > 0, F.to_json(held)).alias(rescue))
    return df.select(*out)


def rescued_counts(df: DataFrame, by: Sequence[str] = (), rescue: str = RESCUE) -> DataFrame:
    """How many values of each column did not fit."""
    one = df.select(*by, F.explode(F.json_object_keys(F.col(rescue))).alias("column_name"))
    return one.groupBy(*by, "column_name").agg(F.count(F.lit(1)).alias("value_count"))


def require_columns(df: DataFrame, needed: StructType) -> DataFrame:
    """The same frame, or an error naming the columns it lacks."""
    lacking = [name for name in needed.names if name not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df
