"""Side-by-side comparison of a registered query and its reference SQL."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def differences(df, con, sql: str, show: int = 3) -> list[str]:
    """What differs, as text; empty if names, types and values agree."""
    answer = con.sql(sql)
    theirs = dict(zip(answer.columns, map(str, answer.types)))
    ours = dict(df.dtypes)
    found = []
    if set(ours) != set(theirs):
        return [f"columns: {sorted(set(ours) ^ set(theirs))}"]
    for name, kind in ours.items():
        if SAME_TYPE.get(kind, kind) != theirs[name]:
            found.append(f"type of {name}: {kind} / {theirs[name]}")
    left = canonical(df.columns, df.collect())
    right = canonical(answer.columns, answer.fetchall())
    if len(left) != len(right):
        found.append(f"rows: {len(left)} / {len(right)}")
    if left != right:
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        found.append(f"values: {len(only_left)} / {len(only_right)} rows; columns {sorted(ours)}")
        found += [f"  spark  {r}" for r in sorted(only_left, key=str)[:show]]
        found += [f"  oracle {r}" for r in sorted(only_right, key=str)[:show]]
    return found
