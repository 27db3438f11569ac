from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripmill.operators.dedup import keep_first

SCHEMA = "a int, b string, month string, tip double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_earliest_month_survives(spark):
    df = spark.createDataFrame(
        [(1, "x", "2024-02", 9.0), (1, "x", "2024-01", 1.0), (2, "x", "2024-02", 5.0)], SCHEMA
    )
    assert rows_of(keep_first(df, ["a", "b"], ["month"])) == [(1, "x", "2024-01", 1.0), (2, "x", "2024-02", 5.0)]


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, None, "2024-02", 1.0), (None, None, "2024-01", 2.0)], SCHEMA)
    assert rows_of(keep_first(df, ["a", "b"], ["month"])) == [(None, None, "2024-01", 2.0)]


def test_ties_are_settled_by_content(spark):
    rows = [(1, "x", "2024-01", float(tip)) for tip in range(40)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(1 + seed)
        seen.add(tuple(rows_of(keep_first(df, ["a", "b"], ["month"]))))
    assert len(seen) == 1


def test_explicit_tie_break(spark):
    df = spark.createDataFrame([(1, "x", "2024-01", 3.0), (1, "x", "2024-01", None), (1, "x", "2024-01", 1.0)], SCHEMA)
    assert rows_of(keep_first(df, ["a", "b"], ["month"], ["tip"])) == [(1, "x", "2024-01", None)]


def test_a_key_with_very_many_copies_is_limited_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).selectExpr("cast(if(id % 3 = 0, 0, id) as int) a", "id as v")
    kept = keep_first(df, ["a"], ["v"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert kept.count() == df.select("a").distinct().count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.sampled_from(["x", "y", None]),
            st.sampled_from(["2024-01", "2024-02"]),
            st.floats(0, 3, width=16),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_result_is_unique_whole_and_stable(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    once = keep_first(df, ["a", "b"], ["month"])
    kept = rows_of(once)
    assert sorted({(r[0], r[1]) for r in rows}, key=str) == sorted([(r[0], r[1]) for r in kept], key=str)
    for a, b, month, _ in kept:
        assert month == min(r[2] for r in rows if (r[0], r[1]) == (a, b))
    assert rows_of(keep_first(once, ["a", "b"], ["month"])) == kept
