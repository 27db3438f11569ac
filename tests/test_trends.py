from __future__ import annotations

import datetime as dt

import pytest

from tripmill.operators import trends as T

D = dt.date(2024, 1, 1)


def days(spark, counts, segment="a"):
    """{day of January: count} as rows of one segment."""
    return spark.createDataFrame(
        [(segment, D + dt.timedelta(days=d - 1), n) for d, n in counts.items()], "s string, d date, n long"
    )


def test_row_and_calendar_lag_differ_after_a_gap(spark):
    counts = {d: d * 10 for d in [*range(1, 5), *range(6, 21)]}
    df = days(spark, counts)
    by_row = {r.d.day: r.p for r in T.prior_period(df, ["s"], "d", {"n": "p"}, 7).collect()}
    by_day = {r.d.day: r.p for r in T.prior_period(df, ["s"], T.day_number("d"), {"n": "p"}, 7, "calendar").collect()}
    assert by_row[7] is None and by_row[8] is None and by_row[9] == 10  # seven rows before the 9th is the 1st
    assert by_day[8] == 10 and by_day[9] == 20 and by_day[12] is None  # the 5th is missing
    assert {d for d in counts if by_row[d] != by_day[d]} == {8, 9, 10, 11, 12}


def test_percent_change_and_prior(spark):
    df = days(spark, {1: 10, 2: 0, 3: 5, 4: 10})
    out = T.period_over_period(df, ["s"], "d", {"n": "chg"}, 1, keep_prior={"n": "was"}).orderBy("d").collect()
    assert [(r.was, r.chg) for r in out] == [(None, None), (10, -100.0), (0, None), (5, 100.0)]
    assert "_prior_n" not in T.period_over_period(df, ["s"], "d", {"n": "chg"}, 1).columns


def test_null_segment_is_its_own_partition(spark):
    df = days(spark, {1: 1, 2: 2}, None).unionByName(days(spark, {1: 10, 2: 20}))
    out = {(r.s, r.d.day): r.p for r in T.prior_period(df, ["s"], "d", {"n": "p"}, 1).collect()}
    assert out == {(None, 1): None, (None, 2): 1, ("a", 1): None, ("a", 2): 10}


def test_running_totals_restart_with_the_segment(spark):
    df = days(spark, {30: 1, 31: 2, 32: 3, 33: 4}).selectExpr("*", "trunc(d, 'month') m", "n * 0.1D x")
    out = T.running_total(df, ["s", "m"], "d", {"n": "total"}, {"x": "amount"}).orderBy("d").collect()
    assert [(r.total, r.amount) for r in out] == [(1, 0.1), (3, 0.3), (3, 0.3), (7, 0.7)]


def test_equal_values_share_a_rank(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", None)], "s string, n long").selectExpr("*", "1 g")
    out = {r.s: r.r for r in T.rank_within(df, ["g"], {"n": "r"}).collect()}
    assert out == {"a": 1, "b": 1, "c": 3, "d": 4}


def test_shares(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5), ("z", 0)], "g string, n long")
    out = sorted((r.g, r.n, r.share) for r in T.share_of(df, ["g"], "n", "share").collect())
    assert out == [("x", 1, 33.3), ("x", 2, 66.7), ("y", 5, 100.0), ("z", 0, None)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        T.prior_period(days(spark, {1: 1}), ["s"], "d", {"n": "p"}, 7, "weeks")


def test_months_cross_the_year(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 1), 1), (dt.date(2024, 1, 1), 2)], "d date, n long")
    out = T.prior_period(df, [], T.month_number("d"), {"n": "p"}, 1, "calendar").orderBy("d").collect()
    assert [r.p for r in out] == [None, 1]


def test_top_k_is_a_take_ordered_plan(spark):
    df = days(spark, {1: 3, 2: 9, 3: 9})
    top = T.top_k(df, 2, df.n.desc(), "d")
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r.d.day for r in top.collect()] == [2, 3]
