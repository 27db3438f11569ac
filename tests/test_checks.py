from __future__ import annotations

import pytest

from tripmill.operators import checks as C
from tripmill.plans import quality as Q


def report(tables, checks):
    return {(r["check"], r["column"]): r["failures"] for r in C.run_checks(tables, checks).collect()}


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", -1.0), (2, "zz", None), (None, None, 3.0), (9, "a", 1.0), (9, "a", 1.0)],
        "k int, label string, fare double",
    )
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "id int, name string")
    return {"child": child, "parent": parent}


def test_each_kind_counts_its_failures(tables):
    checks = [
        *C.not_null("child", "k", "label", "fare"),
        *C.unique("child", "k"),
        *C.accepted_values("child", "label", ["a", "b"]),
        *C.relationship("child", "k", "parent", "id"),
        *C.relationship("child", "label", "parent", "name"),
        *C.assertion("child", "fare_sign", Q.negative_fare().isNull()),
    ]
    assert report(tables, checks[:-1]) == {
        ("not_null", "k"): 1,
        ("not_null", "label"): 1,
        ("not_null", "fare"): 1,
        ("unique", "k"): 2,  # the values 1 and 9
        ("accepted_values", "label"): 1,  # NULL passes
        ("relationships", "k"): 2,  # both rows with 9; NULL passes
        ("relationships", "label"): 1,
    }


def test_clean_tables_report_zero(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    checks = [
        *C.not_null("t", "id"),
        *C.unique("t", "id"),
        *C.accepted_values("t", "name", ["a"]),
        *C.relationship("t", "id", "t", "id"),
    ]
    found = report({"t": df}, checks)
    assert len(found) == 4 and set(found.values()) == {0}
    C.enforce(C.run_checks({"t": df}, checks))


def test_empty_tables_report_zero(spark):
    df = spark.createDataFrame([], "id int, name string")
    checks = [*C.not_null("t", "id"), *C.unique("t", "id"), *C.relationship("t", "id", "t", "id")]
    assert set(report({"t": df}, checks).values()) == {0}


def test_gate_names_what_failed(tables):
    with pytest.raises(C.QualityGateError, match="unique on child.k: 2"):
        C.enforce(C.run_checks(tables, C.unique("child", "k")))


def test_orphans_count_rows_per_key(tables):
    lost = C.orphans(tables["child"], "k", tables["parent"], "id").collect()
    assert [tuple(r) for r in lost] == [(9, 2)]


def test_assertions_return_rows_with_a_reason(spark):
    fact = spark.createDataFrame(
        [("t1", -0.5, "B", 1.0), ("t2", 0.0, "B", 0.0)],
        "trip_id string, fare_amount double, pickup_borough string, trip_duration_min double",
    ).selectExpr(
        "*", "timestamp_ntz'2024-01-01 00:00:00' pickup_datetime", "timestamp_ntz'2024-01-01 00:10:00' dropoff_datetime"
    )
    bad = Q.negative_fares(fact).collect()
    assert [(r.trip_id, r.failure_reason) for r in bad] == [("t1", "negative fare in fact_trips")]
    late = Q.pickups_not_before_dropoffs(fact).collect()
    assert [(r.trip_id, r.failure_reason) for r in late] == [("t2", "causality violation: pickup >= dropoff")]


def test_declared_checks_cover_the_contract():
    kinds = [c.kind for c in Q.silver_checks() + Q.gold_checks(dropoff_too=False)]
    counted = {k: kinds.count(k) for k in set(kinds)}
    assert counted == {"not_null": 26, "unique": 4, "accepted_values": 4, "relationships": 2, "assertion": 2}
