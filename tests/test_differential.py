"""Every registered query against its reference SQL in another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tripmill.queries import QUERIES

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_reference_sql():
    assert set(QUERIES) <= set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, sf_dir, duck, name):
    assert differences(contract.queries()[name](spark, sf_dir), duck, SQL[name]) == []


def test_flagship(spark):
    assert contract.entry(spark).limit(1).count() == 1


# joins as they run when no side is small enough to broadcast
SHUFFLED = [
    "agg_daily_borough",
    "dq_relationships",
    "fact_trips",
    "fk_orphans",
    "funnel_counts",
    "orders_daily_region_trends",
    "segment_share",
    "star_join_holiday",
]


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
SPLIT_ALL = {
    **NO_BROADCAST,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}


@pytest.fixture
def settings(spark):
    """Sets session values for one test."""
    before = {}

    def change(values):
        for key, value in values.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", SHUFFLED)
def test_same_result_without_broadcasts(spark, sf_dir, duck, name, settings):
    settings(NO_BROADCAST)
    assert differences(contract.queries()[name](spark, sf_dir), duck, SQL[name]) == []


@pytest.mark.parametrize("name", ["fact_trips", "segment_share", "star_join_holiday"])
def test_same_result_with_every_partition_split_as_skewed(spark, sf_dir, duck, name, settings):
    settings(SPLIT_ALL)
    assert differences(contract.queries()[name](spark, sf_dir), duck, SQL[name]) == []
