"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from tripmill.operators.rules import accepted
from tripmill.plans import pipeline as P
from tripmill.plans import silver as V
from tripmill.queries import QUERIES
from tripmill.sinks import tables as K
from tripmill.sinks.landing import land_month
from tripmill.sources.bronze import read_bronze


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# these run jobs while they are built
EAGER = re.compile("medallion|layout|stream|dq_|fk_|gold_|drifted|zorder|bucketed|star_join_quarter|catalog|gate")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not EAGER.match(n)))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in text, word


def test_year_rule_reaches_the_scan_of_bronze(spark, tmp_path, bronze, zones):
    """Rejected rows are still read for quarantine; Silver's own scan skips the other years."""
    lake = P.Lake(str(tmp_path / "lake"))
    land_month(bronze({}), lake.bronze, "2024", "03")
    tagged = V.tag_trips(read_bronze(spark, lake.bronze, "all", "2024-06-15T06:00:00"))
    kept = P._in_year(accepted(tagged), 2024)
    pushed = re.search(r"PushedFilters: \[([^\n]*)", plan(kept))[1]
    assert "tpep_pickup_datetime,2024-01-01" in pushed or "IsNull(tpep_pickup_datetime)" in pushed


def test_no_query_cuts_its_tables(spark, sf_dir):
    text = plan(QUERIES["agg_hourly_zone"](spark, sf_dir))
    assert "o_orderdate" in text and not re.search(r"(GreaterThan|LessThan)\w*\(o_orderdate", text)


def test_scans_read_only_what_is_used(spark, sf_dir):
    text = plan(QUERIES["funnel_counts"](spark, sf_dir))
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    names = {re.sub(r"#\d+L?", "", c) for scan in read for c in scan.split(",")}
    assert not names & {"l_discount", "l_tax", "l_shipdate", "l_linestatus", "l_linenumber", "o_totalprice", "c_name"}


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["dedup_keep_first"](spark, sf_dir))
    before, after = text.index("Partial"), text.index("Final")
    assert "WindowGroupLimit" in text and after < before  # the plan prints from the top


def test_both_submissions_come_from_one_scan(spark, sf_dir):
    text = plan(QUERIES["quarantine_rows"](spark, sf_dir))
    assert "Union" not in text
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem", text)) == 1


def test_each_prior_value_is_computed_once(spark, sf_dir):
    text = plan(QUERIES["wow_rows"](spark, sf_dir))
    assert text.count("lag(total_trips") == 1 and text.count("lag(total_revenue") == 1


def test_borough_windows_share_one_partitioning(spark, sf_dir):
    text = plan(QUERIES["agg_daily_borough"](spark, sf_dir))
    by_borough = re.findall(r"Exchange hashpartitioning\(pickup_borough#\d+, \d+\)", text)
    assert len(by_borough) == 1  # week-over-week and month-to-date


def test_partitions_of_written_tables_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_partitions(spark.range(100).selectExpr("id", "concat('2024-0', id % 3 + 1) m"), path, ["m"], ["id"])
    text = plan(spark.read.parquet(path).where("m = '2024-02'"))
    assert re.search(r"PartitionFilters: \[isnotnull\(m#\d+\), \(m#\d+ = 2024-02\)\]", text)
