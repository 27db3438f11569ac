"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS``
the timed runs per query after one warm-up run; the median is reported.
``BENCH_QUERIES`` may list query names, or ``all``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINE = [
    "funnel_counts",
    "reject_profile",
    "dedup_keep_first",
    "fact_trips",
    "agg_hourly_zone",
    "agg_daily_borough",
    "agg_payment_trends",
    "wow_calendar",
    "star_join_holiday",
    "dq_unique",
    "dq_relationships",
    "b1_evening_weekday_zones",
    "b2_cash_by_month",
    "b3_third_quarter_growth",
    "b4_airport_revenue_per_mile",
    "b5_weekend_hour_durations",
    "b6_friday_evening_zones",
    "b7_growth_since",
    "b8_payment_share_by_month",
    "orders_daily_region_trends",
    "lineitem_dedup",
    "shipdate_causality",
    "events_hourly_type",
    "segment_share",
    "medallion_quality",
    "layout_range",
    "stream_hourly_events",
]


def run_once(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tripmill.queries import QUERIES
    from tripmill.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else (asked.split() or HEADLINE)

    spark = local_session(cores, "tripmill-bench")
    seconds = {}
    for name in names:
        run_once(QUERIES[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run_once(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
