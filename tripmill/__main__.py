"""Job entry: ``spark-submit -m`` style commands over one lake.

    python -m tripmill land --lake /lake --source /landing/2024-01 --month 2024-01 --run-id 7
    python -m tripmill land-zones --lake /lake --source /landing/zones.csv
    python -m tripmill silver --lake /lake --month 2024-01 --run-ts 2024-03-03T06:00:00
    python -m tripmill gold --lake /lake --run-ts 2024-03-03T06:00:00 --as-of 2024-03-03
    python -m tripmill check --lake /lake
    python -m tripmill run --lake /lake --month 2024-01 --run-ts ... --as-of ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tripmill.plans import pipeline as P
from tripmill.plans.silver import YEAR
from tripmill.session import pin_session
from tripmill.sinks import landing as L
from tripmill.sources.bronze import ALL_MONTHS, read_lookup


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripmill")
    steps = parser.add_subparsers(dest="step", required=True)
    options = {
        "land": ["source", "month", "run-id"],
        "land-zones": ["source"],
        "silver": ["month", "mode", "run-ts", "year"],
        "gold": ["run-ts", "as-of", "year"],
        "check": [],
        "run": ["month", "mode", "run-ts", "as-of", "year"],
    }
    settings = {
        "month": {"default": ALL_MONTHS},
        "mode": {"default": "incremental", "choices": ["incremental", "full"]},
        "year": {"type": int, "default": YEAR},
        "run-id": {"default": ""},
    }
    for step, names in options.items():
        one = steps.add_parser(step)
        one.add_argument("--lake", required=True)
        one.add_argument("--format", default=P.K.FORMAT)
        for name in names:
            one.add_argument(f"--{name}", **settings.get(name, {"required": True}))
    return parser


def main(given: list[str] | None = None) -> None:
    args = arguments().parse_args(given)
    spark = SparkSession.builder.appName(f"tripmill-{args.step}").getOrCreate()
    pin_session(spark)
    lake = P.Lake(args.lake, args.format)
    if args.step == "land":
        year, month = args.month.split("-")
        copied = L.land_month(spark.read.parquet(args.source), lake.bronze, year, month)
        L.log_ingest(spark, lake.path("bronze/ingest_log"), args.month, copied, args.run_id)
        print(f"{copied} rows landed")
    elif args.step == "land-zones":
        L.land_lookup(read_lookup(spark, args.source), lake.lookup)
    elif args.step == "silver":
        print(P.run_silver(spark, lake, args.month, args.mode, args.run_ts, args.year))
    elif args.step == "gold":
        P.build_gold(spark, lake, args.run_ts, args.as_of, args.year)
    elif args.step == "check":
        P.check_run(spark, lake)
    else:
        print(P.run_pipeline(spark, lake, args.month, args.mode, args.run_ts, args.as_of, args.year))


if __name__ == "__main__":
    main()
