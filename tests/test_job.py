from __future__ import annotations

from tripmill.__main__ import main
from tripmill.plans import pipeline as P


def test_steps_from_landing_to_checks(spark, bronze, zones, tmp_path):
    bronze({}, {"fare_amount": -1.0}).write.parquet(str(tmp_path / "in"))
    zones.write.csv(str(tmp_path / "zones"), header=True)
    lake = P.Lake(str(tmp_path / "lake"))
    main(["land", "--lake", lake.root, "--source", str(tmp_path / "in"), "--month", "2024-03", "--run-id", "r1"])
    main(["land-zones", "--lake", lake.root, "--source", str(tmp_path / "zones")])
    stamp = ["--run-ts", "2024-05-03T06:00:00"]
    main(["run", "--lake", lake.root, "--month", "2024-03", *stamp, "--as-of", "2024-05-03"])
    assert P.read(spark, lake, lake.gold("fact_trips")).count() == 1
    log = P.read(spark, lake, lake.run_log).collect()[0]
    assert (log.target_month, log.run_mode, log.raw_rows, log.quarantine_rows) == ("2024-03", "incremental", 2, 1)
    assert spark.read.parquet(lake.path("bronze/ingest_log")).collect()[0].run_id == "r1"
    main(["check", "--lake", lake.root])
