from __future__ import annotations

import datetime as dt

import pytest

from tripmill.functions import metrics as M
from tripmill.operators.rules import REASON
from tripmill.plans import silver as V
from tripmill.sources.schemas import BRONZE_TRIPS
from tripmill.streaming import trips as S


@pytest.fixture
def landed(spark, bronze, tmp_path):
    """Writes each batch of rows as its own folder of files and returns a stream over them."""

    def land(*batches, per_batch=1):
        for i, rows in enumerate(batches):
            bronze(*rows).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
        return S.stream_files(spark, str(tmp_path / "in" / "*"), BRONZE_TRIPS, per_batch)

    return land


def run(stream, tmp_path):
    return S.run_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).collect()


def at(day, hour=10, **more):
    start = dt.datetime(2024, 3, day, hour)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=30), **more}


def test_clean_and_tag_equals_the_batch_result(landed, zones, bronze, tmp_path):
    rows = [at(1), at(2, fare_amount=-1.0), at(3, PULocationID=24)]
    streamed = run(S.clean_and_tag(landed(rows[:2], rows[2:]), zones), tmp_path)
    batch = S.clean_and_tag(bronze(*rows), zones).collect()

    def shape(found):
        return sorted((r.pickup_datetime, r[REASON], r.pickup_borough, r.total_cost) for r in found)

    assert shape(streamed) == shape(batch)


def test_hours_are_published_once_the_watermark_passes(landed, tmp_path):
    stream = V.parse_times(landed([at(1, 8), at(1, 8), at(1, 9)], [at(1, 12)]))
    timed = stream.selectExpr("*", "cast(pickup_datetime as timestamp) as at")
    totals = S.hourly_totals(
        timed, "at", ["PULocationID"], [M.rows().alias("trips"), M.total("fare_amount").alias("fares")], "1 hour"
    )
    rows = sorted((r.hour_start.hour, r.trips, r.fares) for r in run(totals, tmp_path))
    assert rows == [(8, 2, 40.0), (9, 1, 20.0)]  # the hour of 12 is still open


@pytest.mark.parametrize("spread", [0, 4])
def test_first_arrival_survives_across_batches(landed, tmp_path, spread):
    copies = [at(1, tip_amount=float(i)) for i in range(20)]
    stream = V.parse_times(landed([*copies, at(2)], [at(1, tip_amount=99.0), at(3)]))
    timed = stream.selectExpr("*", "cast(pickup_datetime as timestamp) as at")
    rows = run(S.first_arrivals(timed, at="at", spread=spread), tmp_path)
    assert sorted(r.pickup_datetime.day for r in rows) == [1, 2, 3]
    assert "_slice" not in rows[0].asDict()


def test_a_drained_source_can_be_resumed(spark, landed, bronze, tmp_path):
    stream = V.tag_trips(landed([at(1)]))
    assert len(run(stream, tmp_path)) == 1
    bronze(at(2)).coalesce(1).write.parquet(str(tmp_path / "in" / "b9"))
    assert len(run(V.tag_trips(landed()), tmp_path)) == 2
