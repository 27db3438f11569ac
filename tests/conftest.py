from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tripmill.session import local_session, pin_session  # noqa: E402
from tripmill.sources.schemas import BRONZE_TRIPS, ZONE_LOOKUP  # noqa: E402

DATA = os.environ.get("TRIPMILL_TEST_DATA", "/root/testdata")
SF = os.environ.get("TRIPMILL_TEST_SF", "0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tripmill-tests", **{"spark.checkpoint.dir": made})
    pin_session(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{DATA}/sf{SF}"
    if not os.path.isdir(path):
        pytest.skip(f"no test tables at {path}")
    return path


@pytest.fixture
def lake_root(tmp_path):
    return str(tmp_path / "lake")


GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 3, 5, 10, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 3, 5, 10, 30),
    "passenger_count": 1,
    "trip_distance": 5.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
}


@pytest.fixture
def bronze(spark):
    """Builds Bronze rows from overrides of one good trip."""

    def build(*overrides: dict, **shared):
        rows = [tuple({**GOOD, **shared, **o}[n] for n in BRONZE_TRIPS.names) for o in overrides]
        return spark.createDataFrame(rows, BRONZE_TRIPS)

    return build


@pytest.fixture
def zones(spark):
    rows = [
        (1, "Manhattan", "Midtown Center", "Yellow Zone"),
        (2, "Queens", "JFK Airport", "Airports"),
        (3, "EWR", "Newark Airport", "EWR"),
        (4, "Brooklyn", "Park Slope", "Boro Zone"),
    ]
    return spark.createDataFrame(rows, ZONE_LOOKUP)
