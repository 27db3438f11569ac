"""Session helpers: local sessions for tests and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Wall-clock timestamps are read as UTC throughout.
SESSION_ZONE = "UTC"


def local_session(cores: int | str = 8, app: str = "tripmill", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # recording the Python call site of every expression slows query building
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.session.timeZone": SESSION_ZONE,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
        "spark.driver.extraJavaOptions": "-Duser.timezone=UTC",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def pin_session(spark: SparkSession) -> None:
    """Settings the pipeline depends on.

    UTC; partition values read as text (2024-01 is a month here, not a date);
    and a few open files per writing task, so that rows already grouped by
    partition are not sorted again.
    """
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tripmill-{application}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine; a cluster
    without the setting is a configuration error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder."""
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")
