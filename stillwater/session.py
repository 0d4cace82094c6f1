"""Session helpers for scripts, tests and the bench (a cluster job brings its own session)."""
from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "stillwater", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # many small plans in one session: keep their compiled code, skip call-site capture
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """All stamps in this package are UTC; text rendering depends on the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
