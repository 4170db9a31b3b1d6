"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app_name: str = "rowan", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session it provides."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", os.environ.get("ROWAN_SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ROWAN_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
