"""Session defaults for tests, benchmarks and local use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, name: str = "veritrail") -> SparkSession:
    """A local session; on a cluster, pass the cluster's own session to every function instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VERITRAIL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
