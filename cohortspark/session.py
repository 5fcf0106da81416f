"""Session helper shared by the tests, the benchmark and command-line use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A single-machine session; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortspark")
        .config("spark.driver.memory", os.environ.get("COHORTSPARK_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
