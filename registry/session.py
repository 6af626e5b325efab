"""A local session for tests, checks and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int, checkpoint_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("careerloom")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    builder = builder.config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="careerloom-"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
