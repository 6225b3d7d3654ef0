"""Local Spark session for tests and measurements."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from sentrel.session import configure


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sentrel")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.enabled", "false")
        # Call-site capture costs a round trip per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
