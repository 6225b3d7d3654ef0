"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split into several tasks once its size is known.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State of streams grows and shrinks one entry at a time.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Rows differ in length by orders of magnitude: batches for Python are cut by their bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on; all of them can change at run time."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors are the driver itself uses its warehouse;
    elsewhere that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Cuts lineage in a way that outlives executors, and gives later stages real sizes for
    choosing join strategies and columnar pruning.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
