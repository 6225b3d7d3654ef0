"""Run a streaming job over a stored feed to its end and return what it emitted."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.session import materialize, shared_dir


#: Files of one stretch of a feed in time order; a batch of a replay reads one stretch.
FILES = 4


def write_feed(rows: DataFrame, closing: DataFrame, ordered_by: str | None = None, every: str = "week") -> str:
    """Store a feed as a folder: its rows, then later rows that push the watermark past them.

    With ``ordered_by``, a time column, the rows come in stretches of time (of a week, say), one after
    the other; inside a stretch they have no order. Rows without a time come first.
    """
    path = f"{shared_dir(rows.sparkSession)}/feeds/{uuid.uuid4().hex}"
    if ordered_by is None:
        rows.write.parquet(path)
    else:
        stretch = F.date_trunc(every, ordered_by)
        held = materialize(rows, "feed")
        for found in held.select(stretch.alias("at")).distinct().orderBy("at").collect():
            part = held.where(stretch.eqNullSafe(F.lit(found["at"])))
            part.repartition(FILES).write.mode("append").parquet(path)
    closing.select(*rows.columns).coalesce(1).write.mode("append").parquet(path)
    return path


def replay(
    spark: SparkSession,
    feed: str,
    job: Callable[[DataFrame], DataFrame],
    files_per_batch: int = 1000,
    progress: list | None = None,
) -> DataFrame:
    """Everything the job appends until the feed is used up; ``progress`` gets each batch's report."""
    base = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    stream = (
        spark.readStream.schema(spark.read.parquet(feed).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(feed)
    )
    output = job(stream)
    running = (
        output.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    if progress is not None:
        progress.extend(json.loads(report.json) for report in running.recentProgress)
    return spark.read.schema(output.schema).parquet(f"{base}/out")
