"""Intermediate tables in the shared folder, table reading, and streaming of sorted groups."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.session import shared_dir

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Stages:
    """Tables one job writes to the shared folder and removes once nothing reads them."""

    def __init__(self, spark: SparkSession, job: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/stages/{job}-{uuid.uuid4().hex}"
        self._count = 0
        # By the frame's id; holding the frame keeps the id its own.
        self._held: dict[int, tuple[str, DataFrame]] = {}

    def write(self, df: DataFrame) -> DataFrame:
        """Cut the lineage: the rows survive lost executors and are computed once."""
        path = f"{self.root}/{self._count}"
        self._count += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._held[id(back)] = path, back
        return back

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            held = self._held.pop(id(frame), None)
            if held:
                where = jvm.org.apache.hadoop.fs.Path(held[0])
                where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(
                    where, True
                )

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished jobs now; else they stay until the
        driver happens to collect its garbage.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def sorted_groups(
    df: DataFrame,
    keys: list[str],
    function: Callable[[tuple, pa.Table], Iterator[pa.RecordBatch]],
    schema: str,
    order: list[str] | None = None,
) -> DataFrame:
    """Apply ``function`` to the rows of every key, many keys a task, one group in memory.

    The caller bounds the groups: a key that may be hot carries a block number.
    """
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current: tuple | None = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in keys]
            marks = list(zip(*columns))
            first = 0
            for i in range(1, len(marks) + 1):
                if i < len(marks) and marks[i] == marks[first]:
                    continue
                if current is not None and marks[first] != current:
                    yield from function(current, pa.Table.from_batches(held))
                    held = []
                current = marks[first] if first < len(marks) else current
                if i > first:
                    held.append(batch.slice(first, i - first))
                first = i
        if held:
            yield from function(current, pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def bitmap(df: DataFrame, bit, bits: int) -> bytes:
    """Bits set by the rows, as bytes of a fixed size; ``bit`` gives 0 .. bits-1."""
    place = F.lit(1) + F.pmod(bit, F.lit(bits))
    rows = (
        df.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
        .collect()
    )
    out = bytearray((bits // 32768 + 2) * 4096)
    for row in rows:
        start = (row["bucket"] - 1) * 4096
        out[start : start + 4096] = row["m"]
    return bytes(out)
