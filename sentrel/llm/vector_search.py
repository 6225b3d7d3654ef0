"""Nearest neighbours by randomly rotated one-bit codes.

A unit vector is rotated at random and kept as the signs of its components, packed to bits, with
one correction scalar: its inner product with its own code. The product of a query with the code,
divided by that scalar, estimates the query's cosine without bias, within an error whose bound
follows from the scalar. Only vectors whose upper bound reaches the k-th best lower bound are
compared on the original numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages, sorted_groups
from sentrel.llm.vectors import cosines, matrix, unit, with_raw


@dataclass(frozen=True)
class Settings:
    """``width`` is the error bound in standard deviations of an estimate."""

    nearest: int = 5
    width: float = 3.0
    query_block: int = 2048
    block: int = 4096
    seed: int = 5


@lru_cache(maxsize=4)
def rotation(dimensions: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0]


def encode(directions: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, and each vector's product with its code."""
    turned = directions @ rotation(directions.shape[1], seed)
    own = np.abs(turned).sum(axis=1) / np.sqrt(directions.shape[1])
    return np.packbits(turned > 0, axis=1), own


def estimates(
    codes: np.ndarray, own: np.ndarray, queries: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of every query with every code, and the bound on each code's error."""
    d = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = (queries @ rotation(d, settings.seed)).astype(np.float32) / np.float32(np.sqrt(d))
    estimate = (turned @ signs.T) / own.astype(np.float32)
    spread = np.sqrt(np.maximum(1 - own * own, 0)) / own / np.sqrt(max(d - 1, 1))
    return estimate, (settings.width * spread + 1e-6).astype(np.float32)


def search(rows: DataFrame, is_query, vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every query row, nearest first.

    ``is_query`` is a condition on ``vec_id``. Score is the cosine of the original vectors in
    double precision; ties go to the smaller ``vec_id``. A query meets every usable row of its own
    length but those that bear its own ``vec_id``. Vectors that are null, empty, zero or hold null
    or non-finite components, and rows without ``vec_id``, take no part. Rows equal in ``vec_id``
    and vector count once; of rows that share a ``vec_id`` with different vectors, each is a
    candidate, and the one of smallest bytes is the query. Fewer candidates give fewer rows.

    Queries and candidates are dealt into blocks of bounded size and every pair of blocks is one
    group; a group returns the k best of each of its queries.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "vector-search")
    base = with_raw(rows, vector).where(F.col("raw").isNotNull() & F.col("vec_id").isNotNull())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            codes: list = [None] * len(raw)
            own = np.zeros(len(raw))
            sizes = np.array([len(x) for x in raw])
            for size in np.unique(sizes):
                place = np.flatnonzero(sizes == size)
                directions = unit(np.frombuffer(b"".join(raw[i] for i in place), "<f8").reshape(len(place), -1))[0]
                packed, own[place] = encode(directions, settings.seed)
                for i, bits in zip(place, packed):
                    codes[i] = bits.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("raw"), pa.array(codes, pa.binary()), pa.array(own)],
                names=["vec_id", "raw", "bits", "own"],
            )

    coded = stages.write(
        base.dropDuplicates(["vec_id", "raw"])
        .mapInArrow(code, "vec_id long, raw binary, bits binary, own double")
        .withColumn("size", F.length("raw"))
    )
    queries = coded.where(is_query).groupBy("vec_id", "size").agg(F.min("raw").alias("raw"))
    candidates, asked = coded.count(), queries.count()
    blocks = max(1, -(-candidates // settings.block))
    query_blocks = max(1, -(-asked // settings.query_block))

    def dealt(df: DataFrame, count: int, name: str, others: int, other: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "raw"), F.lit(count)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        )

    columns = ["size", "query_block", "block", "asks", "vec_id", "raw", "bits", "own"]
    pairs = dealt(coded, blocks, "block", query_blocks, "query_block").withColumn(
        "asks", F.lit(False)
    ).select(columns).unionByName(
        dealt(queries, query_blocks, "query_block", blocks, "block")
        .withColumns({"asks": F.lit(True), "bits": F.lit(None).cast("binary"), "own": F.lit(None).cast("double")})
        .select(columns)
    )

    def compare(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        asks = group.column("asks").to_numpy()
        if asks.all() or not asks.any():
            return
        ids = group.column("vec_id").to_numpy()
        # Smaller ids first, so that a stable sort settles ties.
        order = np.argsort(ids[~asks], kind="stable")
        mine = group.filter(pa.array(~asks)).take(pa.array(order))
        vec_ids = mine.column("vec_id").to_numpy()
        vectors = matrix(mine.column("raw"))
        packed = np.frombuffer(b"".join(mine.column("bits").to_pylist()), np.uint8).reshape(len(mine), -1)
        own = mine.column("own").to_numpy()
        asked_ids = ids[asks]
        asked_vectors = matrix(group.filter(pa.array(asks)).column("raw"))
        directions, scaled = unit(asked_vectors)
        vectors = unit(vectors)[1]
        found: list[tuple[np.ndarray, ...]] = []
        k = settings.nearest
        for start in range(0, len(asked_ids), 256):
            part = slice(start, start + 256)
            estimate, bound = estimates(packed, own, directions[part], settings)
            itself = asked_ids[part][:, None] == vec_ids[None, :]
            lower = np.where(itself, -np.inf, estimate - bound)
            place = max(len(vec_ids) - k, 0)
            reach = np.partition(lower, place, axis=1)[:, place] if len(vec_ids) > k else np.full(len(lower), -np.inf)
            query, candidate = np.nonzero((estimate + bound >= reach[:, None]) & ~itself)
            score = np.concatenate(
                [np.zeros(0)] + [
                    cosines(scaled[part][query[s : s + 65536]], vectors[candidate[s : s + 65536]])
                    for s in range(0, len(query), 65536)
                ]
            )
            best = np.lexsort((vec_ids[candidate], -score, query))
            query, candidate, score = query[best], candidate[best], score[best]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            keep = rank < k
            found.append((asked_ids[part][query[keep]], vec_ids[candidate[keep]], score[keep]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)],
            names=["query_id", "vec_id", "score"],
        )

    best = sorted_groups(
        pairs, ["size", "query_block", "block"], compare, "query_id long, vec_id long, score double"
    )

    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).where(
        F.col("rank") <= settings.nearest
    ).select("query_id", "rank", "vec_id", "score")
