"""Near-duplicate vectors: sign hashing in several tables, exact cosines, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.components import components, forest
from sentrel.llm.stages import Stages, sorted_groups
from sentrel.llm.vectors import cosines, matrix, unit, with_raw


@dataclass(frozen=True)
class Settings:
    """A pair of cosine 0.95 shares a bucket of some table with probability 0.998."""

    cosine: float = 0.95
    tables: int = 20
    bits: int = 12
    block: int = 1024
    seed: int = 11


def sign_codes(directions: np.ndarray, settings: Settings) -> np.ndarray:
    """Bucket of every vector in every table: the signs of its products with random planes."""
    rng = np.random.default_rng(settings.seed)
    planes = rng.standard_normal((directions.shape[1], settings.tables * settings.bits))
    signs = (directions @ planes > 0).reshape(len(directions), settings.tables, settings.bits)
    return (signs * (1 << np.arange(settings.bits))).sum(axis=2).astype(np.int32)


def link_vectors(vectors: DataFrame, stages: Stages, settings: Settings) -> DataFrame:
    """``node, root, links`` from every block of every bucket.

    ``vectors`` has ``node, copies, raw``. A pair counts in the first table where its codes meet,
    so the links of a node add up over blocks. Buckets of more than ``block`` vectors are cut
    into blocks that meet two at a time, in different tasks.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("raw").to_pylist()
            codes: list = [None] * len(raw)
            sizes = np.array([len(x) for x in raw])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                rows = np.frombuffer(b"".join(raw[i] for i in own), "<f8").reshape(len(own), -1)
                for i, found in zip(own, sign_codes(unit(rows)[0], settings)):
                    codes[i] = found.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("raw"),
                 pa.array(codes, pa.list_(pa.int32()))],
                names=["node", "copies", "raw", "codes"],
            )

    coded = stages.write(
        vectors.mapInArrow(code, "node long, copies long, raw binary, codes array<int>")
    )
    keys = ["size", "place", "code"]
    spread = coded.select(F.length("raw").alias("size"), "*", F.posexplode("codes").alias("place", "code"))
    crowded = stages.write(
        spread.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > settings.block)
    )
    parts = F.coalesce(F.ceil(F.col("n") / settings.block), F.lit(1)).cast("int")
    blocked = (
        spread.join(crowded, keys, "left").withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            *keys, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "own", "node", "copies", "raw", "codes",
        )
    )

    def compare(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(group) < 2:
            return
        _, place, _, low, high = key
        rows = matrix(group.column("raw"))
        nodes = group.column("node").to_numpy()
        copies = group.column("copies").to_numpy()
        codes = np.array(group.column("codes").to_pylist(), dtype=np.int32)[:, :place]
        directions, scaled = unit(rows)
        if low == high:
            first = second = np.arange(len(rows))
        else:
            own = group.column("own").to_numpy()
            first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        # A coarse product picks pairs; the exact cosine decides.
        coarse = directions[first] @ directions[second].T >= settings.cosine - 1e-6
        if low == high:
            coarse = np.triu(coarse, 1)
        i, j = np.nonzero(coarse)
        a, b = first[i], second[j]
        keep = nodes[a] != nodes[b]
        for t in range(codes.shape[1]):
            keep &= codes[a, t] != codes[b, t]
        a, b = a[keep], b[keep]
        links = np.zeros(len(rows), dtype=np.int64)
        kept_a, kept_b = [], []
        for start in range(0, len(a), 1 << 15):
            x, y = a[start : start + (1 << 15)], b[start : start + (1 << 15)]
            near = cosines(scaled[x], scaled[y]) >= settings.cosine
            kept_a.append(x[near])
            kept_b.append(y[near])
        if not kept_a:
            return
        a, b = np.concatenate(kept_a), np.concatenate(kept_b)
        if not len(a):
            return
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        roots = forest(a, b, nodes)
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.array(roots[some]), pa.array(links[some])],
            names=["node", "root", "links"],
        )

    return sorted_groups(
        blocked, [*keys, "low", "high"], compare, "node long, root long, links long"
    )


def near_duplicates(rows: DataFrame, vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    as do vectors of another length. Equal vectors are one class that is compared once; rows equal
    in ``vec_id`` and vector are one vector and get equal results. Rows that share a ``vec_id``
    with different vectors count as one node of the component. A row without ``vec_id`` links with
    nothing and has no component; it is kept. Other columns are not read.
    """
    stages = Stages(rows.sparkSession, "vector-dedup")
    raw = stages.write(with_raw(rows, vector).withColumn("class", F.md5("raw")))
    usable = raw.where(F.col("raw").isNotNull() & F.col("vec_id").isNotNull())
    classes = stages.write(
        usable.dropDuplicates(["class", "vec_id"]).groupBy("class").agg(
            F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"),
        )
    )
    found = stages.write(link_vectors(classes.select("node", "copies", "raw"), stages, settings))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), stages)
    results = classes.select("class", "node", "copies").join(links, "node", "left").join(
        joined, "node", "left"
    ).select(
        "class",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    whole = raw.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("class")).alias("class"))
    return whole.join(stages.write(results), "class", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
