"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages


def forest(a: np.ndarray, b: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Smallest node reachable from every place over the links a-b."""
    best = nodes.copy()
    while True:
        before = best.copy()
        np.minimum.at(best, a, best[b])
        np.minimum.at(best, b, best[a])
        if (before == best).all():
            return best


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``node, component`` of every node in ``u, v``: the smallest node its links reach.

    Each round hangs a node's larger neighbours on its smallest one, then its smaller ones; the
    number of rounds is logarithmic in the longest chain. Minima are combined before the shuffle,
    and both sides of each join come from tables, so Spark splits the rows of a hot node. Loops
    and repeated edges are harmless; a null end joins nothing. An empty table gives an empty one.
    """
    rows = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .where(F.col("u") > F.col("v")).distinct()
    )
    kind = dict(rows.dtypes)["u"]
    current = stages.write(rows.select(F.col("u").cast(kind).alias("u"), "v"))
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stages.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = stages.write(
            both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        lower = stages.write(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(lower, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        )
        following = stages.write(small)
        stages.drop(current, least, large, lower)
        current, before = following, mark
        mark = _mark(current)
        if mark == before:
            break
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select("component").distinct().select(F.col("component").alias("node"), "component")
    return stars.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them that changes when they do."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
