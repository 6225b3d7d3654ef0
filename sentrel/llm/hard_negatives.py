"""Hard negatives by Fagin's threshold algorithm on integer inner products.

Each block of rows keeps, for every dimension, its rows sorted by that component. An anchor reads
the lists from the end its own component's sign prefers, all dimensions to the same depth; a row
met for the first time is scored whole. The anchor's product with the components last read bounds
every row not met yet, and reading stops once that threshold is strictly below the k-th score of
each window asked for. Blocks return their best; windows over the blocks' bests settle the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages, sorted_groups


@dataclass(frozen=True)
class Settings:
    """A negative's score lies between ``low`` and ``high`` hundredths of the positive's.

    ``cells`` bounds the components a block holds, ``spread`` is the least number of blocks of a
    table that has so many rows for each, ``anchors`` the anchors that meet a block at once.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    cells: int = 1 << 20
    spread: int = 24
    anchors: int = 4096
    first_depth: int = 8


class Lists:
    """Rows of one block, sorted by id, with their per-dimension lists."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        order = np.argsort(values, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)

    def best(
        self, anchor: np.ndarray, allowed: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, depth: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each window ``lows[i] <= score <= highs[i]`` the first ``k`` allowed rows and their scores.

        ``depth`` is how far the lists are read at first; it doubles from then on.
        """
        n = len(self.values)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            # Every score is zero and no list bounds anything: all rows are met.
            depth = n
        seen = np.zeros(n, dtype=bool)
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        read = 0
        open_windows = np.flatnonzero(lows <= highs)
        while len(open_windows) and read < n:
            until = min(n, max(depth, 2 * read))
            met = seen.copy()
            met[self.order[up, n - until : n - read].ravel()] = True
            met[self.order[down, read:until].ravel()] = True
            if until == n:
                met[:] = True
            fresh = np.flatnonzero(met & ~seen & allowed)
            seen, read = met, until
            rows = np.concatenate((rows, fresh))
            scores = np.concatenate((scores, self.values[fresh] @ anchor))
            if seen.all():
                break
            threshold = anchor[up] @ self.sorted[up, n - read] + anchor[down] @ self.sorted[down, read - 1]
            still = []
            for i in open_windows:
                inside = scores[(scores >= lows[i]) & (scores <= highs[i])]
                kth = np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else lows[i]
                if threshold >= kth:
                    still.append(i)
            open_windows = np.array(still, dtype=np.int64)
        by_id = np.argsort(rows)
        rows, scores = rows[by_id], scores[by_id]
        out = []
        for low, high in zip(lows, highs):
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            chosen = inside[np.argsort(-scores[inside], kind="stable")[:k]]
            out.append((rows[chosen], scores[chosen]))
        return out


LEAST, MOST = np.int64(-(2**62)), np.int64(2**62)


def matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), size)


def _checked(values: np.ndarray, asked: np.ndarray) -> None:
    most = int(np.abs(values).max(initial=0)) * int(np.abs(asked).max(initial=0)) * values.shape[1]
    if most >= 2**62:
        raise ValueError("inner products of these vectors do not fit a long")


def score_windows(scores: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that lies between the two shares of each positive's score."""
    return -((-settings.low * scores) // 100), (settings.high * scores) // 100


def mine(
    rows: DataFrame, is_anchor: Column, label: str | Column = "label", vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Every component ``x`` counts as ``floor(256 * x)``; a score is the inner product with the
    anchor. An anchor's positives are its first rows of the same label; for each, the first rows of
    another label whose score lies in the positive's window are returned. Higher scores come
    first, ties by smaller ``vec_id``. Rows whose ``vec_id``, label, vector or any component is null, or a
    component not finite, take no part. Rows equal in all three count once; rows that bear the
    anchor's ``vec_id`` are no candidates, and of rows that share a ``vec_id`` the smallest by label
    and vector is the anchor. Vectors meet those of their own length. A positive whose window holds
    nothing gives no row, nor does an anchor without positives or an empty table. Scores beyond
    2**62 are an error. Other columns are not read.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "hard-negatives")
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    coded = stages.write(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
            F.col(vector).cast("array<double>").alias("v"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
        .where(F.forall("v", usable))
        .withColumn("v", F.transform("v", lambda x: F.floor(x * 256)))
        .dropDuplicates(["vec_id", "label", "v"]).withColumn("size", F.size("v"))
    )
    anchors = coded.where(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "v", "size")).alias("a")
    ).select("vec_id", "a.*")
    sizes = coded.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("cells")).first()
    cells = sizes["cells"] or 0
    blocks = max(1, -(-cells // settings.cells), min(settings.spread, sizes["n"] // 256))
    ask_blocks = max(1, -(-anchors.count() // settings.anchors))

    def dealt(asked: DataFrame) -> DataFrame:
        """Every block of anchors beside every block of rows, as one group each."""
        deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        windows = asked.schema["windows"].dataType
        columns = ["size", "ask_block", "block", "asks", "vec_id", "label", "v", "windows"]
        return (
            coded.withColumns({"block": deal(blocks), "asks": F.lit(False), "windows": F.lit(None).cast(windows)})
            .withColumn("ask_block", each(ask_blocks)).select(columns)
            .unionByName(
                asked.withColumns({"ask_block": deal(ask_blocks), "asks": F.lit(True)})
                .withColumn("block", each(blocks)).select(columns)
            )
        )

    def parts(group: pa.Table, size: int):
        asks = group.column("asks").to_numpy()
        mine = group.filter(pa.array(~asks)).sort_by("vec_id")
        values, asked = matrix(mine.column("v"), size), group.filter(pa.array(asks))
        own = matrix(asked.column("v"), size)
        _checked(values, own)
        return mine.column("vec_id").to_numpy(), mine.column("label").to_numpy(), values, asked, own

    def positives(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, labels, values, asked, own = parts(group, key[0])
        if not len(asked) or not len(ids):
            return
        asked_ids, asked_labels = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
        found = []
        every = np.array([LEAST]), np.array([MOST])
        for kind in np.unique(asked_labels):
            same = np.flatnonzero(labels == kind)
            if not len(same):
                continue
            lists = Lists(values[same])
            for i in np.flatnonzero(asked_labels == kind):
                allowed = ids[same] != asked_ids[i]
                (row, score), = lists.best(own[i], allowed, *every, settings.positives, settings.first_depth)
                found.append((np.full(len(row), asked_ids[i]), ids[same][row], score))
        yield _columns(found, ["anchor_id", "positive_id", "positive_score"])

    def negatives(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, labels, values, asked, own = parts(group, key[0])
        if not len(asked) or not len(ids):
            return
        lists, found = Lists(values), []
        asked_ids, asked_labels = asked.column("vec_id").to_numpy(), asked.column("label").to_numpy()
        for i, windows in enumerate(asked.column("windows").to_pylist()):
            scores = np.array([w["positive_score"] for w in windows], dtype=np.int64)
            allowed = (labels != asked_labels[i]) & (ids != asked_ids[i])
            best = lists.best(
                own[i], allowed, *score_windows(scores, settings), settings.negatives, settings.first_depth
            )
            for window, (row, score) in zip(windows, best):
                found.append((
                    np.full(len(row), asked_ids[i]), np.full(len(row), window["place"]),
                    np.full(len(row), window["positive_id"]), np.full(len(row), window["positive_score"]),
                    ids[row], score,
                ))
        yield _columns(
            found, ["anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"]
        )

    keys = ["size", "ask_block", "block"]
    near = sorted_groups(
        dealt(anchors.withColumn("windows", F.lit(None).cast("array<int>"))), keys, positives,
        "anchor_id long, positive_id long, positive_score long",
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    windows = (
        near.withColumn("place", F.row_number().over(order).cast("long"))
        .where(F.col("place") <= settings.positives)
        .groupBy("anchor_id").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("windows"))
    )
    asked = stages.write(anchors.join(windows, anchors["vec_id"] == windows["anchor_id"]).drop("anchor_id"))
    found = sorted_groups(
        dealt(asked), keys, negatives,
        "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= settings.negatives
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _columns(found: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    columns = zip(*found) if found else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64)) for c in columns], names=names
    )


def oracle() -> str:
    """DuckDB SQL of the registered query: all anchors against all rows."""
    return """
    WITH e AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ),
    s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
    ),
    p AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, positive_id,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
      AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """
