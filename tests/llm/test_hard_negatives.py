"""Hard negatives beside a plain version: every anchor scored against every row."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrel.llm import hard_negatives
from sentrel.llm.hard_negatives import Lists, Settings

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, size string"
SMALL = Settings(cells=64, spread=5, anchors=3, first_depth=1)


def plain(rows: list[tuple], each: int = 5, settings: Settings = Settings()) -> list[tuple]:
    usable = sorted(
        {(i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, y in rows
         if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    )
    out = []
    for k, (i, y, v) in enumerate(usable):
        if i % each or any(u[0] == i for u in usable[:k]):
            continue
        near = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in usable if j != i and len(w) == len(v)
        )
        for score, j, z in [n for n in near if n[2] == y][: settings.positives]:
            inside = [n for n in near if n[2] != y and 50 * -score <= 100 * -n[0] <= 95 * -score]
            out += [(i, j, r + 1, n[1], -score, -n[0]) for r, n in enumerate(inside[: settings.negatives])]
    return sorted(out)


def mined(spark, rows, settings=Settings()):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = hard_negatives.mine(table, F.col("vec_id") % 5 == 0, settings=settings)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(seed: int, n: int, d: int, labels: int = 3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, d))
    values = centres[rng.integers(4, size=n)] + 0.4 * rng.standard_normal((n, d))
    return [(i, [float(x) for x in v], int(rng.integers(labels))) for i, v in enumerate(values)]


@pytest.mark.parametrize("settings", [Settings(), SMALL])
def test_random_vectors(spark, settings):
    rows = vectors(1, 150, 6)
    assert mined(spark, rows, settings) == plain(rows) != []


def test_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)], int(rng.integers(2))) for i in range(120)]
    # A third of all rows is one vector.
    rows += [(200 + i, [1.0, 1.0, 0.0], i % 2) for i in range(60)]
    assert mined(spark, rows, SMALL) == plain(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, 40, 4, 2)
    rows += rows[:10]
    rows += [
        (None, [1.0] * 4, 1), (50, None, 1), (51, [1.0, None, 1.0, 1.0], 0), (52, [nan] * 4, 0), (53, [inf] * 4, 0),
        (54, [1.0] * 4, None), (55, [0.0] * 4, 1), (60, [], 0), (61, [], 1), (65, [1.0, 2.0], 0),
        (66, [1.0, 2.0], 0), (67, [1.0, 1.2], 1), (5, [0.5] * 4, 1), (5, [0.25] * 4, 0),
    ]
    assert mined(spark, rows) == plain(rows) == mined(spark, rows, SMALL)


def test_empty_table_and_scores_too_large(spark):
    assert mined(spark, []) == []
    with pytest.raises(Exception, match="do not fit a long"):
        mined(spark, [(0, [1e30, 1.0], 0), (1, [1e30, 1.0], 0)])


def test_reading_stops_early():
    rng = np.random.default_rng(4)
    values = rng.integers(-5, 6, (4000, 4)).astype(np.int64)
    values[100] = [900, 900, -900, 900]
    values[200] = [800, 900, -900, 900]
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            read.append(np.size(key) if isinstance(key, np.ndarray) else 0)
            return np.asarray(self)[key]

    lists = Lists(values)
    lists.values = values.view(Counted)
    (rows, scores), = lists.best(
        np.array([9, 9, -9, 9]), np.ones(4000, bool), np.array([-(2**62)]), np.array([2**62]), 2, 1
    )
    assert rows.tolist() == [100, 200] and scores.tolist() == [32400, 31500]
    assert 0 < sum(read) < 100


def test_a_window_is_filled_before_reading_stops():
    values = np.array([[10], [9], [8], [7], [6], [5], [5], [4], [1]])
    (rows, scores), = Lists(values).best(np.array([2]), np.ones(9, bool), np.array([8]), np.array([12]), 3, 1)
    assert rows.tolist() == [4, 5, 6] and scores.tolist() == [12, 10, 10]
