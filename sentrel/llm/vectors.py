"""Vectors as raw bytes, with the ones that cannot be compared taken out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raw_vectors(column: pa.Array) -> list[bytes | None]:
    """Little-endian doubles of every row; None for null, empty, zero or non-finite vectors."""
    out: list[bytes | None] = []
    for item in column.to_pylist():
        if not item or None in item:
            out.append(None)
            continue
        vector = np.asarray(item, dtype="<f8")
        usable = np.isfinite(vector).all() and vector.any()
        # Minus zero is zero: equal vectors have equal bytes.
        out.append((vector + 0.0).tobytes() if usable else None)
    return out


def with_raw(rows: DataFrame, vector: str) -> DataFrame:
    """``vec_id, raw`` of every row; ``raw`` is null where the vector takes no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(raw_vectors(batch.column("vector")), pa.binary())],
                names=["vec_id", "raw"],
            )

    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector")
    ).mapInArrow(run, "vec_id long, raw binary")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Raw vectors of one length as a matrix of doubles."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)


def unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions, and the rows scaled by a power of two, exactly, so that squares stay finite."""
    scaled = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), scaled


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of every row of ``a`` with the same row of ``b``, in double precision."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
