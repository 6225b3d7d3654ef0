"""Bounded, deterministic samples of labelled rows for training, and the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int, remainder: int) -> Column:
    """Whether a document is held out; a null ``doc_id`` is not."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(number, F.lit(modulus)) == remainder, F.lit(False))


def draw(labelled: DataFrame, value, per_class: int) -> list:
    """The ``doc_id`` of at most ``per_class`` rows whose class is ``value``, in hash order."""
    rows = (
        labelled.where(F.col("label") == value).select("doc_id")
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class).collect()
    )
    return [row["doc_id"] for row in rows]


def agreed_labels(labels: DataFrame, column: str, modulus: int, remainder: int) -> DataFrame:
    """``doc_id, label`` of labelled documents outside the held-out fold.

    Rows without a document or a 0/1 label count for nothing; a document labelled both ways is
    left out; a repeated label counts once.
    """
    return (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~fold(modulus, remainder))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("doc_id", "label")
    )


def one_text(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, text``: of the rows that share the keys, the text of smallest digest."""
    return rows.groupBy(*keys).agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text"))


def with_texts(docs: DataFrame, chosen: dict) -> DataFrame:
    """``doc_id, label, text`` of the chosen documents (``label -> ids``, a bounded sample).

    A document is one row, however many rows of ``docs`` bear its ``doc_id``.
    """
    rows = [(doc_id, label) for label, ids in chosen.items() for doc_id in ids]
    kind = dict(docs.dtypes)["doc_id"]
    label_kind = "string" if any(isinstance(label, str) for label in chosen) else "int"
    picked = docs.sparkSession.createDataFrame(rows, f"doc_id {kind}, label {label_kind}")
    # The picked side is the sample itself, whose size the caller bounds.
    return one_text(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "doc_id", "label")
