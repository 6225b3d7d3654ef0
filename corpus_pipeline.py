"""Corpus pipeline: five stages over ``documents``, each on all that the stage before it kept.

Each stage takes ``(spark, docs, sf_dir)``. The first four return the columns of documents; the last
returns what an encoded document comes to.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.llm import bpe, line_dedup, mixing, quality, shingle_join
from sentrel.llm.stages import Stages, table
from sentrel.session import configure


#: Columns that stages read; all others pass through whatever their names.
READ = ("doc_id", "text", "lang", "source", "topic", "n_chars")


def keeps_columns(stage: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage during which other columns have names that clash with no operator's own."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [name if name in READ else f"passed__{i}" for i, name in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    return run


@keeps_columns
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns as the query does, by fold 2 of 4."""
    configure(spark)
    labels = table(spark, sf_dir, "labels")
    return quality.reject(docs, quality.train(docs, labels, "quality", 4, 2))


@keeps_columns
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that repeat an earlier one.

    A document that such runs leave without a word goes; one that had no word before stays.
    ``n_chars`` follows the text.
    """
    configure(spark)
    columns = docs.columns
    cut = line_dedup.line_dedup(docs)
    emptied = (F.col("n_removed") > 0) & (F.regexp_count("text", F.lit(line_dedup.WORD)) == 0)
    kept = cut.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"]))
        kept = kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return kept.select(columns)


@keeps_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one of the smallest ``doc_id``.

    Rows are told apart by ``doc_id`` and text: another text of a ``doc_id`` is a row of its own. A
    row without ``doc_id`` stays where its group has no other. Texts without words all stay.
    """
    configure(spark)
    stages = Stages(spark, "near-duplicates")
    texts = stages.write(
        shingle_join.grouped(docs).where(F.col("component").isNotNull())
        .groupBy("component", "doc_id", "digest").agg(F.count(F.lit(1)).alias("many"))
    )
    best = texts.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("best")
    )
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))
    touched = stages.write(
        texts.join(best, "component").select(
            F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "many", stays.alias("stays")
        ).where(~F.col("stays") | (F.col("many") > 1))
    )
    stages.drop(texts)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (shingle_join.digest() == F.col("__digest"))
    # As many rows as copies: texts meet them by key at every size.
    kept = docs.join(touched.hint("merge"), same, "left_anti").select(docs.columns)
    repeated = touched.where("stays")
    if repeated.isEmpty():
        return kept
    row = F.struct(*docs.columns)
    first = docs.join(repeated.hint("merge"), same, "left_semi").groupBy("doc_id", shingle_join.digest()).agg(
        F.min(row).alias("__row")
    )
    return kept.unionByName(first.select("__row.*"))


@keeps_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample of documents whose tokens hold the target shares."""
    configure(spark)
    return mixing.probabilities(docs).where("sampled").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document that is left."""
    configure(spark)
    return bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("encode", encode),
]

#: The classifier, the join and the encoder have no SQL; tests run the stages beside plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder before the next one reads it."""
    configure(spark)
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
