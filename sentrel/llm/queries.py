"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrel.llm import (
    alignment, bpe, chat, decontaminate, hard_negatives, language, line_dedup, mixing, quality,
    shingle_join, toxicity, vector_dedup, vector_search,
)
from sentrel.llm.stages import table
from sentrel.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def query(fn: Query) -> Query:
    """Register under the function's name; the session is configured before it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded again."""
    return bpe.encode_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, keep_ids=False,
    ).drop("ids")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", 4, 2)
    return quality.score_documents(docs, model, 4, 2)


@query
def op7_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    return vector_search.search(
        table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0
    )


@query
def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    languages, network = language.train(docs, 4, 2)
    return language.identify(docs, languages, network, 4, 2)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1)
    return toxicity.score_documents(docs, model, 3, 1)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many repeat an earlier run, and a digest of what stays."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5")
    )


SQL["op1_line_dedup"] = line_dedup.oracle()


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability of every document under tempered shares, and the draw.

    As its SQL has it, shares hold exactly and the largest weight is 1.
    """
    exact = mixing.Settings(keep=None)
    return mixing.probabilities(table(spark, sf_dir, "documents"), settings=exact).select(
        "doc_id", "tokens", "topic", F.round("probability", 6).alias("probability"), "sampled"
    )


SQL["op3_mixing"] = mixing.oracle()


@query
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation repaired and rendered, in ordered pieces."""
    return chat.format_conversations(table(spark, sf_dir, "conversations")).select(
        "conv_id", "place", "part", "action", "role", "cost", F.md5("rendered").alias("rendered_md5")
    )


@query
def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document at Jaccard similarity 0.75."""
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and benchmark items met of every document."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op11_decontaminate"] = decontaminate.oracle()


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives of every fiftieth vector and the hard negatives of each."""
    own, number = F.col("label"), F.col("vec_id")
    moved = F.when(number % 7 == 0, (own + 1) % 10).otherwise(own)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), number % 50 == 0, moved)


SQL["op12_hard_negatives"] = hard_negatives.oracle()


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' ids of every document."""
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False,
    ).drop("groups")
