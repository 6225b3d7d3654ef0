"""Quality classification with supervised subword embeddings.

Every word, pair of neighbouring words and byte n-gram of a text is hashed to a bucket with a
learned vector. A text is the average of its vectors; a softmax over it gives the classes. Vectors
and softmax are trained by stochastic gradient descent in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm import sample
from sentrel.llm.shingles import BASE, blocks, mix, text_buffers, word_hashes

REPEATED = np.uint64(0x5851F42D4C957F2D)
CASED_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled rows of a class that training reads."""

    per_class: int = 1500
    bucket_bits: int = 17
    dimensions: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 4
    rate: float = 0.5
    threshold: float = 0.7


def ngram_buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at every byte but the last n-1."""
    if len(data) < n:
        return np.zeros(0, dtype=np.uint32)
    code = np.full(len(data) - n + 1, n, dtype=np.uint32)
    for k in range(n):
        code *= np.uint32(0x01000193)
        code ^= data[k : len(data) - n + 1 + k]
    code *= np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - bits)


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings):
    """Kinds of features over a block of texts: buckets, and first and last bucket of each text."""
    shift = np.uint64(64 - settings.bucket_bits)
    words, at = word_hashes(data, offsets, CASED_VALUES)
    yield (words >> shift).astype(np.uint32), at[:-1], at[1:]
    # Any word followed by itself is one feature of its own: repetition looks alike in all words.
    pairs = np.where(words[:-1] == words[1:], REPEATED, mix(words[:-1] * BASE + words[1:]))
    last = np.maximum(at[1:] - 1, at[:-1])
    yield (pairs >> shift).astype(np.uint32), np.minimum(at[:-1], len(pairs)), np.minimum(last, len(pairs))
    for n in settings.ngrams:
        found = ngram_buckets(data, n, settings.bucket_bits)
        last = np.maximum(offsets[1:] - n + 1, offsets[:-1])
        yield found, np.minimum(offsets[:-1], len(found)), np.minimum(last, len(found))


class Model:
    """``weights[bucket]`` is what a feature adds to the log odds of each class but the first."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, settings: Settings) -> None:
        self.weights, self.bias, self.settings = weights, bias, settings

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """Class probabilities of every row; without a feature they are the bias alone."""
        data, offsets = text_buffers(column)
        out = np.zeros((len(offsets) - 1, len(self.bias)))
        with np.errstate(over="ignore"):
            for first, last in blocks(offsets):
                part = offsets[first : last + 1]
                sums = np.zeros((last - first, len(self.bias) - 1))
                count = np.zeros(last - first)
                own = data[part[0] : part[-1]]
                for found, begin, end in features(own, part - part[0], self.settings):
                    count += end - begin
                    for c in range(sums.shape[1]):
                        total = np.zeros(len(found) + 1)
                        np.cumsum(self.weights[found, c], out=total[1:])
                        sums[:, c] += total[end] - total[begin]
                out[first:last, 1:] = sums / np.maximum(count, 1)[:, None]
        out += self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def feature_counts(column: pa.Array, settings: Settings) -> Iterator[tuple[bytes, bytes]]:
    """Distinct buckets of every row as uint32, and their shares of its features as float32."""
    data, offsets = text_buffers(column)
    with np.errstate(over="ignore"):
        for i in range(len(offsets) - 1):
            own = data[offsets[i] : offsets[i + 1]]
            found = [x for x, _, _ in features(own, np.array([0, len(own)]), settings)]
            buckets, counts = np.unique(np.concatenate(found), return_counts=True)
            share = counts / max(counts.sum(), 1)
            yield buckets.astype("<u4").tobytes(), share.astype("<f4").tobytes()


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, settings: Settings) -> Model:
    """Train on (class, buckets, shares); every epoch draws as many rows of each class present."""
    rng = np.random.default_rng(7)
    size = 1 << settings.bucket_bits
    vectors = np.empty((size, settings.dimensions), dtype=np.float32)
    for start in range(0, size, 4096):
        part = vectors[start : start + 4096]
        part[:] = rng.uniform(-1, 1, part.shape).astype(np.float32) / settings.dimensions
    output = np.zeros((classes, settings.dimensions), dtype=np.float32)
    bias = np.zeros(classes, dtype=np.float32)
    by_class = [[i for i, row in enumerate(rows) if row[0] == c] for c in range(classes)]
    most = max((len(x) for x in by_class), default=0)
    rounds = settings.epochs * max(1, -(-400 // max(most, 1)))
    steps = rounds * most * sum(bool(x) for x in by_class)
    done = 0
    for _ in range(rounds if steps else 0):
        drawn = np.concatenate([rng.permutation(np.resize(x, most)) for x in by_class if x])
        for i in rng.permutation(drawn):
            label, buckets, shares = rows[i]
            rate = settings.rate * (1 - done / steps)
            done += 1
            own = vectors[buckets]
            hidden = shares @ own
            scores = output @ hidden + bias
            scores = np.exp(scores - scores.max())
            error = scores / scores.sum()
            error[label] -= 1
            back = output.T @ error
            output -= rate * np.outer(error, hidden)
            bias -= 0.05 * rate * error
            # The average moves by the rate whatever the number of features.
            vectors[buckets] = own - (rate * len(buckets) * 0.05) * np.outer(shares, back)
    weights = vectors @ (output[1:] - output[0]).T
    return Model(weights.astype(np.float32), (bias - bias[0]).astype(np.float64), settings)


def train(
    docs: DataFrame, labels: DataFrame, column: str, modulus: int, remainder: int,
    settings: Settings = Settings(),
) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class outside the held-out fold."""
    known = sample.agreed_labels(labels, column, modulus, remainder)
    chosen = {value: sample.draw(known, value, settings.per_class) for value in (0, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = list(feature_counts(batch.column("text"), settings))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()), batch.column("label"),
                    pa.array([x for x, _ in counted], pa.binary()),
                    pa.array([x for _, x in counted], pa.binary()),
                ],
                names=["doc_id", "label", "buckets", "shares"],
            )

    found = sample.with_texts(docs, chosen).mapInArrow(
        run, "doc_id string, label int, buckets binary, shares binary"
    ).toArrow().sort_by("doc_id")
    held = [arrays(found.column(name), kind) for name, kind in (("buckets", "<u4"), ("shares", "<f4"))]
    model = fit(list(zip(found.column("label").to_pylist(), *held)), 2, settings)
    # The driver lives on long after training: what the sample took goes back to the system.
    del found, held
    pa.default_memory_pool().release_unused()
    return model


def arrays(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    """The rows of a binary column as arrays that share its memory."""
    whole = column.cast(pa.large_binary()).combine_chunks()
    _, ends, data = whole.buffers()
    if data is None:
        return [np.zeros(0, kind)] * len(column)
    ends = np.frombuffer(ends, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return [np.frombuffer(data, kind, (b - a) // 4, a) for a, b in zip(ends[:-1], ends[1:])]


def score_documents(docs: DataFrame, model: Model, modulus: int, remainder: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row's whole text.

    Null and empty texts get the score of the bias alone; repeated rows give repeated rows; other
    columns are not read. Without any labelled row every score is 0.5.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            score = own.probabilities(batch.column("text"))[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        sample.fold(modulus, remainder).alias("held_out"), "text",
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= model.settings.threshold).cast("int")
    )



def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns, in one pass."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            score = own.probabilities(batch.column("text"))[:, 1]
            yield batch.filter(pa.array(score >= own.settings.threshold))

    return docs.mapInArrow(run, docs.schema)
