"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on windows of ordinary text, the other on windows of toxic text that the
first one compresses badly; the second holds the first one's content too, so a window that is
shorter under it owes that to what only toxic text repeats. A text's score is a logistic function,
calibrated on labelled rows, of how many of its windows save how many bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm import sample

#: About forty bytes, up to the next space; a run without spaces is cut at eighty.
WINDOW = re.compile(rb"(?s).{1,40}[^ ]{0,40}")
SAVINGS = (1, 2, 3, 4)


@dataclass(frozen=True)
class Settings:
    """``toxic_rows`` and ``ordinary_rows`` bound the labelled rows that training reads, and
    ``sample_bytes`` the bytes of either kind: whole texts, in the order of the rows' digests, as far
    as they hold so many together. A text of more than a sixteenth of them is no sample. The ordinary
    dictionary learns from windows, in seeded random order, of ``dictionary_sample`` times its own
    size, as more of them wear its content down; all else reads every window of the sample.
    """

    toxic_rows: int = 800
    ordinary_rows: int = 1600
    sample_bytes: int = 8 << 20
    dictionary_sample: int = 50
    ordinary_bytes: int = 32768
    toxic_bytes: int = 2048
    rounds: int = 4
    gram: int = 5
    contrast: float = 6.0
    threshold: float = 0.7


def windows(text: bytes) -> list[bytes]:
    return WINDOW.findall(text)


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """Content of a dictionary; with too few samples for training, the samples themselves."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Frames without header fields, so that lengths differ by content alone."""
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    # The tables reach back over the whole dictionary.
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_BTLAZY2, window_log=17,
        hash_log=16, chain_log=17, search_log=6, min_match=4, target_length=32,
        write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def lengths(by: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    return np.array([len(by.compress(part)) for part in parts], dtype=np.int64)


def _grams(text: bytes, n: int) -> np.ndarray:
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(len(data) - n + 1, 0), dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(256) + data[k : k + len(out)]
    return out


def contrasted(content: bytes, toxic: list[bytes], ordinary: list[bytes], settings: Settings) -> bytes:
    """The stretches of a dictionary whose byte n-grams far more toxic than ordinary texts hold."""
    n = settings.gram
    own = _grams(content, n)
    if not len(own):
        return b""
    known = np.unique(own)

    def texts_with(texts: list[bytes]) -> np.ndarray:
        count = np.zeros(len(known))
        for text in texts:
            found = np.unique(_grams(text, n))
            place = np.minimum(np.searchsorted(known, found), len(known) - 1)
            count[place[known[place] == found]] += 1
        return count

    in_toxic, in_ordinary = texts_with(toxic), texts_with(ordinary)
    good = (in_toxic >= min(max(3, 0.006 * len(toxic)), len(toxic) / 2)) & (
        in_toxic / max(len(toxic), 1) > settings.contrast * (in_ordinary + 1) / (len(ordinary) + 1)
    )
    held = np.zeros(len(content) + 1, dtype=bool)
    for k in range(n):
        held[k : k + len(own)] |= good[np.searchsorted(known, own)]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], held)).astype(np.int8)))
    parts = list(dict.fromkeys(content[a:b] for a, b in zip(edges[::2], edges[1::2])))
    return b" ".join(p for p in parts if not any(p != q and p in q for q in parts))


class Model:
    """The two dictionaries and the logistic function over a text's savings."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None = None) -> None:
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        self.by_ordinary, self.by_toxic = compressor(ordinary), compressor(toxic + ordinary)

    def features(self, text: bytes) -> np.ndarray:
        """Shares and counts of windows that save so many bytes, and the number of windows."""
        parts = windows(text)
        saved = lengths(self.by_ordinary, parts) - lengths(self.by_toxic, parts)
        counts = np.array([(saved >= s).sum() for s in SAVINGS], dtype=np.float64)
        return np.concatenate((counts / max(len(parts), 1), np.log1p(counts), [np.log(max(len(parts), 1))]))

    def score(self, text: bytes) -> float:
        if self.weights is None or not text:
            return 0.0
        row = self.features(text)
        mean, scale, weights = self.weights[0, :-1], self.weights[1, :-1], self.weights[2]
        return float(1 / (1 + np.exp(-((row - mean) / scale @ weights[:-1] + weights[-1]))))


def fit(toxic: list[bytes], ordinary: list[bytes], settings: Settings = Settings()) -> Model:
    """Train both dictionaries and calibrate; without rows of both kinds every score is 0."""
    if not toxic or not ordinary:
        return Model(b"", b"")
    rng = np.random.default_rng(1)

    def parts(texts: list[bytes]) -> list[bytes]:
        distinct = sorted({w for text in texts for w in windows(text)})
        return [distinct[i] for i in rng.permutation(len(distinct))]

    toxic_parts, ordinary_parts = parts(toxic), parts(ordinary)
    upto = np.cumsum([len(p) for p in ordinary_parts])
    base = trained(
        ordinary_parts[: int(np.searchsorted(upto, settings.dictionary_sample * settings.ordinary_bytes)) + 1],
        settings.ordinary_bytes, 12,
    )
    plain = lengths(compressor(base), toxic_parts)
    share = plain / np.maximum([len(p) for p in toxic_parts], 1)
    chosen = [p for p, x in zip(toxic_parts, share) if x > np.median(share)]
    content = trained(chosen, settings.toxic_bytes, 12)
    gathered = b""
    for turn in range(settings.rounds):
        saved = plain - lengths(compressor(content + base), toxic_parts)
        chosen = [p for p, x in zip(toxic_parts, saved) if x >= (3 if turn < 2 else 2)]
        gathered = contrasted(
            gathered + b"  " + trained(chosen, settings.toxic_bytes, 12), toxic, ordinary, settings
        )
        content = gathered
    model = Model(base, gathered)
    model.weights = _calibrate(
        np.array([model.features(t) for t in toxic + ordinary]),
        np.array([1.0] * len(toxic) + [0.0] * len(ordinary)),
    )
    return model


def _calibrate(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Mean, scale and weights of a logistic regression that weighs both classes alike."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    design = np.column_stack(((rows - mean) / scale, np.ones(len(rows))))
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    fitted = np.zeros(design.shape[1])
    for _ in range(3000):
        guess = 1 / (1 + np.exp(-design @ fitted))
        fitted -= 0.5 * (design.T @ (weight * (guess - labels)) + 1e-3 * fitted)
    return np.vstack((np.append(mean, 0), np.append(scale, 1), fitted))


def train(
    docs: DataFrame, labels: DataFrame, column: str, modulus: int, remainder: int,
    settings: Settings = Settings(),
) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    known = sample.agreed_labels(labels, column, modulus, remainder)
    chosen = {1: sample.draw(known, 1, settings.toxic_rows), 0: sample.draw(known, 0, settings.ordinary_rows)}
    size = F.octet_length("text")
    # One partition for each label, of as many rows as the sample has.
    order = Window.partitionBy("label").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    rows = (
        sample.with_texts(docs, chosen).where((size > 0) & (size <= settings.sample_bytes // 16))
        .withColumn("upto", F.sum(size).over(order)).where(F.col("upto") <= settings.sample_bytes)
        .select("label", "doc_id", "text").collect()
    )
    texts = sorted({(row["label"], row["doc_id"], row["text"].encode()) for row in rows})
    return fit([t for y, _, t in texts if y == 1], [t for y, _, t in texts if y == 0], settings)


def score_documents(
    docs: DataFrame, model: Model, modulus: int, remainder: int, settings: Settings = Settings()
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row's whole text.

    Null and empty texts score 0; so does every text when no labelled row of either kind was
    found. Repeated rows give repeated rows; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.ordinary, model.toxic, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([own.score(t or b"") for t in texts], pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), sample.fold(modulus, remainder).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= settings.threshold).cast("int")
    )
