"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are cut into windows; in each window one network reads forwards and one backwards, a softmax
over both states labels every byte, and the label probabilities of all bytes of a text are pooled.
The network is trained in numpy by backpropagation through time on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm import sample
from sentrel.llm.shingles import text_buffers

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    """``per_language`` and ``windows`` bound the documents and their stretches that training reads."""

    per_language: int = 300
    windows: int = 8
    width: int = 64
    hidden: int = 8
    batch: int = 128
    steps: int = 400
    rate: float = 0.01
    seed: int = 3


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights: input ``x`` (256, 3H), state ``u`` (H, 3H) for each direction, and the output."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.weights = weights

    @classmethod
    def fresh(cls, classes: int, hidden: int, rng: np.random.Generator) -> Network:
        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32)

        weights = {}
        for way in ("f", "b"):
            weights[f"x{way}"] = draw(256, 3 * hidden)
            weights[f"u{way}"] = draw(hidden, 3 * hidden)
        weights["o"] = draw(2 * hidden, classes)
        weights["c"] = np.zeros(classes, dtype=np.float32)
        return cls(weights)

    def states(self, way: str, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """State after every byte, in reading order of the direction: (time, window, H)."""
        x, u = self.weights[f"x{way}"], self.weights[f"u{way}"]
        hidden = u.shape[0]
        n, width = windows.shape
        state = np.zeros((n, hidden), dtype=np.float32)
        out = np.empty((width, n, hidden), dtype=np.float32)
        for t in range(width):
            at = t if way == "f" else width - 1 - t
            own = x[windows[:, at]]
            mixed = state @ u
            gates = _sigmoid(own[:, : 2 * hidden] + mixed[:, : 2 * hidden])
            update, reset = gates[:, :hidden], gates[:, hidden:]
            inner = mixed[:, 2 * hidden :]
            fresh = np.tanh(own[:, 2 * hidden :] + reset * inner)
            before = state
            state = fresh + update * (before - fresh)
            out[at] = state
            if keep is not None:
                keep.append((at, before, update, reset, inner, fresh))
        return out

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Label probabilities of every byte: (time, window, class)."""
        both = np.concatenate((self.states("f", windows), self.states("b", windows)), axis=2)
        scores = both @ self.weights["o"] + self.weights["c"]
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return scores

    def gradients(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> dict:
        """Gradient of the mean cross entropy over all bytes, by backpropagation through time."""
        w = self.weights
        hidden = w["uf"].shape[0]
        steps = {"f": [], "b": []}
        both = np.concatenate(
            [self.states(way, windows, steps[way]) for way in ("f", "b")], axis=2
        )
        scores = both @ w["o"] + w["c"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        error = scores / scores.sum(axis=2, keepdims=True)
        error[:, np.arange(len(labels)), labels] -= 1
        valid = np.arange(windows.shape[1])[:, None] < lengths[None, :]
        error *= (valid / max(valid.sum(), 1))[:, :, None].astype(np.float32)
        flat = error.reshape(-1, error.shape[2])
        out = {"o": both.reshape(-1, 2 * hidden).T @ flat, "c": flat.sum(axis=0)}
        back = error @ w["o"].T
        for k, way in enumerate(("f", "b")):
            u = w[f"u{way}"]
            gx, gu = np.zeros_like(w[f"x{way}"]), np.zeros_like(u)
            carried = np.zeros((len(labels), hidden), dtype=np.float32)
            for at, before, update, reset, inner, fresh in reversed(steps[way]):
                down = carried + back[at, :, k * hidden : (k + 1) * hidden]
                d_fresh = down * (1 - update) * (1 - fresh * fresh)
                d_update = down * (before - fresh) * update * (1 - update)
                d_reset = d_fresh * inner * reset * (1 - reset)
                d_mixed = np.concatenate((d_update, d_reset, d_fresh * reset), axis=1)
                d_own = np.concatenate((d_update, d_reset, d_fresh), axis=1)
                np.add.at(gx, windows[:, at], d_own)
                gu += before.T @ d_mixed
                carried = down * update + d_mixed @ u.T
            out[f"x{way}"], out[f"u{way}"] = gx, gu
        return out


def fit(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, classes: int, settings: Settings) -> Network:
    """Adam over batches that draw every language alike."""
    rng = np.random.default_rng(settings.seed)
    network = Network.fresh(classes, settings.hidden, rng)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    by_class = [np.flatnonzero(labels == c) for c in range(classes)]
    present = [x for x in by_class if len(x)]
    for step in range(1, settings.steps + 1):
        share = -(-settings.batch // len(present))
        rows = np.concatenate([rng.choice(x, share) for x in present])
        gradients = network.gradients(windows[rows], lengths[rows], labels[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients.values()))
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        for name, g in gradients.items():
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            move = first[name] / (1 - 0.9**step)
            network.weights[name] -= (
                rate * move / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
            ).astype(np.float32)
    return network


def cut(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over whole texts, padded at the end: bytes, valid lengths, row of each window."""
    sizes = np.diff(offsets)
    counts = -(-sizes // width)
    row = np.repeat(np.arange(len(sizes)), counts)
    begin = offsets[:-1][row] + (np.arange(len(row)) - (np.cumsum(counts) - counts)[row]) * width
    length = np.minimum(offsets[1:][row] - begin, width)
    index = begin[:, None] + np.arange(width)[None, :]
    windows = data[np.minimum(index, max(len(data) - 1, 0))] if len(row) else np.zeros((0, width), np.uint8)
    return np.where(np.arange(width)[None, :] < length[:, None], windows, 0), length, row


def pooled(network: Network, column: pa.Array, width: int) -> np.ndarray:
    """Mean label probabilities over all bytes of every row; rows without bytes have zeros."""
    data, offsets = text_buffers(column)
    classes = len(network.weights["c"])
    total = np.zeros((len(offsets) - 1, classes))
    windows, lengths, row = cut(data, offsets, width)
    step = 4096
    for start in range(0, len(row), step):
        part = slice(start, start + step)
        found = network.probabilities(windows[part])
        found *= (np.arange(width)[:, None] < lengths[None, part])[:, :, None]
        np.add.at(total, row[part], found.sum(axis=0))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def train(
    docs: DataFrame, modulus: int, remainder: int, settings: Settings = Settings()
) -> tuple[list[str], Network | None]:
    """Fit on at most ``per_language`` documents of each language outside the held-out fold.

    Documents labelled ``und`` teach nothing. Of rows that share ``doc_id`` and ``lang`` one text
    counts, that of smallest digest.
    """
    spark = docs.sparkSession
    known = docs.select("doc_id", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
        & (F.col("lang") != UNDETERMINED) & ~sample.fold(modulus, remainder)
    )
    # Rows of one document share a place.
    place = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    picked = known.withColumn("place", F.dense_rank().over(place)).where(
        F.col("place") <= settings.per_language
    ).select("doc_id", "lang").distinct().collect()
    languages = sorted({row["lang"] for row in picked})
    if not languages:
        return [], None
    chosen = spark.createDataFrame(picked, known.schema)
    width = settings.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, parts = [], [], []
            data, offsets = text_buffers(batch.column("text"))
            for i, (doc_id, lang) in enumerate(
                zip(batch.column("doc_id").cast(pa.string()).to_pylist(), batch.column("lang").to_pylist())
            ):
                own = data[offsets[i] : offsets[i + 1]]
                last = max(len(own) - width, 0)
                for begin in np.unique(np.linspace(0, last, settings.windows).astype(int)):
                    stretch = own[begin : begin + width].tobytes()
                    if stretch:
                        ids.append(doc_id)
                        langs.append(lang)
                        parts.append(stretch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                names=["doc_id", "lang", "stretch"],
            )

    # The chosen side is the sample itself, bounded by per_language.
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    rows = sample.one_text(texts, "doc_id", "lang").mapInArrow(
        run, "doc_id string, lang string, stretch binary"
    ).collect()
    rows = sorted({(r["doc_id"], r["lang"], bytes(r["stretch"])) for r in rows})
    if not rows:
        return [], None
    windows = np.zeros((len(rows), width), dtype=np.uint8)
    for i, (_, _, stretch) in enumerate(rows):
        windows[i, : len(stretch)] = np.frombuffer(stretch, np.uint8)
    lengths = np.array([len(r[2]) for r in rows])
    labels = np.array([languages.index(r[1]) for r in rows])
    return languages, fit(windows, lengths, labels, len(languages), settings)


def identify(
    docs: DataFrame, languages: list[str], network: Network | None, modulus: int, remainder: int,
    settings: Settings = Settings(),
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row's whole text.

    A null text, a text without a letter, and any text when nothing was learned are ``und`` with
    score 0. Repeated rows give repeated rows; other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((languages, network.weights if network else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        own = Network(weights) if weights else None
        for batch in batches:
            texts = batch.column("text")
            letters = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
            if own is None or not letters.any():
                best, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            else:
                found = pooled(own, texts, settings.width)
                top = found.argmax(axis=1)
                best = [names[k] if ok else UNDETERMINED for k, ok in zip(top, letters)]
                score = np.where(letters, np.clip(found[np.arange(len(top)), top], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), sample.fold(modulus, remainder).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
