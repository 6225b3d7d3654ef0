"""Alignment of two tokenizers: where both end a token, both id lists are cut into groups.

A text is first cut at single spaces between two characters that are not white space, where both
tokenizers always end a token: the pattern of the byte-level one starts a new match there, and no
piece of the other holds a space mark after another character. Each distinct segment is then
encoded by both, and the byte offsets at which their tokens end are intersected as hash sets: the
keys of two dictionaries from end to index. The sorted common ends slice both id lists into
groups. A link is a pair of token occurrences whose byte ranges end together, which in a slice are
those ending at its end.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages

MARK = "▁"


@dataclass(frozen=True)
class Settings:
    """``broadcast_pairs`` bounds the id pairs sent to every task; beyond it links meet their counts
    by key. A worker remembers two generations of ``keep_segments`` segments, or one batch more, of up
    to ``keep_chars`` characters.
    """

    broadcast_pairs: int = 2_000_000
    keep_segments: int = 200_000
    keep_chars: int = 48


def byte_values() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: printable ones stand for
    themselves, the others, in order, for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        # Their strings in a text are ordinary text.
        self.a.encode_special_tokens = True
        values = byte_values()
        special = {str(t.content) for t in self.a.get_added_tokens_decoder().values()}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = token.encode() if token in special else bytes(values[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        own = range(self.b.get_piece_size())
        names = [self.b.id_to_piece(i) for i in own]
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(MARK, " ").encode()
            for i, name in zip(own, names)
        ]
        self.names = [str(i) for i in range(max(size, len(names)))]
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", name) for name in names)

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = self.a.encode_batch_fast([" " + s for s in segments], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(segments, num_threads=1)

    def whole(self, segment: str, a: list[int], b: list[int]) -> bool:
        """Whether the bytes of both lists come to a space and the segment."""
        wanted = b" " + segment.encode()
        return b"".join([self.bytes_a[i] for i in a]) == wanted == b"".join([self.bytes_b[i] for i in b])


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(path_a, path_b)


def slices(a: list[int], b: list[int], bytes_a: list[bytes], bytes_b: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Byte offsets at which tokens of both lists end, and how many tokens of each end up to there."""
    ends_a = dict(zip(accumulate([len(bytes_a[x]) for x in a]), range(1, len(a) + 1)))
    ends_b = dict(zip(accumulate([len(bytes_b[x]) for x in b]), range(1, len(b) + 1)))
    for end in sorted(ends_a.keys() & ends_b.keys()):
        yield end, ends_a[end], ends_b[end]


#: A space between two characters that are not white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
ODD_SPACE = re.compile(r"\s | \s|\A | \Z")
#: Links are little-endian longs.
LINK = np.dtype("<i8")

Aligned = tuple[int, int, int, str, bytes]


class Aligner:
    """Aligns texts segment by segment; remembers a bounded number of short segments."""

    def __init__(self, path_a: str, path_b: str, settings: Settings) -> None:
        self.by, self.settings = tokenizers(path_a, path_b), settings
        # Segments met since the last change of generation, and those of the generation before.
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}

    def _aligned(self, segments: list[str]) -> list[Aligned | None]:
        """``(n_a, n_b, n_groups, groups, links)`` of each segment; None where bytes differ.

        The segments' ids are laid end to end: a segment's end is an end of both lists.
        """
        by, out = self.by, [None] * len(segments)
        ids_a, ids_b = by.encode(segments)
        good = [i for i, s in enumerate(segments) if by.whole(s, ids_a[i], ids_b[i])]
        a = [x for i in good for x in ids_a[i]]
        b = [x for i in good for x in ids_b[i]]
        size = len(by.bytes_b)
        text_a, text_b = [by.names[x] for x in a], [by.names[x] for x in b]
        groups, links = [], []
        ends = accumulate(len(segments[i].encode()) + 1 for i in good)
        border, segment, first, from_a, from_b = next(ends, None), iter(good), 0, 0, 0
        seg_a = seg_b = 0
        for end, to_a, to_b in slices(a, b, by.bytes_a, by.bytes_b):
            groups.append(f"{','.join(text_a[from_a:to_a])}|{','.join(text_b[from_b:to_b])}")
            # Tokens hold a byte or more, so only the last ones end where the slice does.
            links.append(a[to_a - 1] * size + b[to_b - 1])
            from_a, from_b = to_a, to_b
            if end == border:
                out[next(segment)] = (
                    to_a - seg_a, to_b - seg_b, len(groups) - first, ";".join(groups[first:]),
                    array("q", links[first:]).tobytes(),
                )
                border, first, seg_a, seg_b = next(ends, None), len(groups), to_a, to_b
        return out

    def align(self, texts: list[str | None]) -> list[Aligned | None]:
        """``(n_a, n_b, n_groups, groups, links)`` of each text; None where it has no tokens."""
        if len(self.known) > self.settings.keep_segments:
            self.older, self.known = self.known, {}
        cut = [self._cut(t) if t else [] for t in texts]
        short, known, older, long = self.settings.keep_chars, self.known, self.older, {}
        missing = []
        for segment in set(chain.from_iterable(cut)).difference(known):
            if segment in older:
                known[segment] = older[segment]
            else:
                missing.append(segment)
        for segment, found in zip(missing, self._aligned(missing)):
            (known if len(segment) <= short else long)[segment] = found
        out: list[Aligned | None] = []
        for own in cut:
            found = [known[s] if s in known else long[s] for s in own]
            if not found or None in found:
                out.append(None)
                continue
            n_a, n_b, n_groups, groups, links = zip(*found)
            out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)))
        return out

    def _cut(self, text: str) -> list[str]:
        if not self.by.splits:
            return [text]
        return CUT.split(text) if ODD_SPACE.search(text) else text.split(" ")


@lru_cache(maxsize=1)
def aligner_of(path_a: str, path_b: str, settings: Settings) -> Aligner:
    """Kept by a worker from task to task."""
    return Aligner(path_a, path_b, settings)


#: Texts handed to the tokenizers at once hold so many bytes together, or are one text.
BATCH_BYTES = 1 << 20


def text_blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(np.fromiter((len(t.as_py() or "") for t in batch.column("text")), np.int64, len(batch)))
    first = 0
    while first < len(batch):
        before = sizes[first - 1] if first else 0
        last = max(int(np.searchsorted(sizes, before + BATCH_BYTES, side="right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def tokens(
    docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings(), keep_groups: bool = True
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, groups_sha256, links`` of every row's whole text.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of decimal ids, null without ``keep_groups``; ``links``
    one little-endian long for each link, ``a * size of B + b``. The first tokenizer reads a space
    and the text, the second the text, to which it adds the space. Null and empty texts, and those
    whose tokens' bytes do not come to the space and the text, have no tokens: counts 0, empty
    ``groups``, digest and links. Repeated rows give repeated rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b, settings)
        none = (0, 0, 0, "", b"")
        for whole in batches:
            for batch in text_blocks(whole):
                found = [x or none for x in aligner.align(batch.column("text").to_pylist())]
                n_a, n_b, n_groups, groups, links = zip(*found)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)),
                        pa.array(groups if keep_groups else [None] * len(groups), pa.string()),
                        pa.array(digests, pa.string()), pa.array(links, pa.binary()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256", "links"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups string, groups_sha256 string, links binary"
    )


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: links of every id pair over all rows; whether no pair of its B id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("links").to_pylist())
            pair, n = np.unique(np.frombuffer(raw, LINK), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    counts = aligned.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")
    )
    most = F.max("n").over(Window.partitionBy(F.pmod("pair", F.lit(size_b))))
    return counts.withColumn("best", F.col("n") == most)


def align(
    docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings(), keep_groups: bool = True
) -> DataFrame:
    """``tokens`` without ``links``, with ``n_links, n_best, count_sum``.

    A pair's count is the number of links of all rows that hold it; ``n_best`` counts links whose
    pair is the most frequent of its B id (ties included), ``count_sum`` adds the counts up. Rows
    without tokens have zeros. Cases as for ``tokens``.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "alignment")
    size_b = len(tokenizers(path_a, path_b).bytes_b)
    aligned = stages.write(
        tokens(docs, path_a, path_b, settings, keep_groups).withColumn("row", F.monotonically_increasing_id())
    )
    counts = stages.write(pair_counts(aligned, size_b))
    n_links = (F.length("links") / 8).cast("long").alias("n_links")
    plain = [F.col(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "groups", "groups_sha256")]
    if counts.count() <= settings.broadcast_pairs:
        summed = _summed(aligned, counts)
    else:
        found = aligned.mapInArrow(_distinct, "row long, pair long, times long").join(counts, "pair")
        sums = found.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
        zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
        return aligned.join(sums, "row", "left").select(*plain, n_links, zero("n_best"), zero("count_sum"))
    return summed.select(*plain, n_links, "n_best", "count_sum")


def _summed(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts looked up in a sorted array that every task holds."""
    held = counts.toArrow().sort_by("pair")
    columns = [held.column(c).to_numpy() for c in ("pair", "n", "best")]
    shared = aligned.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counted, best = shared.value
        for batch in batches:
            raw = batch.column("links").to_pylist()
            ends = np.cumsum([0] + [len(x) // 8 for x in raw])
            place = np.searchsorted(pairs, np.frombuffer(b"".join(raw), LINK))
            sums = [np.concatenate(([0], np.cumsum(x[place], dtype=np.int64))) for x in (best, counted)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x[ends[1:]] - x[ends[:-1]]) for x in sums)],
                names=[*batch.schema.names, "n_best", "count_sum"],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema)
    return aligned.mapInArrow(run, f"{kept}, n_best long, count_sum long")


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of every row, and how many links hold each."""
    for batch in batches:
        rows = batch.column("row").to_pylist()
        for row, raw in zip(rows, batch.column("links").to_pylist()):
            pair, times = np.unique(np.frombuffer(raw, LINK), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), row)), pa.array(pair), pa.array(times)], names=["row", "pair", "times"]
            )
