"""Byte-level BPE encoding and decoding over length-bucketed padded numpy matrices.

Texts are cut by the pattern; every distinct piece of a batch is one row of a matrix of ranks,
in a bucket of pieces of like length. Each round looks up the rank of every neighbouring pair
through a hash table, merges each row's leftmost pair of least rank and closes the gap; rows
without a pair in the vocabulary leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Widths of the matrices; a piece goes to the narrowest that holds it.
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 128, 256)
MATRIX_CELLS = 1 << 18
#: Distinct pieces remembered by a task before it starts over.
KEEP_PIECES = 600_000
KEEP_BYTES = 32 << 20
NO_PAIR = np.int32(2**31 - 1)
SCHEMA = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
)


class Vocabulary:
    """Ranks of byte strings, and the hashed table of pairs that merge into one of them."""

    def __init__(self, path: str) -> None:
        ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.size = size
        tokens: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = tokens
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_ends = np.concatenate(([0], np.cumsum(lengths)))
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        pairs, results = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * size + right)
                    results.append(rank)
        keys = np.array(pairs, dtype=np.int64)
        self._build(keys, np.array(results, dtype=np.int32))

    def _build(self, keys: np.ndarray, results: np.ndarray) -> None:
        """Open addressing with linear probing, filled one probe distance at a time."""
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.results = np.full(1 << bits, NO_PAIR, dtype=np.int32)
        self.probes = 0
        slot = self._slot(keys)
        while len(keys):
            self.probes += 1
            free = self.keys[slot] == -1
            _, chosen = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            chosen = chosen[free[chosen]]
            self.keys[slot[chosen]] = keys[chosen]
            self.results[slot[chosen]] = results[chosen]
            rest = np.ones(len(keys), dtype=bool)
            rest[chosen] = False
            keys, results, slot = keys[rest], results[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, or NO_PAIR; an id below zero pairs with nothing."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        flat = keys.ravel()
        slot = self._slot(flat)
        out = np.full(len(flat), NO_PAIR, dtype=np.int32)
        seen = self.keys[slot]
        hit = seen == flat
        out[hit] = self.results[slot[hit]]
        left_over = np.flatnonzero(~hit & (seen != -1) & (flat >= 0))
        for _ in range(self.probes):
            if not len(left_over):
                break
            slot[left_over] = (slot[left_over] + 1) & self.mask
            seen = self.keys[slot[left_over]]
            hit = seen == flat[left_over]
            out[left_over[hit]] = self.results[slot[left_over[hit]]]
            left_over = left_over[~hit & (seen != -1)]
        return out.reshape(keys.shape)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_matrix(vocab: Vocabulary, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row of a padded matrix of byte ranks to its end; -1 pads."""
    final, ends = ids.copy(), lengths.copy()
    rows = np.arange(len(ids))
    ranks = vocab.pair_ranks(ids[:, :-1], ids[:, 1:])
    width = ids.shape[1]
    while len(rows):
        at = ranks.argmin(axis=1)
        line = np.arange(len(rows))
        best = ranks[line, at]
        done = best == NO_PAIR
        if done.any():
            stop = rows[done]
            final[stop, :width] = ids[done]
            final[stop, width:] = -1
            ends[stop] = lengths[done]
            keep = ~done
            ids, ranks, lengths, rows = ids[keep], ranks[keep], lengths[keep], rows[keep]
            at, best = at[keep], best[keep]
            if not len(rows):
                break
            line = np.arange(len(rows))
        columns = np.arange(width - 1)
        after = columns[None, :] > at[:, None]
        moved = np.empty_like(ids)
        moved[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
        moved[:, -1] = -1
        moved[line, at] = best
        ids = moved
        shifted = np.full_like(ranks, NO_PAIR)
        if width > 2:
            shifted[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
        shifted[line, at] = vocab.pair_ranks(ids[line, at], ids[line, np.minimum(at + 1, width - 1)])
        shifted[line[at + 1 >= width], at[at + 1 >= width]] = NO_PAIR
        inner = at > 0
        shifted[line[inner], at[inner] - 1] = vocab.pair_ranks(
            ids[line[inner], at[inner] - 1], ids[line[inner], at[inner]]
        )
        ranks = shifted
        lengths = lengths - 1
        longest = max(int(lengths.max()), 2)
        if longest < width:
            width = longest
            ids, ranks = np.ascontiguousarray(ids[:, :width]), np.ascontiguousarray(ranks[:, : width - 1])
    return final, ends


def merge_long(vocab: Vocabulary, piece: bytes) -> np.ndarray:
    """The same merges for one piece wider than any matrix, by a heap of pairs: n log n."""
    ids = vocab.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
    n, size, ranks, tokens = len(ids), vocab.size, vocab.ranks, vocab.tokens
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def rank(i: int) -> int | None:
        j = after[i]
        return ranks.get(tokens[ids[i]] + tokens[ids[j]]) if j < n else None

    first = vocab.pair_ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32))
    heap = [(int(r), i) for i, r in enumerate(first.tolist()) if r != NO_PAIR]
    heapify(heap)
    while heap:
        best, i = heappop(heap)
        if ids[i] < 0 or rank(i) != best:
            continue
        j = after[i]
        ids[i], ids[j] = best, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (r := rank(k)) is not None:
                heappush(heap, (r, k))
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


def encode_pieces(vocab: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one piece after the other, and the number of ids of each piece."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    counts = np.zeros(len(pieces), dtype=np.int64)
    bucket = np.searchsorted(WIDTHS, sizes)
    order: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    for i in np.flatnonzero(bucket == len(WIDTHS)):
        parts.append(merge_long(vocab, pieces[i]))
        counts[i] = len(parts[-1])
        order.append(np.array([i]))
    for k, width in enumerate(WIDTHS):
        members = np.flatnonzero(bucket == k)
        step = max(1, MATRIX_CELLS // width)
        for start in range(0, len(members), step):
            rows = members[start : start + step]
            lengths = sizes[rows]
            flat = np.frombuffer(b"".join(pieces[i] for i in rows), dtype=np.uint8)
            ids = np.full((len(rows), width), -1, dtype=np.int32)
            ids[np.arange(width)[None, :] < lengths[:, None]] = vocab.single[flat]
            merged, ends = merge_matrix(vocab, ids, lengths)
            parts.append(merged[np.arange(width)[None, :] < ends[:, None]])
            counts[rows] = ends
            order.append(rows)
    # Back from bucket order to the order of the pieces.
    if not order:
        return np.zeros(0, dtype=np.int32), counts
    sequence = np.concatenate(order)
    starts = np.concatenate(([0], np.cumsum(counts[sequence])))
    place = np.empty(len(pieces), dtype=np.int64)
    place[sequence] = np.arange(len(pieces))
    return gather(np.concatenate(parts), starts, place), counts


class Codes(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key: str | tuple) -> int:
        code = self[key] = len(self)
        return code


#: A space that white space touches, or that opens or closes the text.
ODD_SPACE = re.compile(r"\s | \s|\A | \Z")


class Encoder:
    """Encodes texts batch by batch; remembers the ids of a bounded number of words.

    The pattern never matches across a space between two characters that are not white space, so
    texts are cut there first and the pattern runs once for each distinct word. A word with its
    leading space is kept as text, anything else as a tuple. Texts with other spaces are cut by the
    pattern alone.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.vocab = vocabulary(path)
        self.find = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.codes = Codes()
        self.starts = np.zeros(1, dtype=np.int64)
        self.known = 0
        self.flat = np.zeros(0, dtype=np.int32)
        self.held = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.known > KEEP_PIECES or self.held > KEEP_BYTES:
            self._forget()
        code = self.codes.__getitem__
        wanted = []
        for text in texts:
            if ODD_SPACE.search(text):
                keys = [(piece,) for piece in self.find(text)]
            else:
                keys = text.split(" ")
                keys[0] = (keys[0],)
            wanted.append(np.fromiter(map(code, keys), dtype=np.int64, count=len(keys)))
        self._learn()
        return [gather(self.flat, self.starts, row) for row in wanted]

    def _learn(self) -> None:
        pieces, sequence, counts = Codes(), [], []
        for key in islice(self.codes, self.known, None):
            text = key[0] if isinstance(key, tuple) else " " + key
            found = self.find(text)
            sequence += [pieces[p] for p in found]
            counts.append(len(found))
            self.held += len(text)
        self.known = len(self.codes)
        if not counts:
            return
        flat, sizes = encode_pieces(
            self.vocab, [p.encode("utf-8", "surrogatepass") for p in pieces]
        )
        order = np.array(sequence, dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        ends = np.concatenate(([0], np.cumsum(sizes[order])))[np.cumsum(counts)]
        self.flat = np.concatenate((self.flat, gather(flat, starts, order))).astype(np.int32)
        self.starts = np.concatenate((self.starts, self.starts[-1] + ends))


def gather(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Concatenate the stretches of ``flat`` that belong to ``rows``."""
    if not len(rows):
        return flat[:0]
    begin = starts[rows]
    lengths = starts[rows + 1] - begin
    ends = np.cumsum(lengths)
    index = np.arange(int(ends[-1])) + np.repeat(begin - ends + lengths, lengths)
    return flat[index]


def decode(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    """Bytes of a sequence of ids."""
    return gather(vocab.token_bytes, vocab.token_ends, ids.astype(np.int64)).tobytes()


def encode_documents(docs: DataFrame, path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """Encode and decode ``text`` of every row: ``doc_id, n_tokens``, digests and the ids.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded_sha256`` digests what decoding
    gives back. A null text counts as empty: no tokens, digests of nothing. Repeated rows give
    repeated rows, a null ``doc_id`` stays null, other columns are not read. No shuffle; a task
    holds one batch of texts and a bounded table of pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = encoder.encode(texts)
            packed = [x.astype("<u4").tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed]),
                    pa.array([hashlib.sha256(decode(encoder.vocab, x)).hexdigest() for x in ids]),
                    pa.array(packed if keep_ids else [None] * len(packed), pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of encoded documents: ``doc_id, text`` from ``doc_id, ids``; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [
                None if x is None
                else decode(vocab, np.frombuffer(x, dtype="<u4")).decode("utf-8", "replace")
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
