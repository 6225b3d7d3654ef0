"""Word-shingle sets of whole texts as 64-bit hashes, computed on byte buffers with numpy.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. A text's set holds its
distinct shingles of ``width`` consecutive words; a text with fewer words is one shingle of all
its words; a text without words has the empty set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Texts are hashed together up to this many bytes; a longer text is hashed alone.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
    values[65:91] = values[97:123]
    return values


BYTE_VALUES = _byte_values()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the usual block size."""
    have = _powers.get(name)
    if have is not None and len(have) >= n:
        return have[:n]
    made = np.full(max(n, 1), base, dtype=np.uint64)
    made[0] = 1
    np.cumprod(made, out=made)
    if n <= 2 * BLOCK_BYTES:
        _powers[name] = made
    return made


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets into them; null rows are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """Ranges of rows of at most ``size`` bytes together, at least one row each."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, values: np.ndarray = BYTE_VALUES
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the row offsets into the words."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = IS_SPACE[data]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = space[:-1]
    fresh[offsets[:-1][offsets[:-1] < n]] = True
    ends = np.ones(n, dtype=bool)
    ends[:-1] = space[1:]
    cut = offsets[1:] - 1
    ends[cut[cut >= 0]] = True
    start = np.flatnonzero(fresh & ~space)
    stop = np.flatnonzero(ends & ~space) + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * _power("up", BASE, n), out=total[1:])
    hashes = (total[stop] - total[start]) * _power("down", BASE_INVERSE, n)[start]
    hashes = mix(hashes + (stop - start).astype(np.uint64))
    return hashes, np.searchsorted(start, offsets)


def shingle_hashes(
    words: np.ndarray, word_offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in text order (not distinct yet), and the row offsets into them."""
    counts = np.diff(word_offsets)
    n = len(words)
    rolled = np.zeros(n, dtype=np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for k in range(width):
        if n > k:
            rolled[: n - k] += words[k:] * factors[k]
    rolled = mix(rolled)
    row = np.repeat(np.arange(len(counts)), counts)
    left = word_offsets[1:][row] - np.arange(n)
    keep = left >= width
    few = (counts > 0) & (counts < width)
    if few.any():
        for i in np.flatnonzero(few):
            a, b = word_offsets[i], word_offsets[i + 1]
            whole = np.uint64(counts[i])
            for w in words[a:b]:
                whole = mix(np.array([whole * BASE + w], dtype=np.uint64))[0]
            rolled[a], keep[a] = whole, True
    made = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(np.where(few, 1, np.maximum(counts - width + 1, 0)), out=made[1:])
    return rolled[keep], made


def sets(column: pa.Array, width: int):
    """Yield the sorted distinct shingle hashes of every row, in row order."""
    data, offsets = text_buffers(column)
    with np.errstate(over="ignore"):
        for first, last in blocks(offsets):
            part = offsets[first : last + 1]
            words, at = word_hashes(data[part[0] : part[-1]], part - part[0])
            shingles, ends = shingle_hashes(words, at, width)
            for i in range(last - first):
                yield np.unique(shingles[ends[i] : ends[i + 1]])
