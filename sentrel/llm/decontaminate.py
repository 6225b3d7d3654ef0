"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned over
every text, hits verified word by word, and the hit spans or documents taken out.

Words are runs of 0-9, a-z and characters beyond ASCII, A-Z counting as a-z. A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one window. A word of a
text is hit if it lies inside any occurrence of a window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.llm import shingles
from sentrel.llm.shingles import BASE, BASE_INVERSE, BYTE_VALUES, mix, text_buffers
from sentrel.llm.stages import Stages


@dataclass(frozen=True)
class Settings:
    """``part_bytes`` bounds the benchmark text one broadcast holds; a larger benchmark is cut into
    parts, and the texts are scanned once for each. ``piece_words`` cuts long items beforehand.
    """

    width: int = 10
    part_bytes: int = 8 << 20
    piece_words: int = 4096


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word of lower-cased ``data``, and the row offsets into them."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = IS_WORD[data]
    fresh, last = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # A row's end also ends a word.
    border = offsets[1:-1]
    border = border[inside[border] & inside[border + 1]]
    fresh[border] = last[border] = True
    start, stop = np.flatnonzero(fresh), np.flatnonzero(last)
    return start, stop, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of every word, computed over stretches of bounded size."""
    out = np.zeros(len(start), dtype=np.uint64)
    first = 0
    while first < len(start):
        last = max(int(np.searchsorted(stop, start[first] + shingles.BLOCK_BYTES, side="right")), first + 1)
        base = start[first]
        n = int(stop[last - 1] - base)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data[base : base + n]] * shingles._power("up", BASE, n), out=total[1:])
        a, b = start[first:last] - base, stop[first:last] - base
        out[first:last] = mix(
            (total[b] - total[a]) * shingles._power("down", BASE_INVERSE, n)[a] + (b - a).astype(np.uint64)
        )
        first = last
    return out


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each word on, as far as there are so many."""
    n = max(len(hashes) - length + 1, 0)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        rolled += hashes[k : k + n] * (mix(np.uint64([k + 1]) * BASE) | np.uint64(1))
    return mix(rolled)


class Index:
    """Distinct windows of one part of the benchmark: their hashes, their words and their items."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], width: int) -> None:
        """``pieces`` are the words of an item, or of a stretch of it, joined by single spaces."""
        self.ids: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in pieces if item is not None})
        number = {item: i for i, item in enumerate(self.items)}
        by_length: dict[int, list[tuple[int, list[int]]]] = {}
        for item, piece in pieces:
            own = [self.ids.setdefault(w, len(self.ids)) for w in piece.split(b" ")]
            by_length.setdefault(min(len(own), width), []).append((number.get(item, -1), own))
        known = sorted(self.ids, key=self.ids.get)
        ends = np.cumsum([len(w) for w in known], dtype=np.int64)
        with np.errstate(over="ignore"):
            of_word = word_hashes(
                np.frombuffer(b"".join(known), np.uint8), ends - [len(w) for w in known], ends
            ) if known else np.zeros(0, np.uint64)
            self.tables = {n: self._table(n, rows, of_word) for n, rows in by_length.items()}

    @staticmethod
    def _table(length: int, rows: list, of_word: np.ndarray) -> tuple:
        """Sorted hashes, a filter on their upper bits, the words of each window, and its items."""
        grams = np.concatenate(
            [np.lib.stride_tricks.sliding_window_view(np.array(own, np.int32), length) for _, own in rows]
        )
        owner = np.repeat([item for item, _ in rows], [len(own) - length + 1 for _, own in rows])
        grams, which = np.unique(grams, axis=0, return_inverse=True)
        rolled = np.zeros(len(grams), dtype=np.uint64)
        for k in range(length):
            rolled += of_word[grams[:, k]] * (mix(np.uint64([k + 1]) * BASE) | np.uint64(1))
        hashes = mix(rolled)
        order = np.argsort(hashes, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        pairs = np.unique(np.column_stack((place[which.ravel()], owner))[owner >= 0], axis=0)
        shift = np.uint64(64 - min(26, max(10, int(len(grams)).bit_length() + 4)))
        held = np.zeros(1 << int(64 - shift), dtype=bool)
        held[hashes >> shift] = True
        hashes = hashes[order]
        # Different windows of one hash, should there be any, lie side by side.
        most = int(np.unique(hashes, return_counts=True)[1].max())
        return hashes, shift, held, grams[order], np.searchsorted(pairs[:, 0], np.arange(len(grams) + 1)), pairs[:, 1], most

    def hits(
        self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, rows: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit; and, one for each row and item met, the row and the item.

        ``rows`` gives the row of each word; windows do not reach across rows.
        """
        hit = np.zeros(len(start) + 1, dtype=np.int64)
        met = [np.zeros((0, 2), dtype=np.int64)]
        hashes = word_hashes(data, start, stop)
        raw = data.tobytes() if self.tables else b""
        for length, (known, shift, held, grams, at, owners, most) in self.tables.items():
            own = window_hashes(hashes, length)
            maybe = np.flatnonzero(held[own >> shift])
            maybe = maybe[rows[maybe] == rows[maybe + length - 1]]
            left = np.searchsorted(known, own[maybe])
            for probe in range(most):
                place = np.minimum(left + probe, len(known) - 1)
                same = known[place] == own[maybe]
                found, gram = maybe[same], place[same]
                good = self._verified(raw, start, stop, found, grams[gram], length)
                found, gram = found[good], gram[good]
                hit[found] += 1
                hit[found + length] -= 1
                met.append(self._owners(np.unique(rows[found] * len(known) + gram), len(known), at, owners))
        pairs = np.unique(np.concatenate(met), axis=0)
        return np.cumsum(hit[:-1]) > 0, pairs[:, 0], pairs[:, 1]

    def _verified(self, raw, start, stop, found, grams, length) -> np.ndarray:
        """Whether the words from ``found`` on are those of the windows, by their bytes."""
        if not len(found):
            return np.zeros(0, dtype=bool)
        spots = np.unique(found[:, None] + np.arange(length))
        get = self.ids.get
        own = np.fromiter(
            (get(raw[a:b], -1) for a, b in zip(start[spots].tolist(), stop[spots].tolist())), np.int64, len(spots)
        )
        good = np.ones(len(found), dtype=bool)
        for k in range(length):
            good &= own[np.searchsorted(spots, found + k)] == grams[:, k]
        return good

    @staticmethod
    def _owners(keys: np.ndarray, size: int, at: np.ndarray, owners: np.ndarray) -> np.ndarray:
        row, gram = keys // size, keys % size
        many = at[gram + 1] - at[gram]
        place = np.repeat(at[gram] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return np.column_stack((np.repeat(row, many), owners[place]))


def pieces(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """``item, words`` of the benchmark: lower-cased words joined by spaces, long items in stretches
    that overlap by a window less one word. Items without words have none.
    """
    step, extra = settings.piece_words, settings.width - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
                start, stop, _ = words(data, np.array([0, len(data)]))
                raw = data.tobytes()
                own = [raw[a:b] for a, b in zip(start.tolist(), stop.tolist())]
                for first in range(0, max(len(own) - extra, min(len(own), 1)), step):
                    items.append(item)
                    found.append(b" ".join(own[first : first + step + extra]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(found, pa.binary())], names=["item", "words"]
            )

    return benchmark.select(
        F.col("item_id").cast("string").alias("item"), "text"
    ).mapInArrow(run, "item string, words binary").dropDuplicates()


def indexes(benchmark: DataFrame, settings: Settings) -> Iterator[Index]:
    """One index for each part of the benchmark; the parts' sizes are counted before any is read."""
    rows = pieces(benchmark, settings).withColumn(
        "size", F.length("words") + F.coalesce(F.length("item"), F.lit(0)) + 8
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // settings.part_bytes))
    part = lambda: F.pmod(F.xxhash64("words", "item"), F.lit(parts))
    while parts > 1:
        most = rows.groupBy(part().alias("part")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if most.where((F.col("size") > settings.part_bytes) & (F.col("n") > 1)).isEmpty():
            break
        parts *= 2
    for number in range(parts):
        held = rows.where(part() == number) if parts > 1 else rows
        yield Index([(r["item"], bytes(r["words"])) for r in held.select("item", "words").collect()], settings.width)


Found = tuple[int, np.ndarray, np.ndarray, np.ndarray, list]


def scan(column: pa.Array, index: Index) -> Iterator[Found]:
    """Of every text: its number of words, their first bytes and ends, which are hit, items met."""
    data, offsets = text_buffers(column)
    with np.errstate(over="ignore"):
        for first, last in shingles.blocks(offsets):
            part = offsets[first : last + 1] - offsets[first]
            own = LOWER[data[offsets[first] : offsets[last]]]
            start, stop, at = words(own, part)
            rows = np.repeat(np.arange(last - first), np.diff(at))
            hit, met, items = index.hits(own, start, stop, rows)
            ends = np.searchsorted(met, np.arange(last - first + 1))
            for i in range(last - first):
                mine = slice(at[i], at[i + 1])
                yield (
                    at[i + 1] - at[i], start[mine] - part[i], stop[mine] - part[i], hit[mine],
                    [index.items[x] for x in items[ends[i] : ends[i + 1]]],
                )


def runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edges[::2], edges[1::2] - 1


Finish = Callable[[pa.RecordBatch, list[Found]], pa.RecordBatch]


def _scanned(rows: DataFrame, benchmark: DataFrame, settings: Settings, finish: Finish, schema) -> DataFrame:
    """Scan ``rows`` (with a column ``text``) for every part of the benchmark, then ``finish``.

    Between two parts the rows are written with the words hit so far (a bit each) and the items.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "decontaminate")
    parts = indexes(benchmark, settings)
    index, later = next(parts), next(parts, None)
    state, kept = None, []
    while True:
        shared = spark.sparkContext.broadcast(index)
        first, final = state is None, later is None

        def run(batches, shared=shared, first=first, final=final) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(scan(batch.column("text"), shared.value))
                if not first:
                    before = zip(found, batch.column("__hit").to_pylist(), batch.column("__items").to_pylist())
                    found = [
                        (n, a, b, hit | np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool),
                         sorted({*items, *old}))
                        for (n, a, b, hit, items), bits, old in before
                    ]
                    batch = batch.drop_columns(["__hit", "__items"])
                if final:
                    yield finish(batch, found)
                    continue
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([np.packbits(f[3]).tobytes() for f in found], pa.binary()),
                     pa.array([f[4] for f in found], pa.list_(pa.string()))],
                    names=[*batch.schema.names, "__hit", "__items"],
                )

        source = rows if first else state
        if final:
            return source.mapInArrow(run, schema)
        plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        state = stages.write(source.mapInArrow(run, f"{plain}, __hit binary, __items array<string>"))
        stages.drop(*kept)
        kept = [state]
        index, later = later, next(parts, None)


def find(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every row of ``docs``.

    ``items`` are the ids, as sorted strings, of the items with a window in the text; ``spans`` the
    runs of hit words as places of their first character and their end. Null and empty texts have
    no words; repeated rows give repeated rows; rows without ``doc_id`` stay. Items without text or
    words have no window; the windows of an item without ``item_id`` are hit, but no item is named.
    Rows that share an ``item_id`` are one item. Other columns are not read. Without documents or
    items there is nothing to hit.
    """

    def finish(batch: pa.RecordBatch, found: list[Found]) -> pa.RecordBatch:
        texts = batch.column("text")
        spans = []
        for i, (_, start, stop, hit, _) in enumerate(found):
            a, b = runs(hit)
            place = np.column_stack((start[a], stop[b]))
            if len(place):
                lead = (np.frombuffer(texts[i].as_py().encode(), np.uint8) & 0xC0) != 0x80
                place = np.concatenate(([0], np.cumsum(lead)))[place]
            spans.append([{"start": int(x), "end": int(y)} for x, y in place])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([int(f[0]) for f in found], pa.int64()),
             pa.array([int(f[3].sum()) for f in found], pa.int64()),
             pa.array([f[4] for f in found], pa.list_(pa.string())),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            names=["doc_id", "n_words", "n_hit", "items", "spans"],
        )

    kind = dict(docs.dtypes)["doc_id"]
    return _scanned(
        docs.select("doc_id", "text"), benchmark, settings, finish,
        f"doc_id {kind}, n_words long, n_hit long, items array<string>, "
        "spans array<struct<start: int, end: int>>",
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), drop: float | None = None
) -> DataFrame:
    """``docs`` with the hit spans cut from ``text``; all columns keep their names and order.

    With ``drop``, texts whose share of hit words exceeds it go whole and others stay whole: 0
    drops every text with a hit. Rows without words stay. Cases as for ``find``.
    """
    names = docs.columns
    # Numbered, so that no column of the table clashes with those of the scan.
    rows = docs.toDF(*[f"c{i}" if name != "text" else name for i, name in enumerate(names)])
    place = rows.columns.index("text")

    def finish(batch: pa.RecordBatch, found: list[Found]) -> pa.RecordBatch:
        if drop is not None:
            return batch.filter(pa.array([f[3].sum() <= drop * f[0] for f in found], pa.bool_()))
        texts, before = [], batch.column("text")
        for i, (_, start, stop, hit, _) in enumerate(found):
            text = before[i].as_py()
            if hit.any():
                raw, kept, at = text.encode(), [], 0
                for a, b in zip(*runs(hit)):
                    kept.append(raw[at : start[a]])
                    at = stop[b]
                text = b"".join([*kept, raw[at:]]).decode()
            texts.append(text)
        return batch.set_column(place, "text", pa.array(texts, pa.string()))

    return _scanned(rows, benchmark, settings, finish, rows.schema).toDF(*names)


def oracle() -> str:
    """DuckDB SQL of the registered query: every window of every length against all items."""
    split = (
        "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[0-9a-z\\x{80}-\\x{10FFFF}]+')"
    )
    return f"""
    WITH i AS (SELECT item_id, {split} AS w FROM benchmark),
    g AS (
      SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n,
             array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS gram
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
    ),
    d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({split}, []) AS w FROM documents),
    f AS (
      SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
            FROM d CROSS JOIN (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
    ),
    h AS (SELECT r, p, n, item FROM f JOIN g USING (n, gram)),
    c AS (SELECT r, count(DISTINCT q) AS n_hit
          FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
    m AS (SELECT r, count(DISTINCT item) AS n_items,
                 string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
           sha256(coalesce(m.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
    """
