"""Decontamination beside a plain version: all windows of all items looked for in all texts."""

from __future__ import annotations

import random
import re

import pytest

from sentrel.llm import decontaminate
from sentrel.llm.decontaminate import Settings

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, n_hit int, items string"
ITEMS = "item_id long, text string, n_words int"


def plain(docs: list[tuple], items: list[tuple], width: int = 10) -> list[tuple]:
    split = lambda text: WORD.findall((text or "").translate(LOWER))
    windows = [
        (item, own[i : i + width]) for item, text in items for own in [split(text)]
        for i in range(max(len(own) - width, 0) + 1) if own
    ]
    out = []
    for doc_id, text in docs:
        own, hit, met = split(text), set(), set()
        for item, window in windows:
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    met |= {str(item)} if item is not None else set()
        out.append((doc_id, len(own), len(hit), sorted(met)))
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, 7, "x") for d, t in docs], SCHEMA),
        spark.createDataFrame([(i, t, 7) for i, t in items], ITEMS),
    )


def found(spark, docs, items, settings=Settings()):
    rows = decontaminate.find(*tables(spark, docs, items), settings).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=repr)


def random_tables(seed: int):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "été", "x1", "日本", "9", "The"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "__"]) for _ in range(n))
    items = [(rng.randrange(12), text(rng.choice([1, 3, 9, 10, 11, 25]))) for _ in range(12)]
    docs = []
    for i in range(60):
        body = [text(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            body += [rng.choice(items)[1].upper() if rng.random() < 0.5 else rng.choice(items)[1], text(5)]
        docs.append((i, " ".join(body)))
    return docs, items


ODD = [(1, None), (2, ""), (3, " .,\n"), (None, "one TWO three"), (4, "one two three four"), (4, "one two three four"), (5, "one two")]
ODD_ITEMS = [(10, "One two, three"), (9, "two three"), (9, "four"), (None, "one"), (7, None), (8, ""), (6, "...")]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    docs, items = random_tables(seed)
    # Windows of one or three common words would hit everything.
    items = [x for x in items if len(WORD.findall(x[1])) > 3]
    assert found(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    assert found(spark, ODD, ODD_ITEMS) == plain(ODD, ODD_ITEMS)


def test_items_in_parts_and_stretches(spark):
    docs, items = random_tables(3)
    small = Settings(part_bytes=150, piece_words=4)
    assert found(spark, docs + ODD, items + ODD_ITEMS, small) == plain(docs + ODD, items + ODD_ITEMS)


def test_empty_tables(spark):
    assert found(spark, [], ODD_ITEMS) == []
    assert found(spark, ODD, []) == plain(ODD, [])


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    docs, items = random_tables(4)
    index = decontaminate.Index([(str(i), b" ".join(w.encode() for w in WORD.findall(t.translate(LOWER)))) for i, t in items], 10)
    table = index.tables[10]
    # As if every window had one hash: each must still be told by its words.
    import numpy as np

    same = np.zeros_like(table[0])
    monkeypatch.setattr(decontaminate, "window_hashes", lambda hashes, n: np.zeros(max(len(hashes) - n + 1, 0), np.uint64))
    index.tables = {10: (same, np.uint64(54), np.ones(1024, bool), *table[3:6], len(same))}
    text = next(t for _, t in docs if any(len(WORD.findall(i)) >= 10 and i in t for _, i in items))
    import pyarrow as pa

    (n, _, _, hit, met), = decontaminate.scan(pa.array([text]), index)
    long = [(i, t) for i, t in items if len(WORD.findall(t)) >= 10]
    assert [(0, n, hit.sum(), met)] == plain([(0, text)], long)


def test_long_text_and_spans(spark):
    passage = "Été one two three four five six seven eight nine ten"
    text = "日本 " * 200_000 + passage + " x" * 400_000
    docs, items = tables(spark, [(1, text)], [(1, passage)])
    row = decontaminate.find(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["items"]) == (600_011, 11, ["1"])
    (start, end), = row["spans"]
    assert text[start:end] == passage
    assert decontaminate.clean(docs, items).first()["text"] == text.replace(passage, "")


def test_clean(spark):
    docs, items = tables(spark, ODD + [(6, "zero. One two THREE! five")], [(1, "one two three")])
    cut = decontaminate.clean(docs, items)
    assert cut.schema == docs.schema
    rows = sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=repr)
    assert rows == sorted(
        [(1, None), (2, ""), (3, " .,\n"), (None, ""), (4, " four"), (4, " four"), (5, "one two"), (6, "zero. ! five")],
        key=repr,
    )
    assert {r["doc_id"] for r in decontaminate.clean(docs, items, drop=0.0).collect()} == {1, 2, 3, 5}
    assert {r["doc_id"] for r in decontaminate.clean(docs, items, drop=0.7).collect()} == {1, 2, 3, 5, 6}
    parts = decontaminate.clean(docs, items, Settings(part_bytes=1))
    assert sorted(((r["doc_id"], r["text"]) for r in parts.collect()), key=repr) == rows
