"""Operators over documents: plain versions, exact round trips, held-out accuracy, odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sentrel.llm import (
    bpe, language, line_dedup, mixing, quality, queries, sample, shingle_join, toxicity,
)
from sentrel.llm.stages import sorted_groups
from tests.compare import duck_rows, register, spark_rows
from tests.llm.plain import kept_lines, shingle_set, smallest_reachable

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, topic string, n_lines int"


def documents(spark, rows, partitions: int = 2):
    """Documents with extra columns whose names the operators use themselves."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "a")), 1, 0.5, "x", 7) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def words(rnd: random.Random, n: int) -> list[str]:
    return ["".join(rnd.choice(("ba", "to", "mi", "re", "su", "Ly")) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


# ------------------------------------------------------------------- registered queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    register(con, SF_DIR)
    assert spark_rows(queries.QUERIES[name](spark, SF_DIR)) == duck_rows(con, queries.SQL[name])


# ------------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(spark, reference):
    rnd = random.Random(1)
    signs = "abc ABC \n\t\r\x0b\x85\xa0'sre139½٣éüß中文🙂👍.,!?　﻿\x00"
    texts = [None, "", " ", "\n", "a" * 3000, "the " * 400, "é" * 700, "  x  y ", "it's I'll we'd"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(120))) for _ in range(200)]
    texts += texts[:4]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = [(i if i else None, t) for i, t in enumerate(texts)]
    out = bpe.encode_documents(documents(spark, rows), path, public_tokenizers.PATTERN)
    found = {r["doc_id"]: r for r in out.collect()}
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(out, path).collect()}
    assert len(found) == len(texts)
    for doc_id, text in rows:
        ids = reference.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        row = found[doc_id]
        assert (row["n_tokens"], bytes(row["ids"])) == (len(ids), packed)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert back[doc_id] == (text or "")


def test_encoder_forgets_and_stays_right(reference, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_PIECES", 10)
    encoder = bpe.Encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rnd = random.Random(2)
    for _ in range(5):
        texts = [" ".join(words(rnd, 30)) for _ in range(4)]
        assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_encoding_an_empty_table(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.encode_documents(documents(spark, []), path, public_tokenizers.PATTERN).count() == 0


# ------------------------------------------------------------------- line dedup


def check_lines(spark, rows, min_words: int):
    wanted = kept_lines(rows, min_words)
    out = line_dedup.line_dedup(documents(spark, rows), line_dedup.Settings(min_words))
    assert out.columns[:7] == SCHEMA.replace(",", "").split()[::2][:7]
    found = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()]
    expected = []
    for row in rows:
        if row[1] is None:
            expected.append((row[0], None, 0, 0))
        else:
            kept, removed = wanted[row[0], row[1]]
            expected.append((row[0], "\n".join(kept), len(row[1].split("\n")), removed))
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_lines_against_all_runs(spark):
    rnd = random.Random(3)
    lines = ["a b c", "d", "", "e f", "g h i j", "k", "  "]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(1, 14)))) for i in range(40)]
    check_lines(spark, rows, 6)


def test_lines_of_odd_rows(spark):
    long = "\n".join(f"word{i % 7} and more" for i in range(3000))
    rows = [
        (None, None), (1, None), (2, ""), (3, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"),
        (5, "x\na b c d\ny"), (6, "a b c d\na b c d\na b c d"), (7, "\n\n\n"), (8, "\n\n\n"), (9, " a b c d"),
    ]
    check_lines(spark, rows, 4)
    out = line_dedup.line_dedup(documents(spark, [(1, long)]), line_dedup.Settings(50))
    assert out.first()["n_removed"] == 2993
    assert line_dedup.line_dedup(documents(spark, [])).count() == 0


# ------------------------------------------------------------------- mixing


def test_marginals_hold(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    targets = {"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}}
    out = mixing.probabilities(docs, settings=mixing.Settings(targets=targets)).cache()
    mass = F.sum(F.col("tokens") * F.col("probability"))
    shares = [r[1] for r in out.groupBy("lang").agg(mass).collect()]
    assert max(shares) - min(shares) < 1e-6 * sum(shares)
    before = {r[0]: r[1] for r in out.groupBy("source").agg(F.sum("tokens")).collect()}
    after = {r[0]: r[1] for r in out.groupBy("source").agg(mass).collect()}
    wanted = {s: n**0.7 for s, n in before.items()}
    for source in before:
        assert after[source] / sum(after.values()) == pytest.approx(wanted[source] / sum(wanted.values()), rel=1e-6)
    kept = out.where("sampled").agg(F.sum("tokens")).first()[0]
    assert kept == pytest.approx(sum(after.values()), rel=0.15)


def test_mixing_odd_rows(spark):
    rows = [(1, "a b", None, None), (2, None, "en", "a"), (None, "c", "de", "a"), (4, "", "en", ""), (5, "a b", None, None), (5, "a b", None, None)]
    found = mixing.probabilities(documents(spark, rows)).collect()
    assert len(found) == len(rows) and all(0 <= r["probability"] <= 1 for r in found)
    assert {(r["doc_id"], r["tokens"]) for r in found} == {(1, 2), (2, 0), (None, 1), (4, 0), (5, 2)}
    assert len({r["sampled"] for r in found if r["doc_id"] == 5}) == 1
    assert mixing.probabilities(documents(spark, [])).count() == 0
    assert {r["probability"] for r in mixing.probabilities(documents(spark, [(1, None), (2, "")])).collect()} == {0.0}


def test_a_tiny_source_leaves_the_rest(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tiny = docs.limit(1).select(
        *(F.lit(v).cast(docs.schema[c].dataType).alias(c) for c, v in
          ((c, {"doc_id": -1, "text": "one two three four five six seven eight nine ten"}.get(c)) for c in docs.columns))
    )
    plain, beside = ({r["doc_id"]: r for r in mixing.probabilities(d).collect()} for d in (docs, docs.unionByName(tiny)))
    share = sum(r["tokens"] * r["probability"] for r in plain.values()) / sum(r["tokens"] for r in plain.values())
    assert share == pytest.approx(mixing.Settings().keep, rel=1e-6)
    assert beside[-1]["probability"] == pytest.approx(1, rel=1e-6)
    assert max(abs(beside[d]["probability"] - r["probability"]) for d, r in plain.items()) < 0.01


# ------------------------------------------------------------------- shingle join


def check_join(spark, rows, partitions: int = 3):
    sets = [shingle_set(text) for _, text in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    ids = [float("inf") if doc_id is None else doc_id for doc_id, _ in rows]
    best = smallest_reachable(ids, links)
    found = shingle_join.near_duplicates(documents(spark, rows, partitions)).collect()
    expected = [
        (doc_id, len(s), None if b == float("inf") else b) for (doc_id, _), s, b in zip(rows, sets, best)
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def edited(rnd: random.Random, text: list[str], share: float) -> list[str]:
    return [rnd.choice(words(rnd, 1)) if rnd.random() < share else w for w in text]


def test_join_against_all_pairs(spark):
    rnd = random.Random(4)
    rows, passage = [], words(rnd, 60)
    for size in (6, 9, 20, 60, 300, 1500):
        for _ in range(3):
            base = words(rnd, size)
            for _ in range(5):
                copy = edited(rnd, base, rnd.choice((0, 0.005, 0.02, 0.04)))
                rows.append(copy + passage if rnd.random() < 0.3 and size > 100 else copy)
    texts = [(i * 7 % 997, " ".join(r)) for i, r in enumerate(rows)]
    check_join(spark, texts)


def test_links_of_one_tile_are_held():
    n = 3000
    shared = np.arange(1, 10, dtype=np.int64)
    family = [np.append(shared, np.int64(100 + k)) for k in range(n)]
    alone = [np.arange(10**6 + 10 * k, 10**6 + 10 * k + 10, dtype=np.int64) for k in range(600)]
    nodes = np.random.default_rng(3).permutation(n + 600).astype(np.int64) - 1000
    places = np.arange(n + 600)
    for first, second in ((places, places), (places[::2], places[1::2])):
        tracemalloc.start()
        found = shingle_join.spanning(nodes, family + alone, first, second, 75)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (found[:n] == nodes[:n].min()).all() and (found[n:] == nodes[n:]).all()
        assert peak < 60 << 20


def test_blocks_are_bounded_by_rows(spark, monkeypatch):
    rows = [(i, f"a b c d e f g h i j k l m w{i}") for i in range(40)] + [(100, "n o p q r s")]
    read = []

    def groups(df, keys, *args):
        if keys == ["cluster", "low", "high"]:
            read.extend(r[0] for r in df.groupBy("cluster", "low", "high").count().select("count").collect())
        return sorted_groups(df, keys, *args)

    monkeypatch.setattr(shingle_join, "sorted_groups", groups)
    found = shingle_join.near_duplicates(documents(spark, rows), shingle_join.Settings(block_rows=8)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: 0 if i < 40 else i for i, _ in rows}
    assert max(read) < 40


def test_join_of_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "a b c d e"), (8, "a b c d e f g h"),
        (8, "A B C D E F G H"), (None, "a b c d e f g h"), (None, "z"), (9, "a b c d e f g h i"), (9, "a b c d e f g h i"),
        (10, "é a b c d e"), (11, "x" * 200_000),
    ]
    check_join(spark, rows)
    assert shingle_join.near_duplicates(documents(spark, [])).count() == 0


def test_join_splits_a_large_cluster(spark):
    """Blocks of few tokens: the pairs of blocks together are all pairs."""
    rnd = random.Random(5)
    base = words(rnd, 120)
    rows = [(i, " ".join(edited(rnd, base, 0.03))) for i in range(80)]
    sets = [shingle_set(t) for _, t in rows]
    links = [(i, j) for i in range(80) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = shingle_join.near_duplicates(documents(spark, rows), shingle_join.Settings(block_tokens=500))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == dict(enumerate(smallest_reachable(list(range(80)), links)))


# ------------------------------------------------------------------- classifiers


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def measured(spark, name: str, column: str):
    rows = queries.QUERIES[name](spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == r[column] for r in held)
    return rows, right / len(held)


def test_quality_on_held_out_rows(spark):
    rows, accuracy = measured(spark, "op6_quality", "quality")
    assert accuracy >= 0.95 and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)


def test_toxicity_on_held_out_rows(spark):
    rows, accuracy = measured(spark, "op2_toxicity", "toxic")
    assert accuracy >= 0.93 and all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) for r in rows)
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = queries.QUERIES["op10_language"](spark, LARGER).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) >= 0.95
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)


ODD = [(None, None), (1, None), (2, ""), (3, "123 !!"), (4, "the " * 50_000), (4, "the " * 50_000), (5, "a")]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("known", [[], [(4, 1, 1, "x"), (4, 1, 1, "x"), (5, 0, 0, "x"), (None, 1, 0, "x"), (3, None, None, "x"), (1, 1, 1, "x"), (2, 2, 3, "x")]])
def test_classifiers_on_odd_rows(spark, known):
    docs = documents(spark, ODD)
    for model, score in (
        (quality.train(docs, labels(spark, known), "quality", 4, 2), quality.score_documents),
        (toxicity.train(docs, labels(spark, known), "toxic", 3, 1), toxicity.score_documents),
    ):
        found = score(docs, model, 4, 2).collect()
        assert sorted((r["doc_id"] or 0) for r in found) == [0, 1, 2, 3, 4, 4, 5]
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
        if not known:
            assert len({r["score"] for r in found}) == 1
        assert score(documents(spark, []), model, 4, 2).count() == 0


def test_language_of_odd_rows(spark):
    docs = documents(spark, ODD + [(i, "der die das und", "de", "s") for i in range(10, 20)])
    settings = language.Settings(steps=20)
    languages, network = language.train(docs, 4, 2, settings)
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, languages, network, 4, 2, settings).collect()}
    assert languages == ["de", "en"] and {found[k] for k in (None, 1, 2, 3)} == {"und"} and found[4] in languages
    empty = documents(spark, [])
    assert language.train(empty, 4, 2, settings) == ([], None)
    assert {r["lang_pred"] for r in language.identify(docs, [], None, 4, 2).collect()} == {"und"}


@pytest.mark.parametrize("step", [1, 2, 3, 7, 50])
def test_runs_across_batches(step, monkeypatch):
    import collections

    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(shingle_join, "MANY", 4)
    rng = np.random.default_rng(step)
    for _ in range(60):
        n = int(rng.integers(1, 50))
        h = np.sort(rng.integers(-6, 6, n)) << 40
        node, counts = rng.integers(-2, 3, n) + 2**61, rng.integers(0, 2, n).astype(bool)
        order = np.lexsort((node, h))
        h, node, counts = h[order], node[order], counts[order]
        batches = [
            pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (h, node, counts)], names=["h", "node", "counts"])
            for i in range(0, n, step)
        ]
        wanted: collections.Counter = collections.Counter()
        for value in set(h):
            own = h == value
            if len(set(node[own])) > 1:
                wanted.update(node[own][counts[own]].tolist())
        found: collections.Counter = collections.Counter()
        for out in shingle_join.shared_runs(iter(batches)):
            for a, k in zip(*(c.to_pylist() for c in out.columns)):
                found[a] += k
        assert found == wanted
        many = collections.Counter(h.tolist())
        keys = sorted(
            (a, k) for out in shingle_join.counted_runs(iter(batches)) for a, k in zip(*(c.to_pylist() for c in out.columns))
        )
        low = [int(x) for x in h.view(np.uint64) >> np.uint64(12)]
        assert keys == sorted(
            (int(a), (min(many[int(x)], 4) << 52) | y) for a, x, y in zip(node, h, low) if many[int(x)] > 1
        )


def test_a_topic_column_stays_and_is_the_topic(spark):
    rows = [(i, "a b c d", "s", "en", 7 if i % 3 else None, 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic int, tokens int")
    out = mixing.probabilities(docs)
    assert dict(out.dtypes)["topic"] == "int" and out.columns.count("tokens") == 1
    assert {(r["topic"], r["tokens"]) for r in out.collect()} == {(7, 4), (None, 4)}
    shares = {(r["dimension"], r["value"]): r for r in mixing.marginals(docs).collect()}
    assert set(shares) == {("source", "s"), ("lang", "en"), ("topic", "7"), ("topic", None)}
    assert all(abs(r["residual"]) < 1e-6 for r in shares.values())


def test_marginals_that_contradict_each_other_say_so(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b", "x" if i % 2 else "y", "t") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    settings = mixing.Settings(targets={"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}, keep=None, sweeps=8)
    with pytest.warns(UserWarning, match="a marginal is off"):
        residuals = {(r["dimension"], r["value"]): r["residual"] for r in mixing.marginals(docs, settings=settings).collect()}
    assert abs(residuals["source", "a"]) > 0.5 and abs(residuals["lang", "x"]) < 1e-6


def test_training_takes_one_text_a_document(spark):
    docs = spark.createDataFrame(
        [(d, f"text {i % 7} of {d} " * 20) for d in range(8) for i in range(100)], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(d, d % 2) for d in range(8)], "doc_id long, quality int")
    models = [quality.train(docs.repartition(n), labels, "quality", 4, 2) for n in (1, 5)]
    assert (models[0].weights == models[1].weights).all() and (models[0].bias == models[1].bias).all()
    picked = sample.with_texts(docs, {0: [0, 2], 1: [1]}).collect()
    assert sorted((r["doc_id"], r["label"]) for r in picked) == [(0, 0), (1, 1), (2, 0)]


def test_the_ordinary_dictionary_learns_from_a_stated_share(monkeypatch):
    seen = []
    real = toxicity.trained
    monkeypatch.setattr(toxicity, "trained", lambda samples, size, segment: seen.append(samples) or real(samples, size, segment))
    ordinary = [f"plain words {i} and {i * i} more of them".encode() for i in range(50_000)]
    settings = toxicity.Settings(rounds=1)
    toxicity.fit([b"you vile wretch " * 3] * 20, ordinary, settings)
    bound = settings.dictionary_sample * settings.ordinary_bytes
    assert bound <= sum(map(len, seen[0])) <= bound + 80
    seen.clear()
    toxicity.fit([b"you vile wretch " * 3] * 20, ordinary, toxicity.Settings(rounds=1, dictionary_sample=10**6))
    assert len(seen[0]) == len({w for t in ordinary for w in toxicity.windows(t)})
