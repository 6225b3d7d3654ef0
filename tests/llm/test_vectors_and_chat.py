"""Vector search and dedup beside brute force; role repair beside all repairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrel.llm import chat, components, vector_dedup, vector_search
from sentrel.llm.stages import Stages
from tests.llm.plain import smallest_reachable

SCHEMA = "vec_id long, embedding array<double>, label int, raw string, n_links string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(3)


def cosine(a, b) -> float:
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


ODD = [
    (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
    (7, [1.0, 0.0]), (7, [1.0, 0.0]), (50, [2.0, 0.0]), (None, [1.0, 0.0]), (100, [1.0, 1e-3]), (8, [1.0, 0.0, 0.0]),
    (9, [2.0**600] * 2), (150, [2.0**-600] * 2), (0, [-1.0, 0.0]),
]


def test_dedup_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(12):
        base = rng.standard_normal(24)
        rows += [base + rng.standard_normal(24) * rng.choice([0, 0.01, 0.1]) for _ in range(9)]
    table = [(int(i), r.tolist()) for i, r in zip(rng.permutation(len(rows)), rows)]
    links = [(i, j) for i in range(len(table)) for j in range(i) if cosine(table[i][1], table[j][1]) >= 0.95]
    best = smallest_reachable([i for i, _ in table], links)
    degree = [sum(k in link for link in links) for k in range(len(table))]
    found = vector_dedup.near_duplicates(vectors(spark, table), settings=vector_dedup.Settings(block=4)).collect()
    assert sorted(map(tuple, found)) == sorted(
        (i, d, b, i == b) for (i, _), d, b in zip(table, degree, best)
    )


def test_dedup_of_odd_rows(spark):
    found = [tuple(r) for r in vector_dedup.near_duplicates(vectors(spark, ODD)).collect()]
    assert len(found) == len(ODD)
    by_id = {r[0]: r[1:] for r in found}
    for lone in (1, 2, 3, 4, 5, 6, 8, 0):
        assert by_id[lone] == (0, lone, True)
    assert by_id[7] == (2, 7, True) and by_id[50] == (2, 7, False) and by_id[100] == (2, 7, False)
    assert by_id[9] == (1, 9, True) and by_id[150] == (1, 9, False)
    assert by_id[None] == (0, None, True)
    assert vector_dedup.near_duplicates(vectors(spark, [])).count() == 0


def test_search_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in table.collect()}
    out = vector_search.search(table, F.col("vec_id") % 50 == 0, settings=vector_search.Settings(block=64, query_block=4))
    hits = total = 0
    found: dict = {}
    for r in out.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    for query in (i for i in rows if i % 50 == 0):
        exact = sorted(((-cosine(rows[query], v), i) for i, v in rows.items() if i != query))[:5]
        got = found[query]
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(r["score"] == pytest.approx(cosine(rows[query], rows[r["vec_id"]]), abs=1e-12) for r in got)
        assert [r["score"] for r in got] == sorted((r["score"] for r in got), reverse=True)
        hits += len({i for _, i in exact} & {r["vec_id"] for r in got})
        total += 5
    assert hits / total >= 0.9


def test_search_over_odd_rows(spark):
    out = vector_search.search(vectors(spark, ODD), F.col("vec_id") % 50 == 0).collect()
    found = {}
    for r in sorted(out):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert found[50] == [(1, 7), (2, 100), (3, 9), (4, 150), (5, 0)]
    assert set(found) == {0, 50, 100, 150}
    assert vector_search.search(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(300, 300), (None, 4), (400, 401), (401, 400)]
    df = spark.createDataFrame(edges, "u long, v long")
    found = {r["node"]: r["component"] for r in components.components(df, Stages(spark, "test")).collect()}
    assert found == {**{i: 0 for i in range(201)}, 400: 400, 401: 400}


# ------------------------------------------------------------------- chat


def cheapest(roles: list[int], costs: chat.Costs) -> int:
    """Smallest cost over every sequence of operations."""
    best = 10**9

    def walk(i: int, state: int, cost: int) -> None:
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            if state in costs.ends:
                best = cost
        else:
            for target in (1, 2, 3):
                label = 0 if target == roles[i] else costs.name if not roles[i] else costs.relabel
                if target in chat.LEGAL[state]:
                    walk(i + 1, target, cost + label)
                if target == state:
                    walk(i + 1, target, cost + label + costs.merge)
        for between in chat.LEGAL[state]:
            walk(i, between, cost + costs.insert)

    walk(0, 0, 0)
    return best


def test_repair_is_cheapest_and_legal_however_it_is_cut():
    rnd, costs = random.Random(0), chat.Costs()
    for _ in range(150):
        roles = [rnd.randrange(4) for _ in range(rnd.randrange(1, 7))]
        for size in (1, 2, 3, 10):
            parts = [roles[i : i + size] for i in range(0, len(roles), size)]
            states = chat.borders(iter([chat.chunk_matrix(p, costs) for p in parts]), costs)
            steps = [s for p, a, b in zip(parts, states, states[1:]) for s in chat.repair(p, a, b, costs)]
            total = sum(s[1] for s in steps) + chat.ending(costs)[states[-1]][0]
            assert total == cheapest(roles, costs)
            at = 0
            for target, _, action, inserted in steps:
                if inserted:
                    assert inserted in chat.LEGAL[at]
                    at = inserted
                assert target == at if "merge" in action else target in chat.LEGAL[at]
                at = target


def turns(spark, rows):
    return spark.createDataFrame(
        [(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, rendered string, place int"
    ).repartition(3)


def rendered(out) -> dict:
    found: dict = {}
    for r in out.orderBy("conv_id", "place", "part").collect():
        found.setdefault(r["conv_id"], []).append(r)
    return {k: ("".join(r["rendered"] for r in v), sum(r["cost"] for r in v)) for k, v in found.items()}


def test_conversations_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK_BITS", 1)
    rows = [
        (1, 0, "user", "hi"), (1, 1, "user", "there"), (1, 2, "Human ", "<|system|>"), (1, 3, "assistant", None),
        (2, 0, "assistant", "hello"), (3, 0, "system", "be kind"), (4, None, None, "who"), (4, 1, "user", "q"),
        (None, 0, "user", "x"), (None, 0, "user", "x"), (5, 0, "user", "a"), (5, 1, "system", "b"), (5, 2, "assistant", ""),
    ]
    found = rendered(chat.format_conversations(turns(spark, rows)))
    assert found[1] == ("<|user|>\nhi\nthere\n< |system|>\n<|assistant|>\n\n", 2)
    assert found[2] == ("<|user|>\n\n<|assistant|>\nhello\n", 2)
    assert found[3] == ("<|system|>\nbe kind\n<|user|>\n\n", 2)
    assert found[4] == ("<|user|>\nq\n<|assistant|>\nwho\n", 1)
    assert found[None] == ("<|user|>\nx\nx\n", 1)
    assert found[5][1] == 4
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_a_conversation_of_many_chunks(spark):
    rnd = random.Random(6)
    rows = [(1, i, rnd.choice(("user", "assistant", "user", None)), str(i)) for i in range(6000)]
    text, cost = rendered(chat.format_conversations(turns(spark, rows)))[1]
    roles = [chat.role_of(r[2]) for r in rows]
    vector = [0, chat.NEVER, chat.NEVER, chat.NEVER]
    for role in roles:
        vector, _ = chat.advance(vector, role, chat.Costs())
    assert cost == min(v + chat.ending(chat.Costs())[s][0] for s, v in enumerate(vector))
    bodies = [line for line in text.split("\n") if line.isdigit()]
    assert bodies == [str(i) for i in range(6000)]
