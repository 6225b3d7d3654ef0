"""The pipeline's stages beside plain versions, on the smallest tables."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentrel.llm import bpe, mixing, quality
from sentrel.llm.stages import Stages
from tests.llm.plain import kept_lines, shingle_set, smallest_reachable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    stages = Stages(spark, "test-pipeline")
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stages.write(stage(spark, out[-1], SF_DIR)))
    return out


CLASHING = (
    "tokens", "probability", "sampled", "component", "digest", "many", "n_removed", "n_lines", "score", "label", "place",
)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=lambda x: x if isinstance(x, str) else "")
def test_stages_take_clashing_columns_and_empty_tables(spark, name, stage):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    extra = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHING})
    out = stage(spark, extra, SF_DIR)
    rows = out.collect()
    assert 0 < len(rows) <= 60
    if name != "encode":
        assert out.schema == extra.schema
        assert all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING)
    assert stage(spark, extra.limit(0), SF_DIR).collect() == []


def test_stages_keep_the_columns(steps):
    assert all(step.columns == steps[0].columns for step in steps[1:-1])


def test_quality_rejects_what_the_model_rejects(spark, steps):
    model = quality.train(steps[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"), "quality", 4, 2)
    good = quality.score_documents(steps[0], model, 4, 2).where("predicted = 1").select("doc_id").collect()
    assert sorted(r[0] for r in good) == sorted(r["doc_id"] for r in steps[1].collect())
    assert 0.7 * steps[0].count() < steps[1].count() < steps[0].count()


def test_lines_are_gone(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    wanted = kept_lines(rows, 50)
    expected = {d: "\n".join(kept) for (d, t), (kept, n) in wanted.items() if not (n and not " ".join(kept).split())}
    found = steps[2].collect()
    assert {r["doc_id"]: r["text"] for r in found} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_one_of_each_group_stays(steps):
    rows = sorted((r["doc_id"], r["text"]) for r in steps[2].collect())
    sets = [shingle_set(t) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    best = smallest_reachable([d for d, _ in rows], links)
    assert sorted(r["doc_id"] for r in steps[3].collect()) == [d for (d, _), b in zip(rows, best) if d == b]


def test_the_sample_is_the_draw(steps):
    drawn = mixing.probabilities(steps[3]).where("sampled").select("doc_id").collect()
    assert sorted(r[0] for r in drawn) == sorted(r["doc_id"] for r in steps[4].collect())
    assert 0 < steps[4].count() < steps[3].count()


def test_encoding_gives_the_texts_back(steps):
    back = bpe.decode_documents(steps[5], public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert {tuple(r) for r in back.collect()} == {(r["doc_id"], r["text"]) for r in steps[4].collect()}


def test_run_gives_the_same(spark, steps):
    assert {(r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {
        (r["doc_id"], r["ids_sha256"]) for r in steps[5].collect()
    }


# ------------------------------------------------------------------- odd rows

LONG = " ".join(f"w{i}" for i in range(40))
OTHER = " ".join(f"v{i}" for i in range(40))
ODD = [
    (1, LONG), (1, LONG), (2, LONG + " x"), (2, OTHER), (None, LONG), (None, "a b c d e f"), (None, "a b c d e f"),
    (3, None), (3, None), (4, ""), (4, ""), (5, "one two"), (None, None), (6, "p q r s t u"), (6, "P  q r s t u"),
]


def odd(spark):
    like = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    rows = [tuple({"doc_id": d, "text": t}.get(c) for c in like.names) for d, t in ODD]
    return spark.createDataFrame(rows, like).repartition(3)


def test_one_row_of_each_group_stays(spark):
    found = corpus_pipeline.near_duplicates(spark, odd(spark), SF_DIR).collect()
    texts = [(r["doc_id"], r["text"]) for r in found if r["doc_id"] != 6]
    assert sorted(texts, key=repr) == sorted(
        [(1, LONG), (2, OTHER), (None, "a b c d e f"), (3, None), (3, None), (4, ""), (4, ""), (5, "one two"), (None, None)],
        key=repr,
    )
    assert sum(r["doc_id"] == 6 for r in found) == 1


@pytest.mark.parametrize("place", [0, 1, 3, 4])
def test_stages_take_odd_rows(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    docs = odd(spark)
    if name == "quality":
        docs = docs.unionByName(spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id > 6"))
    found = [(r["doc_id"], r["text"] if "text" in r else None) for r in stage(spark, docs, SF_DIR).collect()]
    rows = [r for r in found if r[0] is None or r[0] <= 6]
    if name == "encode":
        assert sorted((d for d, _ in rows), key=repr) == sorted((d for d, _ in ODD), key=repr)
    else:
        assert all(rows.count(r) <= ODD.count(r) for r in rows)
    if name == "line_dedup":
        assert sorted(rows, key=repr) == sorted(ODD, key=repr)
    if name == "mixing":
        assert all(rows.count(r) in (0, ODD.count(r)) for r in rows)
