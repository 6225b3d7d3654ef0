"""Alignment beside a plain version: both tokenizers over the whole text, all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sentrel.llm import alignment
from sentrel.llm.alignment import Settings

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row string, links int"
TEXTS = [
    "The quick brown fox", "a  b", " a", "a ", "\n a\n b", "x▁y z", "<s> </s> <unk> <|endoftext|> <0x41>",
    "日本語 テキスト です", "é café ﬁ ½ ²", "a\x00b c\x7f", "   ", "😀 😀😀 x", "", None, "﻿abc d​e",
    "foo \x1c bar \x85 baz", "don't 's  't", "the the the", "the the the", "tab\tword new\nline\r\n end",
]


def plain(texts: list) -> list[tuple]:
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    decoder = {c: i for i, c in enumerate(_characters())}
    found = []
    for text in texts:
        if not text:
            found.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(decoder[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i in ids_b for p in [b.id_to_piece(i)]
        ]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append(None)
            continue
        ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
        links = [(x, y) for x, s in zip(ids_a, ends_a) for y, t in zip(ids_b, ends_b) if s == t]
        groups, low = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            inside = lambda ids, ends: ",".join(str(i) for i, e in zip(ids, ends) if low < e <= end)  # noqa: B023, E731
            groups.append(f"{inside(ids_a, ends_a)}|{inside(ids_b, ends_b)}")
            low = end
        found.append((len(ids_a), len(ids_b), groups, links))
    counts = Counter(link for f in found if f for link in f[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for i, f in enumerate(found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((
            i, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return out


def _characters() -> list[str]:
    """The byte-level alphabet: byte by byte, printable ones themselves, the rest from 256 on."""
    out, extra = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            out.append(chr(byte))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def aligned(spark, texts, settings=Settings()):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = alignment.align(docs, *PATHS, settings).collect()
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    for row in rows:
        assert row["groups_sha256"] == (hashlib.sha256(row["groups"].encode()).hexdigest() if row["groups"] else "")
    return sorted(tuple(r[n] for n in names) for r in rows)


def test_odd_texts(spark):
    assert aligned(spark, TEXTS) == plain(TEXTS)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    assert aligned(spark, texts) == plain(texts)


def test_links_meet_their_counts_by_key(spark):
    assert aligned(spark, TEXTS, Settings(broadcast_pairs=0)) == plain(TEXTS)


def test_segments_are_forgotten(spark):
    few = alignment.Aligner(*PATHS, Settings(keep_segments=2, keep_chars=3))
    many = alignment.Aligner(*PATHS, Settings())
    for _ in range(2):
        assert [few.align([t])[0] for t in TEXTS] == many.align(TEXTS)


def test_long_text(spark):
    text = "ab " * 300_000 + "x" * 3_000 + " \n" * 1_000
    (_, n_a, n_b, n_groups, n_links, *_, digest), = aligned(spark, [text])
    ids = alignment.tokenizers(*PATHS).a.encode(" " + text, add_special_tokens=False).ids
    assert (n_a, n_links) == (len(ids), n_groups) and n_b >= n_groups > 300_000 and digest


def test_empty_table_and_rows_without_id(spark):
    assert aligned(spark, []) == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    rows = [(r["doc_id"], r["n_links"]) for r in alignment.align(docs, *PATHS).collect()]
    assert sorted(rows, key=repr) == sorted([(None, 2), (None, 2), (1, 2), (1, 1)], key=repr)


@pytest.mark.parametrize("ids", [([], []), ([1, 2], [0])])
def test_slices(ids):
    bytes_a, bytes_b = [b"", b"x", b"yz"], [b"xyz"]
    assert list(alignment.slices(*ids, bytes_a, bytes_b)) == ([(3, 2, 1)] if ids[0] else [])
