"""Problems 4, 7 and 8: tokenizers against their libraries, and the packing's rules."""

import base64

import numpy as np
import pytest
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from budgetloom.llm import packing, tokens
from budgetloom.llm.merges import ByteEncoder, PieceCounter

TRICKY = [
    None, "", " ", "   ", "a" * 9000, "ab" * 4001, " " * 3000 + "x", "aaaaaaa" * 3 + "b", "\x1c x\x85y z", "½Ⅷ№ x'S 'll don't", "<|endoftext|> [PAD] </s>", "Grüße, naïve café́ 🙂👩‍🌾", "下雨的时候,果树旁边的路很滑。",
    "tabs\tand\r\nlines\n\n\nend  ", "1234567890" * 50, "﻿​", "ha " * 500,
]


@pytest.fixture(scope="module")
def byte():
    return ByteEncoder(P.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def piece():
    return PieceCounter(P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def ids_of(byte, texts):
    flat, sizes = byte.encode(texts)
    ends = np.cumsum(sizes)
    return [flat[a:b].tolist() for a, b in zip(ends - sizes, ends)]


def test_tricky_texts(byte, piece, tik, sp):
    assert ids_of(byte, TRICKY) == [tik.encode_ordinary(t) if t else [] for t in TRICKY]
    assert piece.count(TRICKY).tolist() == [len(sp.encode(t)) if t else 0 for t in TRICKY]
    assert byte.count(TRICKY).tolist() == [len(x) for x in ids_of(byte, TRICKY)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(byte, piece, tik, sp, texts):
    assert ids_of(byte, texts) == [tik.encode_ordinary(t) for t in texts]
    assert piece.count(texts).tolist() == [len(sp.encode(t)) for t in texts]


def test_encode_table(spark, tik):
    df = spark.createDataFrame([(i, t, "x", [9]) for i, t in enumerate(TRICKY)], "doc_id long, text string, n_tokens string, ids array<int>")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_ids(df, "doc_id", "text").collect()}
    assert got == {i: tik.encode_ordinary(t) if t else [] for i, t in enumerate(TRICKY)}
    assert tokens.encode_ids(df.limit(0), "doc_id", "text").count() == 0


def test_wrong_counts(spark, sp):
    long = "The quick brown fox jumps over the lazy dog and then it sleeps for a while."
    n = len(sp.encode(long))
    rows = [(1, "a", long, n), (1, "a", long, n), (2, "a", long, 2 * n + 1), (3, "a", long, None), (4, "a", long, -1), (5, "a", "word", 0), (6, "a", "...", 0), (7, "a", None, 0), (8, "a", "", None), (9, "a", "word", 500), (10, "a", long, n // 2 - 1), (10, "a", long, n // 2 - 1), (11, "a", long, 2 * n)]
    df = spark.createDataFrame(rows, "orig_doc_id long, source_prompt string, text string, tokens_llama2 int").withColumn("n_chars", F.lit("clash"))
    assert sorted(r["orig_doc_id"] for r in tokens.wrong_counts(df).collect()) == [2, 3, 4, 5, 8, 10]
    assert tokens.wrong_counts(df.limit(0)).count() == 0


def test_budget_counts_repeats_once(spark):
    final = spark.createDataFrame([(1, "original", "one two"), (1, "original", "one two"), (2, "distill", None)], "orig_doc_id long, source_prompt string, text string")
    pool = spark.createDataFrame([(1, "en", " Weaving "), (1, "en", " Weaving ")], "doc_id long, lang string, topic string")
    got = {(r["source_prompt"], r["lang"], r["topic"]): (r["n_docs"], r["n_tokens"]) for r in tokens.token_budget(final, pool).collect()}
    assert got == {("original", "en", "weaving"): (1, 2), ("distill", "(none)", "(none)"): (1, 0)}


def packed(spark, sizes, capacity):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "doc_id long, n long")
    return packing.pack(df, "doc_id", "n", capacity).collect()


@pytest.mark.parametrize("sizes,capacity", [([5, 5, 5, 5], 10), ([3] * 101, 10), ([None, 0, -3, 7], 7), ([25, 10, 11, 1, 4], 10), ([], 10), ([1] * 1000 + [9] * 3, 9), (list(range(1, 200)), 256)])
def test_packing_rules(spark, sizes, capacity):
    rows = packed(spark, sizes, capacity)
    load, parts = {}, {}
    for r in rows:
        load[r["container_id"]] = load.get(r["container_id"], 0) + r["tokens"]
        parts.setdefault(r["doc_id"], []).append((r["part"], r["tokens"]))
    assert all(t <= capacity for t in load.values())
    assert sorted(parts) == list(range(len(sizes)))
    for i, s in enumerate(sizes):
        s = max(0, s or 0)
        assert sum(t for _, t in parts[i]) == s
        assert len(parts[i]) == (1 if s <= capacity else -(-s // capacity)) and sorted(p for p, _ in parts[i]) == list(range(len(parts[i])))
    assert sorted(load) == list(range(len(load)))


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    counts = {}
    for s in rng.lognormal(5.5, 0.7, 20_000).astype(int).clip(1, 2048):
        counts[int(s)] = counts.get(int(s), 0) + 1
    runs = packing.plan_runs(counts, 2048)
    used = {}
    for taken, times in runs:
        assert sum(s * n for s, n in taken.items()) <= 2048
        for s, n in taken.items():
            used[s] = used.get(s, 0) + n * times
    assert used == counts
    least = -(-sum(s * n for s, n in counts.items()) // 2048)
    assert sum(t for _, t in runs) <= least * 1.01


def test_ranks_are_dense_and_stable(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 2).alias("g"))
    got = tokens.salted_rank(df, ["g"], ["k"], salts=4).collect()
    for g in (0, 1):
        assert sorted(r["rank"] for r in got if r["g"] == g) == list(range(150))
    again = {(r["k"], r["rank"]) for r in tokens.salted_rank(df.repartition(9), ["g"], ["k"], salts=4).collect()}
    assert again == {(r["k"], r["rank"]) for r in got}
