"""Ids against tiktoken, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from textlens.llm.bpe import ByteBPE, _unpack_words, add_ids, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "Hello world, it's we're THEY'LL 'tis 12345 !!!", "  two  spaces \n\n\t tab  nbsp em \x1c\x85", "é漢字🙂👩‍👩‍👧 ñandú",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa aaa ababababab", " " * 300 + "x", "=" * 77, "Thntblere haedreanti of then, edtioner", "<|endoftext|>", "\x00\x01​﻿",
    "".join(random.Random(1).choice("abcdefgh") for _ in range(400)), "9" * 500,
]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.mark.parametrize("frequent", [0, 3, 100])
def test_same_ids_as_tiktoken(spark, ranks, frequent):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'w' AS word", "0 AS ids").repartition(2)
    bpe = ByteBPE(ranks, public_tokenizers.PATTERN)
    if frequent:
        bpe.with_frequent(df, most=frequent)
    for r in add_ids(df, bpe).collect():
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text), text
        assert bytes(r["decoded"]) == text.encode()


def test_higher_order_functions_alone_give_the_same_ids(spark, ranks):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)
    rows = df.withColumn("ids", ByteBPE(ranks, public_tokenizers.PATTERN).encode_column(df["text"])).collect()
    assert all(r["ids"] == reference.encode_ordinary(r["text"] or "") for r in rows)


def test_whole_table(spark):
    from textlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op6_byte_bpe"][0](spark, sf).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_empty_table(spark, ranks):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert add_ids(empty, ByteBPE(ranks, public_tokenizers.PATTERN).with_frequent(empty)).count() == 0


def test_long_words_by_heap(ranks):
    from textlens.llm import bpe

    rng = random.Random(3)
    for letters, n in (("ab", 300), ("abcdefgh", 500), ("theran", 400), ("é1 ", 300), ("a", 1000)):
        word = "".join(rng.choice(letters) for _ in range(n)).encode()
        assert bpe.merge_long(word, ranks) == slow_merge(word, ranks)
    assert [bpe.merge_long(w, ranks) for w in (b"a", b"ab", b"qz")] == [slow_merge(w, ranks) for w in (b"a", b"ab", b"qz")]


def slow_merge(word, ranks):
    parts = [word[k : k + 1] for k in range(len(word))]
    while True:
        pairs = [(ranks[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        k = min(pairs)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_a_million_letters(spark, ranks):
    import time

    rng = random.Random(5)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    start = time.time()
    rows = add_ids(df, ByteBPE(ranks, public_tokenizers.PATTERN).with_frequent(df)).collect()
    assert time.time() - start < 60
    assert rows[0]["ids"] == rows[1]["ids"] == reference.encode_ordinary(text)


def test_threshold_of_counts(spark, ranks):
    """Words as frequent as the smallest count that keeps them within the bound; ties stay together."""
    from textlens.llm.bpe import _unpack_words

    df = spark.createDataFrame([(1, "a" + " b" * 9 + " c" * 5 + " d" * 5 + " e" * 2)], "doc_id long, text string")
    words = lambda most: set(_unpack_words(ByteBPE(ranks, public_tokenizers.PATTERN).with_frequent(df, most=most).frequent))
    assert [words(n) for n in (0, 1, 2, 3, 4, 9)] == [set(), {" b"}, {" b"}, {" b", " c", " d"}, {" b", " c", " d", " e"}, {"a", " b", " c", " d", " e"}]


def test_rank_map_is_in_a_plan_without_shuffle(spark, ranks):
    """A plan with shuffles is made anew, and held as text by the driver, after each of them."""
    bpe = ByteBPE(ranks, public_tokenizers.PATTERN)
    words = spark.createDataFrame([("the",), (" end",)], "word string").repartition(3)
    packed = bpe.packed(words)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    of = {word: ids for r in packed.collect() for word, ids in _unpack_words([bytes(r["packed"])]).items()}
    assert of == {"the": [ranks[b"the"]], " end": [ranks[b" end"]]}
