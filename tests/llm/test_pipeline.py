"""Each stage against a direct computation on its own input."""

import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from textlens.llm import bpe, decontaminate, near_dup, quality, secrets
from textlens.llm.words import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        docs.count()
        out[name] = docs
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes
    assert stages[names[-1]].columns == ["doc_id", "n_tokens", "ids", "round_trip"]


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in quality.judge(stages["documents"]).where("kept").collect()}
    assert set(by_id(stages["quality_rules"])) == kept and 0 < len(kept) < stages["documents"].count()


def test_near_dedup_stage(stages):
    classes = near_dup.Groups(stages["quality_rules"]).classes().collect()
    assert set(by_id(stages["near_dedup"])) == {r["class_id"] for r in classes}


def test_decontamination_stage(spark, stages):
    leaks = {r["doc_id"] for r in decontaminate.leaks(stages["near_dedup"], table(spark, SF, "benchmark")).collect()}
    assert set(by_id(stages["benchmark_decontamination"])) == set(by_id(stages["near_dedup"])) - leaks


def test_secrets_stage(stages):
    before, after = by_id(stages["benchmark_decontamination"]), by_id(stages["secret_scans"])
    assert before.keys() == after.keys()
    left = secrets.scan(stages["secret_scans"]).selectExpr("sum(size(base_spans)) AS n").first()["n"]
    assert left == 0
    for key, row in after.items():
        assert row["n_chars"] == len(row["text"])
        assert "[SECRET]" in row["text"] or row["text"] == before[key]["text"]


def test_encoding_stage(stages):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = by_id(stages["secret_scans"])
    rows = by_id(stages["byte_bpe"])
    assert rows.keys() == texts.keys()
    for key, row in rows.items():
        assert row["round_trip"] and row["ids"] == reference.encode_ordinary(texts[key]["text"])


ODD = "doc_id long, text string, node string, spans int, kept string, ids int, label string"


def prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "and", "to", "is", "with", "that", "be", "have"]
    letters = "abcdefghijklmnop"
    made = [rng.choice(words) if rng.random() < 0.3 else "".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n)]
    return " ".join(made) + "."


def odd_rows():
    fine, other = prose(1, 150), prose(2, 150)
    texts = [(1, None), (2, ""), (3, " \n "), (4, fine), (4, fine), (5, fine), (None, other), (6, other + " password=hunter2secret the end."), (7, "short")]
    texts.append((8, prose(3, 100_000)))
    return [(i, t, "n", 1, "k", 2, "l") for i, t in texts]


@pytest.mark.parametrize("number", range(5))
def test_stage_on_odd_rows(spark, number):
    """Nulls, empty and very long texts, ties, repeated rows, an empty table, columns with the operators' own names."""
    docs = spark.createDataFrame(odd_rows(), ODD)
    name, stage = corpus_pipeline.STAGES[number]
    got = stage(spark, docs, SF).collect()
    assert stage(spark, docs.limit(0), SF).count() == 0
    ids = sorted(str(r["doc_id"]) for r in got)
    if name == "quality_rules":
        assert {"1", "2", "3", "7"}.isdisjoint(ids) and ids.count("4") == 2
    elif name == "near_dedup":
        assert ids == ["1", "4", "6", "7", "8"]
    elif name in ("benchmark_decontamination", "secret_scans"):
        assert len(got) == len(odd_rows())
    else:
        assert len(got) == len(odd_rows()) and all(r["round_trip"] for r in got)
        assert {r["doc_id"]: r["ids"] for r in got}[2] == []
    if name != "byte_bpe":
        assert got[0].__fields__ == docs.columns
        assert all((r["node"], r["spans"], r["kept"], r["ids"], r["label"]) == ("n", 1, "k", 2, "l") for r in got)
    if name == "secret_scans":
        texts = {r["doc_id"]: r["text"] for r in got}
        assert "[SECRET]" in texts[6] and texts[1] is None and texts[2] == ""
