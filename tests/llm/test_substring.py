"""Exact repeats against brute force over all windows."""

import random
import re

import pytest

from textlens.llm import substring


def brute(rows, window):
    words = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first = {}
    for k, w in words:
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            at = (k is not None, k, i)
            if g not in first or at < first[g]:
                first[g] = at
    out = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if (k is not None, k, i) > first[tuple(w[i : i + window])]:
                gone.update(range(i, i + window))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def sample():
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "the", "é", "x\x1cy"]) + rng.choice("pqrstuv")
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (6, 7, 9, 30)]
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(shared) if rng.random() < 0.5 else text(rng.randint(0, 25))
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(parts)))
    whole = " ".join(text(40))
    rows += [(200 + k, whole) for k in range(30)] + [(300, "p q " * 400), (301, ""), (302, None), (303, " \n")]
    rows += [(None, whole), (150, " ".join(text(12))), (150, rows[0][1] or "solo")]
    return rows


@pytest.mark.parametrize("batch_bytes", [1 << 20, 900])
@pytest.mark.parametrize("window", [6, 7])
def test_same_as_brute_force(spark, batch_bytes, window):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS n_words", "'k' AS bucket")
    got = substring.remove_repeats(df, window=window, batch_bytes=batch_bytes)
    assert set(got.columns) == {"doc_id", "text", "bucket", *substring.ADDED.fieldNames()}
    found = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()]
    assert sorted(found, key=lambda r: (r[0] is not None, r)) == brute(rows, window)


def test_spans_are_what_is_missing(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (2, "x a b c d e f y")], "doc_id long, text string")
    row = substring.remove_repeats(df, window=4).where("doc_id = 2").first()
    assert [tuple(s) for s in row["removed"]] == [(1, 7)] and row["kept_text"] == "x y"


def test_identical_rows_are_one_document(spark):
    df = spark.createDataFrame([(1, "a b c d e")] * 3, "doc_id long, text string")
    assert {r["n_removed"] for r in substring.remove_repeats(df, window=4).collect()} == {0}


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ids_of_other_types(spark):
    rows = [("b", "x a b c d e f y"), ("a", "a b c d e f g h"), (None, "c d e f"), ("a", "a b c d e f g h"), ("a", "q c d e f")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {(r["doc_id"], r["text"]): r["kept_text"] for r in substring.remove_repeats(df, window=4).collect()}
    assert got[None, "c d e f"] == "c d e f" and got["b", "x a b c d e f y"] == "x y"
    assert got["a", "a b c d e f g h"] == "a b g h" or got["a", "q c d e f"] == "q"
    numbers = df.selectExpr("CASE doc_id WHEN 'a' THEN 1 WHEN 'b' THEN 2 END AS doc_id", "text")
    same = sorted(map(str, substring.remove_repeats(numbers, window=4).select("text", "kept_text").collect()))
    assert sorted(map(str, substring.remove_repeats(df, window=4).select("text", "kept_text").collect())) == same
    assert substring.remove_repeats(df, window=4).columns == ["doc_id", "text", *substring.ADDED.fieldNames()]


def test_a_very_long_text(spark):
    text = " ".join(f"w{k}" for k in range(120_000))
    df = spark.createDataFrame([(1, text), (2, "start " + text + " end")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in substring.remove_repeats(df).collect()}
    assert rows[1]["n_removed"] == 0 and rows[2]["kept_text"] == "start end"
