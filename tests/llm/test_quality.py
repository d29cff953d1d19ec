"""Measures against plain counting."""

import re
from collections import Counter

from textlens.llm import quality as Q

TEXTS = [
    None, "", " \n ", "one", "a b c a b c", "x " * 60, "x y z " * 100 + "end", "$$ ** <a> & | #", "l1\nl1\n\n l1\n \nl1", "é\x1cé 🙂 \x0b\x0c\r\tz",
    " ".join("w%d" % k for k in range(300)) + " " + " ".join("w%d" % k for k in range(200)), "the of and to in " + " ".join("v%d" % k for k in range(60)),
    "a b c x a b c y b c x a", "SHOUT!! " * 2 + "the quick brown fox " * 20, " ".join("w%d" % (k % 97) for k in range(5000)),
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def test_measures(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "7 AS n_words", "'w' AS words")
    rows = Q.judge(df).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        wanted = brute(r["text"])
        assert {k: r[k] for k in wanted} == wanted, r["text"]
        assert r["kept"] == (not r["base_failed"] and r["broken_rules"] == "")


def test_both_ways_to_count_repeats_agree(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    looked_up = {r["doc_id"]: r["n_repeat_words"] for r in Q.measure(df).collect()}
    monkeypatch.setattr(Q, "LOOKED_UP", 0)
    assert looked_up == {r["doc_id"]: r["n_repeat_words"] for r in Q.measure(df).collect()}


def test_keep_good_returns_the_columns_of_its_input(spark):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "n_words long, text string, source string")
    kept = Q.keep_good(df)
    assert kept.columns == df.columns and {r["n_words"] for r in kept.collect()} == {11}
    assert Q.keep_good(df.limit(0)).count() == 0


def test_plan_has_no_user_function_and_no_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = Q.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
