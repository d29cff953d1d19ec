"""Restored words, held-out accuracy and defined results."""

import random

import numpy as np
import pytest

from textlens.llm import queries, toxicity as X

RNG = random.Random(6)
PLAIN = ["ba", "ten", "lor", "mi", "sun", "der", "ka", "ol", "ti", "ran"]
BAD = ["idiot", "moron", "pathetic", "stupid", "trash"]


def word():
    return "".join(RNG.choice(PLAIN) for _ in range(RNG.randint(1, 4)))


def table(n):
    rows, labels = [], []
    for k in range(n):
        words = [word() for _ in range(RNG.randint(5, 60))]
        bad = k % 3 == 0
        for _ in range(RNG.randint(1, 3) if bad else 0):
            words.insert(RNG.randint(0, len(words)), RNG.choice(BAD))
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = table(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    marks = spark.createDataFrame(labels + [(1, 0), (3, 0), (None, 1), (5000, 1)], "doc_id long, toxic int")
    return X.fit(docs, marks, ~X.held_out())


def test_disguised_words_are_restored(fitted):
    disguised = {"1d10t": "idiot", "m0r0n": "moron", "s t u p i d": "stupid", "patheeeetic": "pathetic", "tr@sh": "trash", "s.t.u.p.i.d": "stupid", "tr4$h": "trash"}
    reader = X.Reader(fitted.model)
    for token, plain in disguised.items():
        assert X.restore(token, fitted.model) == plain
        assert plain in reader.words(f"sun ten {token} kalor")


def test_plain_texts_open_no_lattice():
    assert list(X.suspicious("plain words, with 2024 numbers and a b end.")) == []


def test_scores(spark, fitted):
    rows = [(1, "sun ten lor idiot ka", "x"), (2, "sun ten lor ka", "x"), (3, "sun m0r0n ka ten", "x"), (4, None, None), (5, "", "x"), (None, "what an i.d.i.o.t", "x"), (2, "sun ten lor ka", "x"), (7, "a" * 50000 + "4b" * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = fitted.score(df)
    assert got.columns == ["doc_id", "text", "score"]
    flags = sorted((str(r["doc_id"]), r["score"] >= 0.5) for r in got.collect())
    assert flags == sorted([("1", True), ("2", False), ("2", False), ("3", True), ("4", False), ("5", False), ("None", True), ("7", False)])
    assert fitted.score(df.limit(0)).count() == 0


def test_viterbi_is_the_cheapest_path(fitted):
    def paths(token, i=0, word="", price=0.0):
        if i == len(token):
            a, b, total = 1, 1, price
            for c in word:
                z = X._PLACE[c]
                total += float(fitted.model.cost[a, b, z])
                a, b = b, z
            yield total + float(fitted.model.cost[a, b, 1]), word
            return
        for letters, to, cost in X._options(token, i):
            yield from paths(token, to, word + letters, price + cost)

    for token in ("1d10t", "b4nn", "l1l|", "sss$t"):
        best = min(paths(token))
        assert X.restore(token, fitted.model) == best[1] or np.isclose(min(p for p, w in paths(token) if w == X.restore(token, fitted.model)), best[0])


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    judge = X.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), ~X.held_out())
    assert all(r["score"] < 1e-9 for r in judge.score(docs).collect())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    row = scored.selectExpr("avg(CASE WHEN predicted = toxic THEN 1.0 ELSE 0.0 END) AS a", "sum(CASE WHEN predicted = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS wrong").first()
    assert row["a"] >= 0.9 and row["wrong"] <= 2


def test_hidden_words_next_to_others_and_in_long_stretches(fitted):
    hidden = {
        "you are a i d i o t": ["idiot"], "y.o.u-s.t.u.p.i.d": ["stupid"], "s t u p i d m o r o n": ["stupid", "moron"],
        "t e n " * 30 + "i d i o t": ["idiot"], "i d i o t" + " k a" * 200: ["idiot*"], "mo" + "o" * 100 + "ron": ["moron"],
        "1 d 1 0 t": ["idiot"], "stu.pid": ["stupid"], "m-0-r0n": ["moron"], "idio7": ["idiot"], '"1diot': ["idiot"], "1-diot": ["idiot"],
    }
    reader = X.Reader(fitted.model)
    for text, plain in hidden.items():
        found = {f for w in reader.words(f"sun ten {text} kalor") for f in X.features(w)}
        assert found.issuperset(plain), text
        assert fitted.evidence(reader, f"sun ten {text} kalor") > 0


def test_a_long_stretch_is_read_once():
    assert list(X.suspicious("x" + "4b" * 500)) == ["x" + "4b" * 500]
    assert list(X.suspicious(" ".join("ab" * 300))) == [" ".join("ab" * 300)]
