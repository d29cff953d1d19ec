"""Leaked passages: exact, edited and hidden ones, against alignment by dynamic programming."""

import random
import re

import numpy as np
import pytest

from textlens.llm import decontaminate as D

RNG = random.Random(5)
WORDS = ["the", "of", "and", "to"] + ["w%d" % k for k in range(3000)]


def prose(n):
    return [RNG.choice(WORDS[:4]) if RNG.random() < 0.4 else RNG.choice(WORDS[4:]) for _ in range(n)]


ITEMS = [(k, prose(RNG.randint(15, 60))) for k in range(25)]


def edited(words, share):
    out = []
    for w in words:
        draw = RNG.random()
        if draw < share / 3:
            continue
        out.append(RNG.choice(WORDS) if draw < 2 * share / 3 else w)
        if draw > 1 - share / 3:
            out.append(RNG.choice(WORDS))
    return out


def documents():
    rows, leaked = [], set()
    for k in range(200):
        body = prose(RNG.randint(20, 400))
        if k % 2:
            for item, words in RNG.sample(ITEMS, RNG.randint(1, 2)):
                body += edited(words, RNG.choice([0, 0, 0.1, 0.25])) + prose(RNG.randint(0, 30))
                leaked.add((k, item))
        text = " ".join(w.upper() + "," if RNG.random() < 0.1 else w for w in body)
        rows.append((k, text))
    return rows, leaked


def brute(item, words):
    """Smith-Waterman score, cell by cell."""
    above = [0.0] * (len(words) + 1)
    best = 0.0
    for x in item:
        row = [0.0]
        for j, w in enumerate(words, 1):
            row.append(max(0.0, above[j - 1] + (D.MATCH if x == w else D.MISMATCH), above[j] + D.GAP, row[-1] + D.GAP))
        best, above = max(best, max(row)), row
    return best


def test_finds_what_was_planted_and_nothing_else(spark):
    rows, leaked = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS score")
    items = spark.createDataFrame([(k, " ".join(w)) for k, w in ITEMS], "item_id long, text string")
    found = D.leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == leaked
    texts = dict(rows)
    for r in found:
        words = re.findall(r"[0-9a-z]+", texts[r["doc_id"]].lower())
        item = dict(ITEMS)[r["item_id"]]
        assert r["score"] == pytest.approx(brute(item, words) / len(item), abs=0.02)
    blocks = D.leaks(docs, items, block_words=50).collect()
    assert {(r["doc_id"], r["item_id"]) for r in blocks} == leaked


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(2)
    pairs = [(rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64)) for _ in range(60)]
    score, first, end = D.align([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), s, x, y in zip(pairs, score, first, end):
        assert s == pytest.approx(brute(a.tolist(), b.tolist()))
        assert brute(a.tolist(), b.tolist()[x:y]) == pytest.approx(s)


def test_a_passage_in_every_document_is_still_found(spark):
    passage = " ".join(prose(30))
    docs = spark.createDataFrame([(k, " ".join(prose(20)) + " " + passage) for k in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert D.leaks(docs, items).count() == 300


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "alpha beta gamma"), (3, "x alpha, BETA gamma y"), (3, "x alpha, BETA gamma y"), (4, "solo")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Alpha beta gamma"), (2, None), (3, ""), (4, "solo"), (1, "Alpha beta gamma")], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["score"], r["start"], r["end"]) for r in D.leaks(docs, items).collect())
    assert got == sorted([("3", 1, 1.0, 1, 4)] * 4 + [("None", 1, 1.0, 0, 3)] * 2 + [("4", 4, 1.0, 0, 1)])
    assert D.leaks(docs.limit(0), items).count() == 0 and D.leaks(docs, items.limit(0)).count() == 0


def test_edited_copies_are_found_at_every_size(spark):
    rng = random.Random(9)
    vocabulary = ["v%d" % k for k in range(200)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, draw(30)) for k in range(20)]
    replaced = [(k, [rng.choice(vocabulary) if j % 3 == 2 else w for j, w in enumerate(words)]) for k, words in items]
    widened = [(100 + k, [x for w in words for x in (w, rng.choice(vocabulary))]) for k, words in items]
    copies = [(k, " ".join(draw(20) + words + draw(20))) for k, words in replaced + widened]
    clean = [(1000 + k, " ".join(draw(50))) for k in range(100)]
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    for times in (1, 30):
        docs = spark.createDataFrame(copies + clean * times, "doc_id long, text string")
        assert {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, table).collect()} == {(k, k % 100) for k, _ in copies}


def test_texts_with_many_links_are_halved(monkeypatch):
    words = [("w%d" % k) for k in range(30)]
    seeds = D.Seeds([(7, D._words([" ".join(words)])[0])])
    texts = ["clean words", " ".join(words), "", "x " + " ".join(words)]
    whole = D._best(seeds, texts)
    monkeypatch.setattr(D, "LINKS", 40)
    assert D._best(seeds, texts) == whole == [(1, 0, 1.0, 0, 30), (3, 0, 1.0, 1, 31)]


def test_long_verbatim_parts_leak_whatever_the_share(spark):
    rng = random.Random(4)
    draw = lambda n: [rng.choice(WORDS[4:]) for _ in range(n)]
    items = {1: draw(55), 2: draw(500)}
    changed = items[2][300:320]
    changed[8] = "other"
    body = lambda words: " ".join(draw(60) + words + draw(60))
    rows = [(1, body(items[1][10:31])), (2, body(items[2][100:299])), (3, body(items[2][40:53])), (4, body(changed)),
            (5, body(items[1][10:22])), (6, body(sum(([w, "gap", "gap"] for w in items[2][:40]), []))), (7, body([]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in D.leaks(docs, table).collect()}
    assert set(found) == {(1, 1), (2, 2), (3, 2), (4, 2)}
    assert (found[1, 1]["start"], found[1, 1]["end"]) == (60, 81) and found[1, 1]["score"] == pytest.approx(21 / 55)
    assert sorted(r["doc_id"] for r in D.without_leaks(docs, table).collect()) == [5, 6, 7]
