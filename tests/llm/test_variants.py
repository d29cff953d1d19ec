"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from textlens.llm import variants as V


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(rows):
    counts = Counter()
    for id_, text in rows:
        low = (text or "").translate(str.maketrans(V.ascii_uppercase, V.ascii_lowercase))
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for w in n:
        close = [x for x in n if one_edit(w, x)]
        near[w] = len(close)
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n.get(form[w])))
    return sorted(out)


def run(spark, rows, schema="doc_id long, text string"):
    return sorted(tuple(r) for r in V.group_variants(spark.createDataFrame(rows, schema)).collect())


def varied(seed, letters, lengths, words=60):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(words)]
    out = []
    for _ in range(3000):
        w = list(r.choice(base[: 1 + r.randrange(words)]))
        while r.random() < 0.35:
            k = r.randrange(len(w) + 1)
            w[k : k + r.randrange(2)] = r.choice(["", r.choice(letters)])
        out.append("".join(w))
    return [(i, " ".join(out[i * 50 : i * 50 + 50])) for i in range(60)]


def test_equal_to_all_pairs(spark):
    for seed, letters, lengths in ((1, "abc", (4, 5, 6)), (2, "abÀÿ", (5, 6, 7, 8, 9)), (3, "Aab", (6,)), (4, "aé", (10, 11, 12, 13))):
        rows = varied(seed, letters, lengths)
        assert run(spark, rows) == brute(rows)


def test_every_single_edit_meets(spark):
    """Any edit at any place of words of 5 to 12 letters, chunks on either side."""
    rows, letters = [], "bcdefghijklmnopqrst"
    for n in range(5, 13):
        w = letters[:n]
        edits = {w[:k] + e + w[k + d :] for k in range(n + 1) for e in ("", "z") for d in (0, 1)} - {w}
        pairs = spark.createDataFrame([(w, 9)] + [(e, 3) for e in edits], "word string, n long")
        near = V.near_pairs(pairs).collect()
        assert {r["long_word"] if r["word"] == w else r["word"] for r in near if w in (r["word"], r["long_word"])} == edits
        rows += near
    assert rows


def test_chain_of_forms(spark):
    rows = [(1, "stone " * 40 + "stones " * 20 + "stoness " * 10 + "stonesss " * 5)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got["stonesss"][1:3] == ("stoness", "stone") and got["stone"][1:3] == (None, "stone")
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long_word = "ab" * 20_000
    rows = [
        (None, "Hello hello HELLO hallo hallo hallo"), (None, "Hello hello HELLO"), (None, None), (5, None), (6, ""), (7, " ... 123"),
        (8, f"{long_word} {long_word} {long_word} {long_word}c {long_word}c {long_word}c"), (8, "ÀÈÌòù àèìòù ÀÈÌòù"), (8, "ÀÈÌòù àèìòù ÀÈÌòù"),
        (9, "ties1aaaab aaaab aaaab aaaac aaaac aaaac aaaaa aaaaa aaaaa"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    rows = [(k, "words words word", "x", 1, "r") for k in range(9)]
    got = run(spark, rows, "doc_id long, text string, word string, n int, root string")
    assert got == brute([r[:2] for r in rows])


def test_frequent_word_is_one_row(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("common common common").alias("text"))
    assert V.vocabulary(V.runs(docs)).where("word = 'common'").count() == 1
