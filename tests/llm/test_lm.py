"""The backoff automaton against a dictionary of n-grams."""

import math
import re
import zlib
from collections import Counter

import pytest

from textlens.llm import lm

ROWS = [
    (1, "The cat sat on the mat", "x"), (2, "the cat sat", "x"), (3, None, None), (4, "", "y"), (None, "a cat\x0bA\x1cb cat", "z"),
    (5, "The cat sat on the mat", "x"), (5, "The cat sat on the mat", "x"), (7, "zebra " * 300 + "the cat", "w"), (9, "über Ünder the", "w"),
    (10, "cat cat cat", "x"), (11, "mat the on sat", "q"), (12, "unseen words only here", "q"),
]


def brute(rows, discount):
    tokens = {}
    for i, (key, text, _) in enumerate(rows):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        tokens[i] = re.findall(r"[^\x20\x09-\x0D]+", folded) + ["</s>"]
    held = {i: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for i, r in enumerate(rows)}
    c1, c2, kinds = Counter(), Counter(), Counter()
    for i, t in tokens.items():
        if not held[i]:
            c1.update(t)
            c1["<s>"] += 1
            c2.update(zip(["<s>"] + t, t))
    for h, _ in c2:
        kinds[h] += 1
    known = {w: c for w, c in c1.items() if w != "<s>"}
    n, v = sum(known.values()), len(known)
    out = []
    for i, t in tokens.items():
        base = score = 0.0
        for h, w in zip(["<s>"] + t, t):
            p1 = (known.get(w, 0) + 1) / (n + v + 1)
            p = p1 if not c1[h] else max(c2[h, w] - discount, 0) / c1[h] + discount * kinds[h] / c1[h] * p1
            base, score = base + math.log10(p1), score + math.log10(p)
        out.append((rows[i][0], held[i], len(t), sum(w in known for w in t), n, base, score))
    return out


@pytest.mark.parametrize("batch_bytes", [1 << 20, 40])
def test_same_as_brute_force(spark, batch_bytes):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, score string").withColumn("held_out", lm.held_out())
    got = lm.score(df, df["held_out"], ["doc_id", "text"], batch_bytes=batch_bytes)
    rows = got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    wanted = sorted(brute(ROWS, lm.DISCOUNT), key=key)
    for g, w in zip(sorted(map(tuple, rows), key=key), wanted, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string").withColumn("held_out", lm.held_out())
    assert lm.score(df, df["held_out"], ["doc_id", "text"]).count() == 0


def test_all_held_out(spark):
    df = spark.createDataFrame([(3, "a b")], "doc_id long, text string").selectExpr("*", "true AS held_out")
    row = lm.score(df, df["held_out"], ["doc_id", "text"]).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == pytest.approx(0.0)
