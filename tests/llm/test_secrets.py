"""Spans against a plain regular-expression scan and a direct entropy computation."""

import math
import random
import re
from collections import Counter

from textlens.llm import secrets as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def entropy_span(candidate, bits):
    hot = []
    for i in range(len(candidate) - S.WINDOW + 1):
        counts = Counter(candidate[i : i + S.WINDOW]).values()
        h = math.log2(S.WINDOW) - sum(c * math.log2(c) for c in counts) / S.WINDOW
        if h >= bits - 1e-9:
            hot.append(i)
    return (hot[0], hot[-1] + S.WINDOW) if hot else None


def extra(text):
    known, out = base(text), []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or ""):
        if not re.search("[0-9]|[a-z][A-Z]", m[0]):
            continue
        # What the pattern spans leave of the candidate, piece by piece.
        taken = [False] * len(m[0])
        for a, _, b in known:
            for k in range(max(a, m.start()), min(b, m.end())):
                taken[k - m.start()] = True
        k = 0
        while k < len(taken):
            end = k
            while end < len(taken) and not taken[end]:
                end += 1
            piece, start = m[0][k:end], m.start() + k
            if end - k >= S.WINDOW:
                if end < len(taken):
                    piece = piece.rstrip(S.JOINS)
                if k > 0:
                    start += len(piece) - len(piece.lstrip(S.JOINS))
                    piece = piece.lstrip(S.JOINS)
                kind = next((c for c in S.CLASSES if re.match(c[1], piece)), None)
                if kind and len(piece) >= S.WINDOW and not any(re.search(p, piece) for p in S.ALLOWED):
                    span = entropy_span(piece, kind[2])
                    if span:
                        out.append((start + span[0], 3, start + span[1]))
            k = end + 1
    return sorted(known + out)


def texts():
    rng = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = lambda n, a=alphabet: "".join(rng.choice(a) for _ in range(n))
    out = [None, "", " ", "🙂" * 5 + ' Password = "' + secret(9) + '"', "token=token: abcdefgh", "token=short token = longenough", "API_KEY:'" + secret(8),
           "xAKIA" + secret(16, "ABC123") + " AKIAshort AKIA" + "Q" * 15, "deadbeef" * 3, "deadbeef" * 4 + "deadbee", "ſecret=abcdefgh", "apikey=a.b.c.d",
           "secret=secret=secret", "é" * 30 + " " + secret(40) + "é", "123e4567-e89b-12d3-a456-426614174000", "this-is_a-long-name-v2", "0" * 40,
           "x" * 19 + "1", "aaaaaaaaaaaaaaaaaaaaaaaaaa1 and " + secret(60) + "aaaaaaaaaaaaaaaaaaaaaaaaaa", "EXAMPLE" + secret(30), secret(200000)]
    for _ in range(60):
        parts = [rng.choice(["word", "thé", "the:", secret(rng.randint(3, 50)), secret(rng.randint(10, 45), "0123456789abcdef"), "passwd=" + secret(rng.randint(2, 12))]) for _ in range(30)]
        out.append(rng.choice([" ", ",", "\n"]).join(parts))
    return out


def test_spans(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS spans", "1 AS __at")
    for r in S.scan(df).select("doc_id", "text", "base_spans", "spans").collect():
        as_tuples = lambda a: [(s["start"], s["rank"], s["end"]) for s in a]
        assert as_tuples(r["base_spans"]) == base(r["text"]), r["text"]
        assert as_tuples(r["spans"]) == extra(r["text"]), r["text"][:300]


def test_entropy_finds_what_patterns_miss(spark):
    df = spark.createDataFrame([(1, "key zQ8xV2mK9pL4nR7tW3yB6cD1 end"), (2, "clean words only, nothing-to-see here 2024")], "doc_id long, text string")
    found = {r["doc_id"]: [s["rank"] for s in r["spans"]] for r in S.scan(df).collect()}
    assert found == {1: [3], 2: []}


def test_redact(spark):
    rows = [(1, "a password=hunter2x b AKIA" + "A1" * 10 + " c", "t"), (2, "clean", "t"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: r["text"] for r in S.redact(df).collect()}
    assert got == {1: "a [SECRET] b [SECRET] c", 2: "clean", 3: None}
    assert S.redact(df).columns == df.columns and S.redact(df.limit(0)).count() == 0


def test_listed(spark):
    df = S.scan(spark.createDataFrame([(1, "token=abcdef0123456789abcdef01")], "doc_id long, text string"))
    assert df.select(S.listed(df["base_spans"]).alias("s")).first()["s"] == "assign:0:30,hex:6:30"


def test_keys_of_every_alphabet_are_found(spark):
    rng = random.Random(3)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    kinds = {"upper hex": ("0123456789ABCDEF", 0.9), "base32": (upper + "234567", 0.9), "letters": (upper + lower, 0.8)}
    rows, n = [], 100
    for kind, (alphabet, _) in kinds.items():
        rows += [(f"{kind}/{size}", "key " + "".join(rng.choice(alphabet) for _ in range(size)) + " end") for size in (20, 32, 40, 64) for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = Counter(r["doc_id"] for r in S.scan(df).where("size(spans) > size(base_spans)").collect())
    for kind, (_, share) in kinds.items():
        assert all(found[f"{kind}/{size}"] >= share * n for size in (20, 32, 40, 64)), found
    names = ["getElementsByClassNameAndTag", "org/apache/spark/SparkContext", "parseHtmlDocumentFragment", "AVERYLONGCONSTANTNAME", "internationalisation"]
    plain = spark.createDataFrame([(k, t) for k, t in enumerate(names)], "doc_id long, text string")
    assert all(r["spans"] == [] for r in S.scan(plain).collect())


def test_what_a_pattern_leaves_of_a_candidate_is_scanned(spark):
    access, secret = "AKIA" + "Q7XW" * 4, "zQ8xV2mK9pL4nR7tW3yB6cD1zQ8xV2mK9pL4nR7t"
    rows = [(1, f"a {access}/{secret} b"), (2, f"a {secret}/{access} b"), (3, f"a {access}/short1 b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: [(s["start"], s["rank"], s["end"]) for s in r["spans"]] for r in S.scan(df).collect()}
    assert spans == {1: [(2, 1, 22), (23, 3, 63)], 2: [(2, 3, 42), (43, 1, 63)], 3: [(2, 1, 22)]}
    cleaned = {r["doc_id"]: r["text"] for r in S.redact(df).collect()}
    assert cleaned == {1: "a [SECRET]/[SECRET] b", 2: "a [SECRET]/[SECRET] b", 3: "a [SECRET]/short1 b"}


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
