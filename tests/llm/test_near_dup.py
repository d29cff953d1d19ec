"""Signatures against exact similarity, groups against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from textlens.llm import near_dup as N


def bag(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)])


def similarity(x, y):
    if not x or not y:
        return float(x == y)
    return sum((x & y).values()) / sum((x | y).values())


def brute(rows, similar=0.8):
    bags = [bag(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= similar:
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    out = []
    for ids in groups.values():
        known = [k for k in ids if k is not None]
        out += [(k, min(known) if known else None, len(ids)) for k in ids]
    return sorted(out, key=str)


def sample(seed=1):
    rng = random.Random(seed)
    words = ["w%d" % k for k in range(400)]
    rows, key = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 160))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((key, " ".join(copy)))
            key += 1
    chain = [rng.choice(words) for _ in range(200)]
    for _ in range(12):  # each like its neighbours, the ends far apart
        rows.append((key, "  ".join(chain)))
        key += 1
        chain = chain[12:] + [rng.choice(words) for _ in range(12)]
    rows += [(900 + k, "a b c") for k in range(3)] + [(910, "a b"), (911, ""), (912, None), (913, " \n"), (914, "x " * 300), (915, "x " * 310)]
    rows += [(None, rows[0][1]), (None, "lonely words that nobody else has at all"), (0, rows[0][1]), (5, "same id but other words here")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, seed):
    rows = sample(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS label", "3 AS band")
    got = sorted(map(tuple, N.Groups(df.repartition(3)).classes().collect()), key=str)
    assert got == brute(rows)


def test_keep_one_keeps_one_of_each_group(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS id")
    kept = N.keep_one(df)
    assert kept.columns == ["doc_id", "text", "id"]
    classes = {(k, c) for k, c, _ in brute(rows)}
    assert kept.count() == len({tuple(sorted(bag(t).items())) for _, t in rows} and groups_of(rows))
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} <= {c for _, c in classes}


def groups_of(rows):
    bags = [bag(t) for _, t in rows]
    groups = []
    for b in bags:
        near = [g for g in groups if any(similarity(b, x) >= 0.8 for x in g)]
        groups = [g for g in groups if g not in near] + [[b] + [x for g in near for x in g]]
    return groups


def test_signature_is_unbiased():
    rng = random.Random(4)
    texts = []
    for _ in range(40):
        base = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(20, 60))]
        texts += [" ".join(base), " ".join(base * rng.randint(1, 3) + base[: rng.randint(0, 20)])]
    s = N.signatures(N.Bags([t.encode() for t in texts], 1), 2048)
    for i in range(0, len(texts), 2):
        wanted = similarity(bag(texts[i], 1), bag(texts[i + 1], 1))
        assert np.mean(s[i] == s[i + 1]) == pytest.approx(wanted, abs=0.06)


@pytest.mark.parametrize("few", [0, 1000])
def test_components_of_a_long_path(spark, monkeypatch, few):
    monkeypatch.setattr(N, "FEW_LINKS", few)
    path = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(100, 101)], "a long, b long"))
    labels = {r["node"]: r["label"] for r in N.components(path).collect()}
    assert {labels[k] for k in range(61)} == {0} and labels[101] == labels[100] == 100


def test_few_links_are_joined_in_one_pass(spark, monkeypatch):
    """The driver plans no round after round for few links, and the components are those of the rounds."""
    rng = random.Random(8)
    pairs = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(350)] + [(k, k + 1) for k in range(1000, 1060)] + [(7, 7), (None, 3)]
    links = spark.createDataFrame(pairs, "a long, b long")
    written, save = [], N.saved
    monkeypatch.setattr(N, "saved", lambda df: written.append(1) or save(df))
    joined = sorted(map(tuple, N.components(links).collect()))
    assert len(written) == 2
    monkeypatch.setattr(N, "FEW_LINKS", 0)
    assert joined == sorted(map(tuple, N.components(links).collect())) and len(written) > 5
    assert N.components(links.limit(0)).count() == 0


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert N.Groups(empty).classes().count() == 0 and N.keep_one(empty).count() == 0


def test_large_bands_in_blocks_find_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "LARGE", 2)
    monkeypatch.setattr(N, "BLOCK", 3)
    rows = sample(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, N.Groups(df).classes().collect()), key=str) == brute(rows)


def test_block_links_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    base = ["w%d" % rng.randrange(300) for _ in range(120)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(120)] = "w%d" % rng.randrange(300)
        texts.append(" ".join(copy))
    bags = N.Bags([t.encode() for t in texts])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = docs.mapInArrow(N._bag_blobs("text"), "node long, size long, bag binary")
    tied = rows.selectExpr("node", "1L AS group")
    links = N.compare_blocks(tied, spark.createDataFrame([], "node long, label long"), rows, 0.8)
    joined = {r["node"]: r["label"] for r in N.components(links).collect()} if links.count() else {}
    wanted = brute([(int(n), t) for n, t in zip(bags.nodes(), texts)])
    assert len({joined.get(n, n) for n in map(int, bags.nodes())}) == len({c for _, c, _ in wanted})


def test_components_are_compared_with_others_only(spark, monkeypatch):
    """Members of a component that has its own blocks meet those of other components, and each small one meets all."""
    monkeypatch.setattr(N, "BLOCK", 2)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join([f"x{j}", *words]) for j in range(9)]  # all alike
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = docs.mapInArrow(N._bag_blobs("text"), "node long, size long, bag binary")
    nodes = [r["node"] for r in rows.collect()]
    labels = spark.createDataFrame([(n, nodes[0] if k < 4 else nodes[4]) for k, n in enumerate(nodes[:8])], "node long, label long")
    links = N.compare_blocks(rows.selectExpr("node", "1L AS group"), labels, rows, 0.8).collect()
    of = {n: 0 if k < 4 else 1 if k < 8 else 2 for k, n in enumerate(nodes)}
    met = {tuple(sorted((of[r["a"]], of[r["b"]]))) for r in links}
    assert {(0, 1), (0, 2), (1, 2)} >= met and len(met) >= 2


def test_forest_keeps_components(spark):
    rng = random.Random(4)
    stars = {(rng.randrange(200), 1000 + rng.randrange(12)) for _ in range(900)}
    stars = spark.createDataFrame(sorted(stars), "node long, head long")
    few = N.forest(stars)
    assert few.count() < 200 + 12 * 12 < stars.count()
    assert sorted(map(tuple, N.components(few).collect())) == sorted(map(tuple, N.components(stars.toDF("a", "b")).collect()))
