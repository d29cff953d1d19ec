"""Centroid clustering against every vector compared with every centroid."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.llm import clustering as C

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, width=4, scale=64, seed=1):
    kept = []
    for id_, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            x = [max(min(float(np.float32(a)) * scale, C.LIMIT), -C.LIMIT) for a in v]
            kept.append((id_, [math.floor(a) for a in x]))
    digest = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((distance(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[near(v)[1]].append(v)
        centroids = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, centroids)]
    found = [(i, near(v)) for i, v in kept]
    own = lambda j: sum(d for _, (d, c) in found if c == j)
    total = sum(d for _, (d, _) in found)
    name = lambda j: hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()
    return sorted(((i, j, d, own(j), total, name(j)) for i, (d, j) in found), key=str)


def run(spark, rows, k=3, rounds=3, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = C.cluster(df, k=k, rounds=rounds, width=4, **options).drop("compared").collect()
    return sorted((tuple(r) for r in got), key=str)


def clouds(n, centres=6, width=4, seed=0):
    r = np.random.default_rng(seed)
    middle = r.normal(0, 3, (centres, width))
    return [(i, [float(x) for x in middle[i % centres] + r.normal(0, 0.05, width)]) for i in range(n)]


def test_equal_to_all_comparisons(spark):
    rows = clouds(400)
    assert run(spark, rows, k=6, block=16) == brute(rows, 6, 3)


def test_boxes_leave_few_centroids(spark):
    df = spark.createDataFrame(clouds(2000, width=64), SCHEMA)
    compared = C.cluster(df, k=6, block=32).agg(F.avg("compared")).first()[0]
    assert compared < 3


def test_block_size_changes_nothing(spark):
    rows = clouds(100)
    assert run(spark, rows, block=1) == run(spark, rows, block=7) == run(spark, rows, block=1000)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 0.25, 0.0, 1.0]), (1, [0.5, 0.25, 0.0, 1.0]), (2, [0.5, 0.25, 0.0, 1.0]), (1, [0.1, 0.2, 0.3, 0.4]),
        (None, [-0.01, 0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0, 9.0]),
        (3, None), (4, []), (5, [1.0]), (6, [1.0] * 5), (7, [nan, 0.0, 0.0, 0.0]), (8, [inf, 0.0, 0.0, 0.0]), (9, [None, 0.0, 0.0, 0.0]),
        (10, [3e38, -3e38, 0.0, 0.0]), (11, [1e5, 2e5, -3e5, 4e5]),
    ]
    for k in (1, 2, 3, 50):
        assert run(spark, rows, k=k) == brute(rows, k, 3)


def test_nothing_to_cluster(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_other_columns_and_id_types(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0, 3.0, 4.0], 7, 8)], "cluster string, v array<double>, distance int, id int")
    row = C.cluster(df, "cluster", "v", k=2, width=4).select("distance", "inertia").first()
    assert tuple(row) == (0, 0)


def test_equal_vectors_are_dealt_out(spark):
    df = spark.range(5000).select(F.lit(1).alias("vec_id"), F.array(*[F.lit(0.5)] * 4).alias("embedding")).repartition(8)
    zones = C.ZoneMap(df, "vec_id", "embedding", width=4)
    assert zones.blocks.count() > 1
    assert C.cluster(df, width=4).agg(F.count("*"), F.max("distance")).first()[:] == (5000, 0)


@pytest.mark.parametrize("axes, bits", [(1, 5), (2, 4), (3, 3), (8, 1)])
def test_curve_steps_to_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    order = np.argsort(C.hilbert(cells.astype(np.uint64), bits))
    steps = np.abs(np.diff(cells[order], axis=0)).sum(1)
    assert (steps == 1).all()


def test_candidates_never_lose_the_nearest():
    r = np.random.default_rng(1)
    for _ in range(200):
        v, c = r.integers(-50, 50, (6, 3)), r.integers(-50, 50, (8, 3))
        got, distance, _ = C.nearest(v, v.min(0), v.max(0), c)
        all_ = ((v[:, None] - c[None]) ** 2).sum(2)
        assert (got == all_.argmin(1)).all() and (distance == all_.min(1)).all()
