"""Centroid clustering over a Hilbert-ordered zone map of the vectors.

Components become integers, ``floor(scale * x)``, so every distance, sum and mean below is exact. Vectors are
put in the order of a Hilbert curve through their first principal axes (a curve through all 64 dimensions would have
spent its leading bits on the signs of a few of them), and runs of ``BLOCK`` neighbours become blocks: ids, a
packed matrix, and the box of smallest and largest components. The blocks are written down once; they are the zone map.

A round reads them. Of two centroids the second can't be nearest anywhere in a box if even the corner of the box that
favours it most is closer to the first; so each block keeps, beside the centroid nearest to its middle, those that
pass this test, and compares its vectors with these only, exactly. A task sends its sums and counts for each centroid, Spark adds
them up, and ``k * (width + 1)`` numbers reach the driver, whatever the number of vectors. The vectors move once.

Blocks change the work, never the result. Equal vectors, a third of all rows for instance, fall into blocks whose box is a
point; they are dealt out by id and position, so no task gets them all.

Defined results: rows whose vector is null, has another length, or a null or non-finite component are left out. Components
beyond ``LIMIT`` count as ``LIMIT`` (distances then still fit a long). The first centroids are the vectors with the smallest
hash of ``seed:id``; rows with equal hashes come in the order of their vectors, null ids last. Fewer vectors than
centroids give fewer centroids; an empty table gives an empty result. Repeated rows count as rows. Only the id and the vector
are read, so other columns and their names don't matter. A sum of distances too large for a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textlens.llm.near_dup import saved

WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, 1
LIMIT = 1 << 27
BLOCK = 256
# The curve: principal axes, and bits of each.
AXES, BITS = 8, 8
# Sums of squares of numbers up to this are whole in double precision.
SMALL = 1 << 22
ROWS_AT_ONCE = 4096


def integers(vector: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that is left out."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    floor = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    return F.when((F.size(vector) == width) & F.coalesce(F.forall(doubles, sound), F.lit(False)), F.transform(doubles, floor))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def _moments(width: int):
    """Sums of components and of their products, a row for each: enough for the principal axes."""

    def run(batches):
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            x = np.ones((batch.num_rows, width + 1))
            x[:, 1:] = _matrix(batch.column("v"), width)
            total += x.T @ x
        cell = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel())], ["cell", "value"])

    return run


class Curve:
    """Place of a vector on a Hilbert curve through the first principal axes."""

    def __init__(self, moments: np.ndarray, axes: int = AXES, bits: int = BITS):
        n = max(moments[0, 0], 1.0)
        mean = moments[0, 1:] / n
        spread, turn = np.linalg.eigh(moments[1:, 1:] / n - np.outer(mean, mean))
        axes = min(axes, len(mean))
        self.mean, self.bits = mean, bits
        self.turn = turn[:, ::-1][:, :axes]
        self.reach = 3 * np.sqrt(np.maximum(spread[::-1][:axes], 1e-12))

    def place(self, x: np.ndarray) -> np.ndarray:
        cells = ((x - self.mean) @ self.turn / self.reach + 1) * (1 << (self.bits - 1))
        return hilbert(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.uint64), self.bits)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index along the curve of cells (n, axes); axes * bits may be 64 at most. Signed, in the order of the index.

    Bit planes are taken from the top; each one turns the lower planes so that the next cube continues the path.
    """
    x, axes = cells.copy(), cells.shape[1]
    for plane in range(bits - 1, 0, -1):
        bit, below = np.uint64(1 << plane), np.uint64((1 << plane) - 1)
        for axis in range(axes):
            set_ = (x[:, axis] & bit) > 0
            swap = np.where(set_, np.uint64(0), (x[:, 0] ^ x[:, axis]) & below)
            x[:, 0] ^= np.where(set_, below, swap)
            x[:, axis] ^= swap
    for axis in range(1, axes):
        x[:, axis] ^= x[:, axis - 1]
    turned = np.zeros(len(x), np.uint64)
    for plane in range(bits - 1, 0, -1):
        turned ^= np.where((x[:, -1] & np.uint64(1 << plane)) > 0, np.uint64((1 << plane) - 1), np.uint64(0))
    x ^= turned[:, None]
    index = np.zeros(len(x), np.uint64)
    for plane in range(bits - 1, -1, -1):
        for axis in range(axes):
            index = (index << np.uint64(1)) | ((x[:, axis] >> np.uint64(plane)) & np.uint64(1))
    return (index ^ np.uint64(1 << (axes * bits - 1 if axes * bits == 64 else 63))).view(np.int64)


def _placer(curve: Curve, width: int):
    def run(batches):
        for batch in batches:
            place = curve.place(_matrix(batch.column("v"), width).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    return run


def _blocker(width: int, size: int):
    """Runs of ``size`` rows as blocks with their boxes."""

    def block(ids: pa.Array, v: np.ndarray) -> pa.RecordBatch:
        one = lambda a: pa.array([a.astype(np.int32).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(v), one(v.min(0)), one(v.max(0))],
            ["ids", "v", "lo", "hi"],
        )

    def run(batches):
        ids, held = [], []
        rows = 0
        for batch in batches:
            ids.append(batch.column("id"))
            held.append(_matrix(batch.column("v"), width))
            rows += batch.num_rows
            if rows >= size:
                all_ids, v = pa.concat_arrays(ids), np.concatenate(held)
                whole = rows - rows % size
                for start in range(0, whole, size):
                    yield block(all_ids.slice(start, size), v[start : start + size])
                ids, held, rows = [all_ids.slice(whole)], [v[whole:]], rows - whole
        if rows:
            yield block(pa.concat_arrays(ids), np.concatenate(held))

    return run


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point of the box, ascending."""
    middle = (lo + hi) // 2
    first = int(((centroids - middle) ** 2).sum(1).argmin())
    # The corner of the box farthest towards each centroid, seen from the first one.
    corner = np.where(centroids > centroids[first], hi, lo)
    own = ((corner - centroids) ** 2).sum(1)
    return np.flatnonzero(own <= ((corner - centroids[first]) ** 2).sum(1))


def nearest(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, centroids compared) of a block's vectors, exactly."""
    few = candidates(lo, hi, centroids)
    c = centroids[few]
    if max(np.abs(lo).max(), np.abs(hi).max(), np.abs(c).max()) < SMALL:
        x, y = v.astype(np.float64), c.astype(np.float64)
        distance = ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    else:
        distance = np.stack([((v - one) ** 2).sum(1) for one in c], 1)
    best = distance.argmin(1)
    return few[best], distance[np.arange(len(v)), best], len(few)


def _opened(batches, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    width = centroids.shape[1]
    for batch in batches:
        blobs = [batch.column(name).to_pylist() for name in ("v", "lo", "hi")]
        for k, (v, lo, hi) in enumerate(zip(*blobs)):
            v, lo, hi = (np.frombuffer(x, np.int32).astype(np.int64) for x in (v, lo, hi))
            v = v.reshape(-1, width)
            yield batch.column("ids")[k].values, v, *nearest(v, lo, hi, centroids)


def _summer(centroids: np.ndarray):
    """Sums and counts of a task's vectors for each centroid."""
    k, width = centroids.shape

    def run(batches):
        total = np.zeros((k, width + 1), np.int64)
        for _, v, cluster, _, _ in _opened(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            found, begins = np.unique(cluster[order], return_index=True)
            total[found, :width] += np.add.reduceat(v[order], begins)
            total[found, width] += np.diff(np.append(begins, len(v)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "value"])

    return run


def _assigner(centroids: np.ndarray):
    def run(batches):
        for ids, v, cluster, distance, compared in _opened(batches, centroids):
            for start in range(0, len(v), ROWS_AT_ONCE):
                part = slice(start, start + ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, ROWS_AT_ONCE), pa.array(cluster[part].astype(np.int32)), pa.array(distance[part]),
                     pa.array(np.full(len(cluster[part]), compared, np.int32))],
                    ["id", "cluster", "distance", "compared"],
                )

    return run


class ZoneMap:
    """Blocks of vectors in Hilbert order with their boxes, and k-means rounds over them."""

    def __init__(
        self, vectors: DataFrame, id_column: str, vector: str, width: int = WIDTH, scale: int = SCALE, block: int = BLOCK,
    ):
        self.width = width
        slim = vectors.select(F.col(id_column).alias("id"), integers(F.col(vector), width, scale).alias("v"))
        self.vectors = slim.where("v IS NOT NULL")
        self.kind = slim.schema["id"].dataType.simpleString()
        sums = self.vectors.select("v").mapInArrow(_moments(width), "cell long, value double").groupBy("cell").agg(F.sum("value"))
        moments = np.zeros((width + 1) ** 2)
        for cell, value in sums.collect():  # (width + 1)^2 rows
            moments[cell] = value
        curve = Curve(moments.reshape(width + 1, width + 1))
        placed = self.vectors.mapInArrow(_placer(curve, width), f"id {self.kind}, v array<int>, place long")
        # Equal vectors are parted by id and, if that is equal too, by where they were read.
        keys = ["place", "tie", "at"]
        placed = placed.withColumns({"tie": F.xxhash64("id"), "at": F.monotonically_increasing_id()})
        ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "v")
        schema = f"ids array<{self.kind}>, v binary, lo binary, hi binary"
        self.blocks = saved(ordered.mapInArrow(_blocker(width, block), schema))

    def first_centroids(self, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
        digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
        rows = self.vectors.select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
        return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), self.width)

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """Centroids after one round: the floor of the mean of their vectors, in whole numbers."""
        sums = self.blocks.mapInArrow(_summer(centroids), "cell long, value long")
        sums = sums.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(28,0)")))
        total = [[0] * (self.width + 1) for _ in centroids]
        for cell, value in sums.collect():  # k * (width + 1) rows at most
            total[cell // (self.width + 1)][cell % (self.width + 1)] = int(value)
        new = [[s // n for s in row] if (n := row.pop()) else list(old) for row, old in zip(total, centroids)]
        return np.array(new, np.int64).reshape(centroids.shape)

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """(id, cluster, distance, compared): each vector's centroid, and how many its block compared."""
        return self.blocks.mapInArrow(_assigner(centroids), f"id {self.kind}, cluster int, distance long, compared int")


def centroid_name(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _long(total: int) -> int | None:
    return total if total < 1 << 63 else None


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    width: int = WIDTH, scale: int = SCALE, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared."""
    zones = ZoneMap(vectors, id_column, vector, width, scale, block)
    centroids = zones.first_centroids(k, seed)
    if not len(centroids):
        schema = f"{zones.kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared int"
        return vectors.sparkSession.createDataFrame([], f"`{id_column}` {schema}")
    for _ in range(rounds):
        centroids = zones.moved(centroids)
    rows = saved(zones.assigned(centroids))
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()  # k rows at most
    by = {r["cluster"]: int(r["total"]) for r in sums}
    own = F.lit([_long(by.get(c, 0)) or 0 for c in range(len(centroids))]).cast("array<bigint>")
    names = F.lit([centroid_name(c) for c in centroids])
    fits = F.lit([by.get(c, 0) < 1 << 63 for c in range(len(centroids))])
    return rows.select(
        F.col("id").alias(id_column), "cluster", "distance",
        F.when(F.get(fits, "cluster"), F.get(own, "cluster")).alias("cluster_inertia"),
        F.lit(_long(sum(by.values()))).cast("bigint").alias("inertia"),
        F.get(names, "cluster").alias("centroid_sha256"),
        "compared",
    )


def oracle_sql(embeddings: str = "embeddings", k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the query: every vector against every centroid, round by round."""
    steps = []
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT row, vec_id, v, min(struct_pack(d := d, num := num)) AS best FROM
            (SELECT row, vec_id, v, num, {distance} AS d FROM kept, c{r}) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT num, list(f ORDER BY i) AS c FROM (SELECT num, i, floor_div AS f FROM (
                SELECT best.num AS num, i, sum(v[i]) AS s, count(*) AS n,
                    CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END::BIGINT AS floor_div
                FROM a{r}, range(1, {WIDTH + 1}) t(i) GROUP BY ALL)) GROUP BY num),
            c{r + 1} AS MATERIALIZED (SELECT c{r}.num, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (num))""")
    return f"""
    WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
            list_transform(embedding, lambda x: floor(greatest(least(x::DOUBLE * {SCALE}, {LIMIT}), -{LIMIT}))::BIGINT) AS v
        FROM {embeddings} WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: isfinite(x))) = {WIDTH}),
    c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1)::INTEGER AS num, v AS c
        FROM kept QUALIFY num < {k}),
    {', '.join(steps)}
    SELECT vec_id, best.num AS cluster, best.d AS distance,
        (sum(best.d) OVER (PARTITION BY best.num))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON num = best.num"""
