"""Sharding by a permutation of global row numbers.

Every row has a global number: its rank by the MD5 of its values, so the number depends on the rows
alone, not on files, partitions or the cluster. A Feistel network over a x b >= N permutes the
numbers; a result outside 0..N-1 walks on along its cycle until it is inside. The place p of a row gives
its shard p % shards and slot p // shards, so shards differ by one row at most, slots have no gaps, and
both can be computed for any row number without the data.

Everything is DataFrame expressions. Ranks come from 4096 equal buckets of the MD5 space: their sizes
(at most 4096 numbers) go to the driver, and rows are ranked inside a bucket. Identical rows are counted
before anything is shuffled and numbered from the count, so no group of them lands in one task.

Defined results: any columns that can be grouped are allowed, nulls included (a null is not an
empty string); identical rows get different places, which of them gets which cannot be told apart.
An empty table gives an empty result. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

BUCKET_DIGITS = 3
DOUBLE_ROUNDS = 4
COPIES_AT_ONCE = 4096
SHARDS = 40
SEED = 20_24


def _hashed(value: Column, key: str) -> Column:
    """60 bits of the MD5 of ``key:value``, the same in any engine."""
    digest = F.md5(F.concat(F.lit(key + ":"), value.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sides(n: int) -> tuple[int, int]:
    """a x b >= n with as little to spare as two equal sides allow."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def permuted(number: Column, n: int, seed: int, rounds: int = DOUBLE_ROUNDS) -> Column:
    """One pass of the Feistel network: a bijection on 0..a*b-1."""
    a, b = sides(n)
    start = F.struct(F.floor(number / b).cast("bigint").alias("l"), F.pmod(number, F.lit(b)).cast("bigint").alias("r"))
    state = F.struct(start["l"].alias("l"), start["r"].alias("r"))
    for k in range(rounds):
        # Bound as a lambda variable, so that the expression does not double with every round.
        state = F.get(
            F.transform(
                F.array(state),
                lambda s: F.struct(
                    F.pmod(s["l"] + _hashed(s["r"], f"{seed}:{k}:l"), F.lit(a)).cast("bigint").alias("l"), s["r"].alias("r")
                ),
            ),
            F.lit(0),
        )
        state = F.get(
            F.transform(
                F.array(state),
                lambda s: F.struct(
                    s["l"].alias("l"), F.pmod(s["r"] + _hashed(s["l"], f"{seed}:{k}:r"), F.lit(b)).cast("bigint").alias("r")
                ),
            ),
            F.lit(0),
        )
    return F.get(F.transform(F.array(state), lambda s: s["l"] * b + s["r"]), F.lit(0))


def longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    """How many passes beyond the first any number below n can need.

    Only the fewer than sqrt(n) + 1 numbers from n to a*b-1 are looked at: what is left of them after
    each pass shrinks until only closed cycles, which no row can enter, remain.
    """
    a, b = sides(n)
    outside, walk = a * b - n, 0
    points = spark.range(n, a * b).withColumn("x", F.col("id"))
    while outside:
        points = points.withColumn("x", permuted(F.col("x"), n, seed)).where(F.col("x") >= n)
        left = points.count()
        walk += 1
        if left == outside:
            break
        outside = left
    return walk


def place(number: Column, n: int, seed: int, walk: int) -> Column:
    """The place of a row number in the reproducible shuffle of n rows."""
    once = permuted(number, n, seed)
    if walk == 0:
        return once
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(walk)),
        once,
        lambda x, _: F.when(x < n, x).otherwise(permuted(x, n, seed)),
    )


def identity(df: DataFrame) -> Column:
    """MD5 of all values of a row, with nulls told apart from texts."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    return F.md5(F.concat_ws("\x1f", *parts).cast("binary"))


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` with ``row_number``, ``shard`` and ``slot``."""
    df = df.drop(*[c for c in ("row_number", "shard", "slot") if c in df.columns])
    columns = df.columns
    spark = df.sparkSession
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__md5", identity(df))
    rows = rows.withColumn("__bucket", F.conv(F.substring("__md5", 1, BUCKET_DIGITS), 16, 10).cast("int"))
    sizes = [0] * 16**BUCKET_DIGITS
    for bucket, size in rows.groupBy("__bucket").agg(F.sum("__copies")).collect():  # one row a bucket
        sizes[bucket] = size
    offsets, n = [], 0
    for size in sizes:
        offsets.append(n)
        n += size
    before = Window.partitionBy("__bucket").orderBy("__md5").rowsBetween(Window.unboundedPreceding, -1)
    first = F.get(F.lit(offsets), F.col("__bucket")) + F.coalesce(F.sum("__copies").over(before), F.lit(0))
    rows = rows.withColumn("__first", first)
    # Copies become rows again in two steps, dealt out between them.
    blocks = rows.select(
        *columns, "__first", "__copies", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1, F.lit(COPIES_AT_ONCE).cast("bigint"))).alias("__block")
    ).hint("rebalance")
    last = F.least(F.col("__block") + (COPIES_AT_ONCE - 1), F.col("__copies") - 1)
    numbered = blocks.select(*columns, F.explode(F.sequence(F.col("__first") + F.col("__block"), F.col("__first") + last)).alias("row_number"))
    placed = numbered.withColumn("__place", place(F.col("row_number"), n, seed, longest_walk(spark, n, seed)) if n else F.lit(0).cast("bigint"))
    return placed.withColumns({
        "shard": F.pmod(F.col("__place"), F.lit(shards)).cast("int"),
        "slot": F.floor(F.col("__place") / shards).cast("bigint"),
    }).drop("__place")


def document_keys(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """What is sharded instead of the texts: id, stored size and CRC-32 of each document."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id_column),
        (F.octet_length(body) + 16).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )


def oracle_sql(walk: int = 6, shards: int = SHARDS, seed: int = SEED) -> str:
    """DuckDB SQL of the query: row numbers, the Feistel rounds as nested selects, ``walk`` further passes."""
    hashed = "('0x' || substr(md5('{key}:' || {x}), 1, 15))::BIGINT"
    steps = ["f0 AS (SELECT *, num AS x FROM n)"]
    for passed in range(walk + 1):
        source = f"f{passed}"
        halves = f"SELECT *, x // b AS l, x % b AS r FROM {source}"
        for k in range(DOUBLE_ROUNDS):
            left = hashed.format(key=f"{seed}:{k}:l", x="r")
            right = hashed.format(key=f"{seed}:{k}:r", x="l")
            halves = f"SELECT * REPLACE ((l + {left}) % a AS l) FROM ({halves})"
            halves = f"SELECT * REPLACE ((r + {right}) % b AS r) FROM ({halves})"
        done = "l * b + r" if passed == 0 else "CASE WHEN x < total THEN x ELSE l * b + r END"
        steps.append(f"f{passed + 1} AS (SELECT * EXCLUDE (l, r) REPLACE ({done} AS x) FROM ({halves}))")
    crc_table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        crc_table.append(byte)
    crc = (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(t)), '..'), "
        "lambda h: ('0x' || h)::BIGINT)), lambda c, v: xor(c >> 8, tbl[1 + (xor(c, v) & 255)])))"
    )
    return f"""
    WITH c AS (SELECT {crc_table}::BIGINT[] AS tbl),
    d AS (SELECT doc_id, (strlen(t) + 16)::BIGINT AS size, {crc} AS text_crc32
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents), c),
    m AS (SELECT *, md5(coalesce('=' || doc_id, '-') || chr(31) || '=' || size || chr(31) || '=' || text_crc32) AS digest FROM d),
    n AS (SELECT *, row_number() OVER (ORDER BY digest) - 1 AS num, total, s AS a, greatest(1, (total + s - 1) // s) AS b
        FROM m, (SELECT count(*) AS total, ceil(sqrt(count(*)))::BIGINT AS s FROM documents)),
    {', '.join(steps)}
    SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INTEGER AS shard, (x // {shards})::BIGINT AS slot,
        NULL::INTEGER AS grown_shard FROM f{walk + 1}"""
