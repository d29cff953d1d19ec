"""Laws of the sharding: a permutation, even shards, gapless slots, the same for any layout."""

import zlib

import pytest
from pyspark.sql import functions as F

from textlens.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 39, 40, 41, 1000, 1297])
def test_place_is_a_permutation(spark, n):
    walk = sharding.longest_walk(spark, n, 5)
    found = spark.range(n).select(sharding.place(F.col("id"), n, 5, walk).alias("p")).collect()
    assert sorted(r["p"] for r in found) == list(range(n))


def test_shards_are_even_and_slots_gapless(spark):
    rows = [(k, "t%d" % (k % 7), None if k % 5 else 1) for k in range(500)] + [(None, None, None)] * 9000
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_rows(df.select("doc_id", "text", "shard"), 7, 3)
    slots = {}
    for r in got.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(slots) == 7 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_layout_does_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = sharding.shard_rows(sharding.document_keys(docs))
    other = sharding.shard_rows(sharding.document_keys(docs.orderBy(F.desc("text")).repartition(5)))
    assert sorted(one.collect()) == sorted(other.collect())


def test_null_and_empty_text(spark):
    keys = sharding.document_keys(spark.createDataFrame([(1, None), (2, ""), (3, "é")], "doc_id long, text string"))
    found = [tuple(r) for r in keys.orderBy("doc_id").collect()]
    assert found == [(1, 16, 0), (2, 16, 0), (3, 18, zlib.crc32("é".encode()))]


def test_empty_table(spark):
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id long")).columns == ["doc_id", "row_number", "shard", "slot"]
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id long")).count() == 0
