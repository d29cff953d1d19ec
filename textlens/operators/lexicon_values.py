"""Valences of the words of a text from a lexicon table too large to travel in the plan.

Scoring itself stays a column expression on the row: what a table has to deliver is only the valence of each key (word
or run of words), in an array beside the keys. So plain sums, rules and phrases work for a lexicon of any size.

Up to ``MAX_SENT`` entries, counted first, the table is sent to the tasks as sorted 64-bit hashes and valences, 16 bytes
an entry. Keys are hashed in the JVM; an Arrow UDF looks whole batches up by binary search and sees no text. Nothing is
shuffled.

Beyond that the entries are joined. A Bloom filter of the lexicon, its bits set by an aggregate on the cluster, drops the keys that are no
entry before anything moves; keys that are still frequent are spread over salts, and only their entries are
copied. Rows are stored with a number first, so that null, repeated and equal rows each find their own values; no text is a
join key.

n entries of one lexicon share a hash with odds of n^2 / 2^65, 4 in ten million for ``MAX_SENT``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlens.operators.scoring import computed_once
from textlens.operators.small_tables import broadcast_if_small
from textlens.sources.sinks import materialise

MAX_SENT = 1 << 22
# Bits of the filter for each entry, its largest size (64 MB), and probes of a key.
BITS_PER_ENTRY, MAX_BITS, PROBES = 16, 1 << 29, 4
# Keys that are looked up at once, however large an Arrow batch is.
KEYS_AT_ONCE = 1 << 18
# A key is frequent if it occurs this often in one of so many rows; it is then dealt over so many salts.
FREQUENT, SAMPLED_ROWS, SALTS = 1000, 50, 32


def normalised(lexicon: DataFrame) -> DataFrame:
    """(key, valence): lower case, single spaces, the largest valence of equal keys. Valences must be finite."""
    sound = F.col("valence").isNull() | (F.abs("valence") < F.lit(float("inf")))
    checked = F.when(sound, F.col("valence")).otherwise(F.raise_error(F.lit("valences must be finite numbers")))
    key = F.lower(F.regexp_replace(F.trim(F.col("token")), r"\s+", " "))
    rows = lexicon.select(key.alias("key"), checked.cast("double").alias("valence")).where("key IS NOT NULL AND valence IS NOT NULL")
    return rows.groupBy("key").agg(F.max("valence").alias("valence"))


def _relisted(lengths: pa.Array, inner: pa.Array) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(np.asarray(lengths.fill_null(0))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), inner, mask=lengths.is_null())


def _values(hashes: np.ndarray, valences: np.ndarray, keys: np.ndarray) -> pa.Array:
    """The valence of each key, null for none; beside keys and result only ``KEYS_AT_ONCE`` of them take memory."""
    values, missing = np.zeros(len(keys)), np.ones(len(keys), bool)
    for low in range(0, len(keys) if len(hashes) else 0, KEYS_AT_ONCE):
        some = keys[low : low + KEYS_AT_ONCE]
        at = np.minimum(np.searchsorted(hashes, some), len(hashes) - 1)
        values[low : low + KEYS_AT_ONCE] = valences[at]
        missing[low : low + KEYS_AT_ONCE] = hashes[at] != some
    return pa.array(values, mask=missing)


def _looker(sent):
    """Hashes of keys (an array for each text of a row) to valences, null for none."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, valences = sent.value
        for batch in batches:
            texts = batch.flatten()
            keys = np.asarray(texts.flatten())
            values = _values(hashes, valences, keys)
            yield _relisted(batch.value_lengths(), _relisted(texts.value_lengths(), values))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _sent(entries: DataFrame):
    """Sorted hashes and valences as a broadcast; the number of entries was checked."""
    table = entries.select(F.xxhash64("key").alias("h"), "valence").toArrow()
    hashes, valences = np.asarray(table["h"]), np.asarray(table["valence"])
    order = np.argsort(hashes)
    return entries.sparkSession.sparkContext.broadcast((hashes[order], valences[order]))


def _places(h: Column, bits: int) -> list[Column]:
    """Bits that a hash sets."""
    low, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(low + step * k).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]


def bloom_filter(entries: DataFrame, count: int) -> np.ndarray:
    """The filter's words of 64 bits. Bits are or-ed on the cluster; at most ``MAX_BITS`` reach the driver."""
    bits = min(MAX_BITS, max(1 << 10, 1 << (count * BITS_PER_ENTRY - 1).bit_length()))
    places = entries.select(F.explode(F.array(*_places(F.xxhash64("key"), bits))).alias("place"))
    words = places.select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[np.asarray(table["word"])] = np.asarray(table["bits"]).view(np.uint64)
    return out


def may_contain(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    found = np.ones(len(h), bool)
    for k in range(PROBES):
        place = (low + step * np.uint64(k)) & np.uint64(len(words) * 64 - 1)
        found &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
    return found


def _sifter(sent):
    """Hashes of a row's keys to the places of those that may be entries."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = sent.value
        for batch in batches:
            lengths = np.asarray(batch.value_lengths().fill_null(0)).astype(np.int64)
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = np.flatnonzero(may_contain(words, np.asarray(batch.flatten())))
            counts = np.bincount(row[kept], minlength=len(lengths))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[kept].astype(np.int32)))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _scatter(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """(keys of each text, places of hits, valences of hits) of a row to its arrays of valences."""
    for lengths, places, valences in batches:
        sizes = np.asarray(lengths.flatten()).astype(np.int64)
        texts = np.asarray(lengths.value_lengths().fill_null(0)).astype(np.int64)
        row_of_text = np.repeat(np.arange(len(texts)), texts)
        totals = np.bincount(row_of_text, sizes, len(texts)).astype(np.int64)
        starts = np.cumsum(totals) - totals
        hits = np.asarray(places.value_lengths().fill_null(0)).astype(np.int64)
        at = np.asarray(places.flatten()).astype(np.int64) + np.repeat(starts, hits)
        values, missing = np.zeros(totals.sum()), np.ones(totals.sum(), bool)
        values[at], missing[at] = np.asarray(valences.flatten()), False
        yield _relisted(lengths.value_lengths(), _relisted(pa.array(sizes), pa.array(values, mask=missing)))


_scatter.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def _by_udf(df: DataFrame, out: str, function, kind: str, *arguments: Column) -> DataFrame:
    """Append what a UDF makes of expressions. They are worked out first: Spark loses sight of a UDF over lambda functions."""
    names = [f"_argument{k}" for k in range(len(arguments))]
    for name, argument in zip(names, arguments):
        df = computed_once(df, name, argument)
    return computed_once(df, out, F.arrow_udf(function, kind)(*names)).drop(*names)


def sifted(rows: DataFrame, keys: Column, row: str, entries: DataFrame, count: int) -> DataFrame:
    """(row, place, key) of the keys that pass the filter of the lexicon."""
    sent = rows.sparkSession.sparkContext.broadcast(bloom_filter(entries, count))
    flat = computed_once(rows, "_flat", F.coalesce(F.flatten(keys), F.array().cast("array<string>"))).select(row, "_flat")
    places = _by_udf(flat, "_places", _sifter(sent), "array<int>", F.transform("_flat", lambda k: F.xxhash64(k)))
    found = F.transform("_places", lambda p: F.struct(p.alias("place"), F.get("_flat", p).alias("key")))
    return places.select(row, F.explode(found).alias("f")).select(row, "f.place", "f.key")


def _joined(df: DataFrame, keys: Column, entries: DataFrame, count: int, out: str) -> DataFrame:
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()))
    candidates = sifted(rows, keys, "_row", entries, count)
    sampled = candidates.where(F.pmod(F.xxhash64("_row"), F.lit(SAMPLED_ROWS)) == 0).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    frequent = broadcast_if_small(sampled.where(F.col("n") >= FREQUENT).select("key", F.lit(SALTS).alias("salts")))
    if frequent is None:  # then no key has a large share
        frequent = F.broadcast(df.sparkSession.createDataFrame([], "key string, salts int"))
    salt = F.pmod(F.xxhash64("_row", "place"), F.coalesce("salts", F.lit(1))).cast("int")
    salted = candidates.join(frequent, "key", "left").select("_row", "place", "key", salt.alias("salt"))
    copies = entries.join(frequent, "key", "left").select(
        "key", "valence", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    )
    hits = salted.join(copies.hint("merge"), ["key", "salt"])
    grouped = hits.groupBy("_row").agg(F.collect_list(F.struct("place", "valence")).alias("_hits"))
    # A row is there once on either side, so no row number is hot.
    found = rows.join(grouped.hint("merge"), "_row", "left")
    sizes = F.transform(keys, lambda k: F.size(k))
    return _by_udf(found, out, _scatter, "array<array<double>>", sizes, F.col("_hits.place"), F.col("_hits.valence")).drop("_row", "_hits")


def with_values(df: DataFrame, keys: Column, lexicon: DataFrame, out: str, max_sent: int = MAX_SENT) -> DataFrame:
    """Append the valences of ``keys`` (array<array<string>>: the keys of each text of a row), null where a key is no entry.

    ``lexicon`` has ``token`` and ``valence``. Counting it is a job.
    """
    entries = normalised(lexicon)
    count = entries.count()
    if count <= max_sent:
        hashed = F.transform(keys, lambda one: F.transform(one, lambda k: F.xxhash64(k)))
        return _by_udf(df, out, _looker(_sent(entries)), "array<array<double>>", hashed)
    return _joined(df, keys, entries, count, out)
